import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from isoloir.llm import bpe, packing
from tokenizers import Tokenizer

from .conftest import ODD_TEXTS, sentence

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def awkward(n, seed):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "1", "'s", "'", "!", "\x1c", "\x85", " ", "中", "٣",
             "½", "\x00", "\r", "\x0b", "'re", "_", "erer", "aaaaaaa", "ththth", "🙂", "​", "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_encoding_is_the_librarys(codec, library):
    texts = [t or "" for _, t in ODD_TEXTS] + awkward(6000, 1) + [sentence(k, 60) for k in range(30)]
    encoded = codec.encode(texts)
    for text, data in zip(texts, encoded, strict=True):
        assert ids_of(data) == library.encode_ordinary(text), repr(text)
        assert codec.decode(data).decode() == text


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_encoding_any_text_is_the_librarys(codec, library, text):
    assert ids_of(codec.encode([text])[0]) == library.encode_ordinary(text)


def one_by_one(word, ranks):
    """Merges of one word: the lowest rank, the first of those, again and again."""
    parts = [word[k : k + 1] for k in range(len(word))]
    if word in ranks:
        return [ranks[word]]
    while True:
        found = [(ranks.get(a + b), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        found = [f for f in found if f[0] is not None]
        if not found:
            return [ranks[p] for p in parts]
        _, k = min(found)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_replay_of_any_ranks_is_one_word_at_a_time(data):
    # Random ranks also have merges that make pairs of lower ranks.
    letters = [bytes([b]) for b in range(256)]
    longer = data.draw(st.lists(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), unique=True))
    order = data.draw(st.permutations(longer))
    ranks = {t: k for k, t in enumerate(letters + order)}
    words = data.draw(st.lists(st.binary(max_size=12).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=6))
    got = bpe.replay(words, bpe.Merges(ranks))
    assert [g.tolist() for g in got] == [one_by_one(w, ranks) for w in words]


def test_encoded_documents(odd, none, library):
    got = bpe.encode_documents(odd, RANKS, public_tokenizers.PATTERN).collect()
    want = Counter()
    for i, text in ODD_TEXTS:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        plain = hashlib.sha256((text or "").encode()).hexdigest()
        want[i, len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), plain] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.encode_documents(none, RANKS, public_tokenizers.PATTERN).collect() == []


def test_ids_are_the_tokenizers(odd):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [t or "" for _, t in ODD_TEXTS] + awkward(3000, 2) + ["a <|endoftext|> b", "<|endoftext|>  x"]
    for text, data in zip(texts, packing.encoder(VOCABULARY).encode(texts), strict=True):
        assert ids_of(data) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check_packing(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or min(len(ids), capacity)
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_packed_documents(odd, none):
    used, least = check_packing(packing.pack_documents(odd, VOCABULARY).collect(), ODD_TEXTS, 2048)
    assert used <= least + 1
    assert packing.pack_documents(none, VOCABULARY).collect() == []


def test_small_capacity_and_many_equal_lengths(spark):
    texts = [(k, sentence(k % 7, 3 + k % 40)) for k in range(400)] + [(1000 + k, None) for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    used, least = check_packing(packing.pack_documents(docs, VOCABULARY, capacity=64).collect(), texts, 64)
    assert used <= least * 1.02 + 1


def fullest_by_trial(counts, capacity):
    longest = max(counts)
    sums = {longest}
    for n, c in counts.items():
        for _ in range(c - (n == longest)):
            sums |= {s + n for s in sums if s + n <= capacity}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=8), st.integers(40, 90))
def test_fullest_combination(counts, capacity):
    chosen = packing.fullest(counts, capacity)
    assert all(0 < k <= counts[n] for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == fullest_by_trial(counts, capacity)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 1000), max_size=30))
def test_plan_uses_every_piece_once(counts):
    used = Counter()
    for chosen, times in packing.plan_bins(counts, 64):
        assert sum(n * k for n, k in chosen.items()) <= 64
        used.update({n: k * times for n, k in chosen.items()})
    assert used == Counter(counts)


def test_plan_is_short_for_many_pieces():
    rng = np.random.default_rng(3)
    lengths, n = np.unique(np.minimum(rng.lognormal(6, 1.2, 2_000_000).astype(int) + 1, 2048), return_counts=True)
    counts = dict(zip(lengths.tolist(), n.tolist(), strict=True))
    plan = packing.plan_bins(counts)
    total = sum(n * c for n, c in counts.items())
    assert len(plan) < 10_000
    assert sum(times for _, times in plan) <= -(-total // 2048) * 1.001 + 1
