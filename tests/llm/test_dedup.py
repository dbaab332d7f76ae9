import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from isoloir.llm import blocks, components, exact_dedup, ngram_join, shingling
from isoloir.llm.blocks import pack, pack_sorted, unpack, unpack_sorted
from pyspark.sql import functions as F

from .conftest import BLANKS, LOWER, ODD_TEXTS, counted, sentence, words_of


def exact_groups(rows):
    norm = [(i, re.sub(BLANKS, " ", t or "")) for i, t in rows]
    ids = defaultdict(list)
    for i, t in norm:
        ids[t].append(i)
    out, used = Counter(), set()
    for i, t in norm:
        keep = min((x for x in ids[t] if x is not None), default=None)
        kept = i == keep and (i, t) not in used
        used.add((i, t))
        out[i, keep, len(ids[t]), kept, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def test_exact_groups_match_brute_force(odd):
    assert counted(exact_dedup.duplicate_groups(odd).collect()) == exact_groups(ODD_TEXTS)


def test_exact_groups_of_nothing(none):
    assert exact_dedup.duplicate_groups(none).collect() == []
    assert exact_dedup.keep_first(none).collect() == []


def test_first_of_each_group_stays_with_its_columns(odd):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    texts = [re.sub(BLANKS, " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(BLANKS, " ", t or "") for _, t in ODD_TEXTS})
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 6, 7, 15}


def test_filter_misses_no_repeat_and_passes_most_others(spark):
    rows = spark.range(60_000).selectExpr("xxhash64(id % 50000) AS h").repartition(5)
    ask = exact_dedup.may_repeat(rows, 60_000)
    asked = rows.withColumn("asked", ask("h"))
    asked = asked.groupBy("h").agg(F.count("*"), F.max("asked")).collect()
    assert all(r[2] for r in asked if r[1] > 1)
    assert sum(r[2] for r in asked if r[1] == 1) < 400


def test_a_filter_of_many_segments_passes_most_rows(spark, monkeypatch):
    """Four times the rows that a segment is made for: a task holds one segment at a time."""
    monkeypatch.setattr(exact_dedup, "SEGMENT", 1 << 20)
    monkeypatch.setattr(exact_dedup, "WINDOW", 10_000)
    rows = 1 << 18
    assert exact_dedup.filter_size(rows) == (4, 1 << 20)
    hashes = spark.range(rows).selectExpr("xxhash64(id % 260000) AS h").repartition(6)
    ask = exact_dedup.may_repeat(hashes, rows)
    asked = hashes.withColumn("asked", ask("h"))
    asked = asked.groupBy("h").agg(F.count("*").alias("n"), F.bool_and("asked").alias("every"), F.bool_or("asked").alias("some"))
    repeated, alone = asked.where("n > 1"), asked.where("n = 1")
    assert repeated.count() == repeated.where("every").count() == rows - 260_000
    assert alone.where("some").count() < 0.05 * alone.count()


@pytest.mark.parametrize("segment", [1 << 20, 1 << 26])
def test_groups_are_alike_whatever_the_segments(odd, monkeypatch, segment):
    monkeypatch.setattr(exact_dedup, "SEGMENT", segment)
    monkeypatch.setattr(exact_dedup, "filter_size", lambda rows: (3 if segment == 1 << 20 else 1, segment))
    assert counted(exact_dedup.duplicate_groups(odd).collect()) == exact_groups(ODD_TEXTS)


def test_full_filter_changes_no_result(odd, monkeypatch):
    monkeypatch.setattr(exact_dedup, "may_repeat", lambda hashes, rows: lambda h: F.lit(True))
    assert counted(exact_dedup.duplicate_groups(odd).collect()) == exact_groups(ODD_TEXTS)


def sets_of(rows):
    out = []
    for i, t in rows:
        w = words_of((t or "").translate(LOWER))
        n = min(5, len(w))
        out.append((i, frozenset(zip(*(w[k : len(w) - n + 1 + k] for k in range(n)), strict=True)) if w else frozenset()))
    return out


def near_classes(rows):
    sets = sets_of(rows)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        least[find(k)].append(i)
    return Counter(
        (i, len(s), min((x for x in least[find(k)] if x is not None), default=None))
        for k, (i, s) in enumerate(sets)
    )


def test_near_classes_match_brute_force(odd):
    assert counted(ngram_join.similar_documents(odd).collect()) == near_classes(ODD_TEXTS)


def test_near_classes_of_nothing(none):
    assert ngram_join.similar_documents(none).collect() == []


def copies(groups, size, words):
    """Groups of documents, each with some words changed, and a passage that all share."""
    out, shared = [], sentence(99, 30)
    for g in range(groups):
        base = sentence(g + 10, words).split()
        for k in range(size):
            said = list(base)
            for at in range(k % 4):
                said[(k * 17 + at * 29) % words] = f"changed{g}x{k}x{at}"
            out.append((g * size + k, " ".join(said) + (f" {shared}" if k % 3 == 0 else "")))
    return out


def test_near_classes_of_large_groups(spark):
    # Frequent from eight sets on, so that pairs within groups carry most of the work.
    rows = copies(6, 30, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = near_classes(rows)
    assert counted(ngram_join.similar_documents(docs).collect()) == want
    assert counted(ngram_join.similar_documents(docs, frequent=8).collect()) == want


def test_one_of_each_class_stays(odd):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 not in ids and 8 not in ids and 4 in ids and 5 in ids


#: A unique text and two that are linked without an id; ids that repeat with texts of two classes.
LOOSE_TEXTS = [
    (None, sentence(70, 30)),
    (None, sentence(71, 60)),
    (None, sentence(71, 59) + " other"),
    (2, sentence(72, 30)),
    (30, sentence(73, 39) + " other"),
    (30, sentence(74, 30)),
    (29, sentence(73, 40)),
    (31, sentence(75, 30)),
    (31, sentence(75, 30)),
    (None, " "),
    (5, ""),
]


def one_row_each(rows):
    """Ids and shingles of one row of each class, the smallest id and null last, and of all without shingles."""
    sets, out = sets_of(rows), Counter()
    left = [s for s in sets if s[1]]
    out.update(s for s in sets if not s[1])
    while left:
        linked, grown = [left.pop()], True
        while grown:
            near = [
                k for k, (_, s) in enumerate(left) if any(100 * len(s & t) >= 75 * len(s | t) for _, t in linked)
            ]
            linked += [left[k] for k in near]
            left, grown = [s for k, s in enumerate(left) if k not in near], bool(near)
        least = min(linked, key=lambda s: (s[0] is None, s[0] or 0))
        # Which row stays of those that tie is not said.
        out[least if sum(s[0] == least[0] for s in linked) == 1 else (least[0], "tied")] += 1
    return out


def kept_rows(kept, rows):
    """What ``one_row_each`` gives, of the rows that were kept."""
    tied = {s[0] for s in one_row_each(rows) if s[1] == "tied"}
    sets = sets_of([(r.doc_id, r.text) for r in kept])
    return Counter((i, "tied") if i in tied and (i, s) not in one_row_each(rows) else (i, s) for i, s in sets)


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    rows = ODD_TEXTS + LOOSE_TEXTS
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert kept_rows(ngram_join.keep_one(docs).collect(), rows) == one_row_each(rows)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_linked_sets_share_a_signature(data):
    size = data.draw(st.integers(2, 120))
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    pool = rng.integers(1, 2**62, 400).astype(np.uint64)
    often = rng.choice([1, 2, 30, 64, 500, 9000], 400, p=data.draw(st.sampled_from([
        [0.0, 0.2, 0.2, 0.2, 0.2, 0.2], [0.0, 0.0, 0.0, 0.1, 0.4, 0.5], [0.0, 0.9, 0.1, 0.0, 0.0, 0.0],
    ])))
    a = rng.permutation(400)[:size]
    lost = data.draw(st.integers(0, size))
    b = np.concatenate([a[lost:], rng.permutation(np.setdiff1d(np.arange(400), a))[: data.draw(st.integers(0, size))]])
    both = size - lost
    if len(b) == 0 or 100 * both < 75 * len(np.union1d(a, b)):
        return
    one, two = (np.concatenate(ngram_join.signatures(pool[x], often[x])) for x in (a, b))
    same = len(a) == len(b) == both
    assert same or len(np.intersect1d(one, two)), (size, lost, len(b))


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)] + [(3, 259)]
    found = components.components(spark.createDataFrame(path + star, "a long, b long"))
    assert {r.node: r.comp for r in found.collect()} == {
        **{k: 100 for k in range(100, 161)}, **{k: 3 for k in (3, 7, *range(200, 260))}
    }


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_packed_numbers_come_back(values):
    plain = np.array(values, np.uint64)
    assert (unpack(pack(plain)) == plain).all()
    ordered = np.unique(plain)
    assert (unpack_sorted(pack_sorted(ordered)) == ordered).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aAbé \t\n中", max_size=40), max_size=8))
def test_shingles_of_a_block_are_those_of_its_words(texts):
    encoded = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, encoded)])
    found = shingling.shingle_sets_of(np.frombuffer(b"".join(encoded), np.uint8), ends)
    want = [s for _, s in sets_of(enumerate(texts))]
    assert [len(f) for f in found] == [len(w) for w in want]
    # The same shingle has the same hash wherever it stands, and others have others.
    for a, wa in zip(found, want, strict=True):
        for b, wb in zip(found, want, strict=True):
            assert len(np.intersect1d(a, b)) == len(wa & wb)


def test_texts_longer_than_a_block_and_blocks_of_many(monkeypatch):
    texts = [sentence(k, 1 + 7 * k % 60) for k in range(80)] + [sentence(90, 3000), "", "Z" * 5000]
    encoded = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)])
    whole = shingling.shingle_sets_of(data, ends)
    monkeypatch.setattr(shingling, "BLOCK_BYTES", 500)
    parts = shingling.shingle_sets_of(data, ends)
    assert [f.tolist() for f in whole] == [f.tolist() for f in parts]
    assert [shingling.shingles(t).tolist() for t in texts] == [f.tolist() for f in parts]


def test_copies_of_one_text_are_dealt_to_many_blocks(spark, monkeypatch):
    """Nineteen of twenty rows are one text; a block gets about as many bytes as any other."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    rows = [(k, sentence(1, 40)) for k in range(1900)] + [(k, sentence(k, 40)) for k in range(2000, 2090)]
    rows += [(k + 100, sentence(k, 39) + " other") for k in range(2000, 2010)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
    assert all(got[k] == 0 for k in range(1900))
    assert all(got[k + 100] == k for k in range(2000, 2010))
    assert len(got) == 2000 and all(got[k] == k for k in range(2000, 2090))
    many = blocks.block_count(sum(len(t) for _, t in rows))
    assert many > 10
