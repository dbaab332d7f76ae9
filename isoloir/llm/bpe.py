"""Byte-level BPE encoding and decoding by replay of the merges over a block of words.

All different words of a block are laid out one after another as byte tokens. An inverted
index has, for each rank, the positions where a pair with that rank stands. The lowest
rank is taken again and again, and its merge is applied at the first of its positions in
every word; only the pairs with the touched neighbours are looked up and indexed anew.
Within a word that is the order in which a single word's merges go.

The blocks are batches of a Spark partition, so the corpus is replayed in parallel and a
task holds one block. The rank file is named by its path, which every executor has.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloir.llm.common import text_of
from isoloir.llm.units import UnitEncoder, blocks_of

ENCODED = "doc_id {key}, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string"
_NONE = np.int64(1) << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Ranks of the pairs of tokens, and the tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            ((ranks[token[:k]] << 32) | ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        keys = np.array([p[0] for p in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.array([p[1] for p in pairs], np.int64)[order]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``_NONE``."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        wanted = (left << np.int64(32)) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], _NONE)


def replay(words: list[bytes], merges: Merges) -> list[np.ndarray]:
    """The ids of each word. A word that is a token is that token."""
    whole = [merges.ranks.get(word) for word in words]
    rest = [word for word, rank in zip(words, whole, strict=True) if rank is None and word]
    merged = iter(_replay(rest, merges))
    return [
        np.array([rank], np.int64) if rank is not None else next(merged) if word else np.zeros(0, np.int64)
        for word, rank in zip(words, whole, strict=True)
    ]


def _replay(words: list[bytes], merges: Merges) -> list[np.ndarray]:
    if not words:
        return []
    sizes = np.array([len(w) for w in words])
    token = merges.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(words)), sizes)
    # Links to the neighbours in the word; n stands for none.
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    last = np.cumsum(sizes) - 1
    after[last] = n
    before[last[:-1] + 1] = n
    before[0] = n
    rank = np.full(n, _NONE)
    inner = np.flatnonzero(after < n)
    rank[inner] = merges.rank_of(token[inner], token[inner + 1])
    alive = np.ones(n, bool)

    order = inner[np.argsort(rank[inner], kind="stable")]
    found, first = np.unique(rank[order], return_index=True)
    standing = dict(zip(found.tolist(), np.split(order, first[1:]), strict=True))
    standing.pop(int(_NONE), None)
    # Positions of pairs that merges made, by rank.
    made: dict[int, list[int]] = defaultdict(list)
    waiting = list(standing)
    heapq.heapify(waiting)

    while waiting:
        r = heapq.heappop(waiting)
        at = np.array(made.pop(r, []), np.int64)
        if r in standing:
            at = np.concatenate([standing.pop(r), at])
        at = np.unique(at[rank[at] == r])
        if not len(at):
            continue
        # One merge a word at a time: it may make a pair of a lower rank.
        of = word[at]
        one = np.ones(len(at), bool)
        one[1:] = of[1:] != of[:-1]
        if not one.all():
            made[r] = at[~one].tolist()
            heapq.heappush(waiting, r)
            at = at[one]
        gone = after[at]
        token[at] = r
        alive[gone] = False
        rank[gone] = _NONE
        follow = after[gone]
        after[at] = follow
        linked = follow < n
        before[follow[linked]] = at[linked]
        rank[at] = _NONE
        rank[at[linked]] = merges.rank_of(token[at[linked]], token[follow[linked]])
        lead = before[at]
        lead = lead[lead < n]
        rank[lead] = merges.rank_of(token[lead], token[after[lead]])
        touched = np.concatenate([at, lead])
        ranks = rank[touched]
        known = ranks != _NONE
        for new, position in zip(ranks[known].tolist(), touched[known].tolist(), strict=True):
            if new not in made and new not in standing:
                heapq.heappush(waiting, new)
            made[new].append(position)
    return np.split(token[alive], np.cumsum(np.bincount(word[alive], minlength=len(words)))[:-1])


class Codec:
    """Encodes texts by ranks and decodes ids; keeps the parts it has seen."""

    def __init__(self, path: str, pattern: str) -> None:
        self.merges = Merges(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.units = UnitEncoder(self._encode_parts)

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        pieces = [self.pattern.findall(part) for part in parts]
        different = list({p for found in pieces for p in found})
        ids = replay([p.encode("utf-8", "surrogatepass") for p in different], self.merges)
        known = {p: i.astype("<u4").tobytes() for p, i in zip(different, ids, strict=True)}
        return [b"".join(map(known.__getitem__, found)) for found in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        return self.units.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    """One codec in each Python worker, for all its tasks."""
    return Codec(path, pattern)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", ids: bool = True
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (if asked for), their digest and that of the decoded bytes.

    A null text counts as empty; an empty one has no ids. Repeated rows are encoded each;
    other columns are ignored; an empty table gives an empty result.
    """
    key = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in blocks_of(texts):
                encoded = code.encode(texts[start:end])
                columns = [
                    batch.column(0).slice(start, end - start),
                    pa.array([len(e) // 4 for e in encoded], pa.int64()),
                    pa.array([e if ids else None for e in encoded], pa.binary()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in encoded]),
                    pa.array([hashlib.sha256(code.decode(e)).hexdigest() for e in encoded]),
                ]
                names = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names)

    picked = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return picked.mapInArrow(run, ENCODED.format(key=key))
