"""Best-fit packing of tokenised documents into sequences, by minimum bin slack.

Documents are tokenised where they are and cut into pieces; only lengths matter from then
on, and there are at most ``CAPACITY`` different ones. Their counts are what the plan is
made of: the longest piece left opens a sequence, and dynamic programming over a bitset of
reachable sums finds the fullest combination of the lengths that are left; the combination
is used as often as the counts allow, then the next is sought. The plan has at most some
ten thousand combinations, however many documents there are.

A piece finds its place by its rank among the pieces of its length. Ranks are counted in
parts of some ``BUCKET_PIECES`` pieces, so a length that a third of the pieces have is no
single task, however many there are.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoloir.llm.common import give_back, small_batches, stored, text_of
from isoloir.llm.units import UnitEncoder, blocks_of

CAPACITY = 2048
#: Parts that ranks are counted in at least, and pieces that a part has, about.
BUCKETS = 256
BUCKET_PIECES = 100_000
#: Parts that a worker keeps the ids of, and characters of texts encoded together, about.
KEPT_PARTS = 150_000
BLOCK_CHARS = 4_000_000
#: How a byte-level vocabulary splits text before the merges; a fixed value of such files.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: The id that ends every document.
END_ID = 0

PIECES = "doc_id {key}, piece int, start long, length long, ids_crc32 long, ids binary"
PLACED = (
    "doc_id {key}, piece int, start long, length long, ids_crc32 long,"
    " sequence_id long, offset long"
)


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """A byte-level BPE tokenizer file, encoding many parts in one call.

    The file's merges make its tokens in the order of their ids, so that a merge's rank is
    its token's id; a file for which that is not so is refused.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, split = described["model"], described["pre_tokenizer"]
        plain = (model["type"], split["type"], split["add_prefix_space"], described["normalizer"])
        if plain != ("BPE", "ByteLevel", False, None):
            raise ValueError(f"not a plain byte-level BPE: {plain}")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        letters = _byte_of_letter()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in model["vocab"].items()
            if token not in special
        }
        if made != sorted(made) or made[:1] != [256] or len(ranks) != 256 + len(set(made)):
            raise ValueError("the merges do not make the tokens in the order of their ids")
        self.encoding = tiktoken.Encoding(
            "file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        tokens = {**{rank: len(t) for t, rank in ranks.items()}, **{i: len(t.encode()) for t, i in special.items()}}
        self.sizes = np.zeros(max(tokens) + 1, np.int64)
        self.sizes[list(tokens)] = list(tokens.values())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode(text, allowed_special="all"), "<u4")

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each part. Those that begin with a space are encoded as one text."""
        out = [b""] * len(parts)
        spaced = [k for k, part in enumerate(parts) if part[0] == " " and part[1:2].strip()]
        ids = self.encode("".join([parts[k] for k in spaced]))
        ends = np.cumsum([len(parts[k].encode("utf-8", "surrogatepass")) for k in spaced], dtype=np.int64)
        at = (4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)).tolist()
        data, start = ids.tobytes(), 0
        for k, end in zip(spaced, at, strict=True):
            out[k] = data[start:end]
            start = end
        for k in set(range(len(parts))).difference(spaced):
            out[k] = self.encode(parts[k]).tobytes()
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> UnitEncoder:
    """One encoder in each Python worker, for all its tasks."""
    return UnitEncoder(Vocabulary(path).encode_parts, KEPT_PARTS)


def cuts(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces: full ones, the first what is over."""
    first = tokens % capacity or min(tokens, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, tokens, capacity)]


def cut_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, ids: bool = False,
) -> DataFrame:
    """The pieces of every row, ``ids`` as little-endian 32-bit numbers if asked for.

    A null text counts as empty; an empty one is a piece of the end id alone.
    """
    small_batches(docs.sparkSession)
    key = docs.schema[doc_id].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in blocks_of(texts, BLOCK_CHARS):
                rows, found = [], []
                for k, encoded in enumerate(encode(texts[first:last]), first):
                    data = encoded + end
                    for n, (start, length) in enumerate(cuts(len(data) // 4, capacity)):
                        piece = data[4 * start : 4 * (start + length)]
                        rows.append(k)
                        found.append((n, start, length, zlib.crc32(piece), piece if ids else None))
                numbers = list(zip(*found, strict=True))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(v, t) for v, t in zip(numbers, kinds, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], names)
        give_back()

    picked = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return picked.mapInArrow(run, PIECES.format(key=key))


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination of lengths with the longest in it, longest tried first.

    Bit ``s`` of a stage's set says that some of the lengths so far sum to ``s``.
    """
    lengths = sorted((n for n in counts if counts[n]), reverse=True)
    longest = lengths[0]
    sums, stages = 1 << longest, []
    within = (1 << (capacity + 1)) - 1
    for length in lengths:
        left = min(counts[length] - (length == longest), (capacity - longest) // length)
        if left <= 0:
            continue
        stages.append((length, left, sums))
        step = 1
        while left > 0:  # one, two, four ... more of this length
            take = min(step, left)
            sums |= (sums << (take * length)) & within
            left, step = left - take, step * 2
        if sums >> capacity & 1:
            break
    total = sums.bit_length() - 1
    chosen = {longest: 1}
    for length, left, before in reversed(stages):
        times = next(k for k in range(left + 1) if total >= k * length and before >> (total - k * length) & 1)
        if times:
            chosen[length] = chosen.get(length, 0) + times
            total -= times * length
    return chosen


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many sequences each fills."""
    left, plan = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        plan.append((chosen, times))
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows of first rank, pieces a sequence, first sequence, first offset."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for chosen, times in plan:
        offset = 0
        for length, each in chosen.items():
            rows.setdefault(length, []).append((used.get(length, 0), each, sequence, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def ranked(pieces: DataFrame, total: int = 0) -> DataFrame:
    """``pieces``, of which there are ``total``, with ``rank``: from 0 among those of a length."""
    buckets = max(BUCKETS, total // BUCKET_PIECES)
    # Pieces of rows that share an id, or have none, differ by their tokens.
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    dealt = pieces.withColumn("bucket", bucket)
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # A row for each part of a length.
    so_far = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("first"))
    here = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    own = dealt.withColumn("own", F.row_number().over(here) - 1)
    return own.join(firsts, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("own"))


def pack_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every row with ``sequence_id`` and ``offset``.

    A null or empty text is a piece of one id. Rows that repeat an id are packed each;
    other columns are ignored; an empty table gives an empty result.
    """
    key = docs.schema[doc_id].dataType.simpleString()
    pieces = stored(cut_documents(docs, path, doc_id, text, capacity).drop("ids"), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = places(plan_bins(counts, capacity))
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                rows = shared.value[n]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                further = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + further // row[:, 1]
                offset[at] = row[:, 3] + further % row[:, 1] * n
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [batch.column(name) for name in names]
            columns += [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return ranked(pieces, sum(counts.values())).mapInArrow(place, PLACED.format(key=key))
