"""Exact dedup by two passes over a Bloom filter.

The first pass counts, per slot of a Bloom filter, whether no, one or several
rows hash to it (two bits, saturating). What stays is one bit per slot:
"several". The second pass asks it for every row. A row with a slot that only
one row hits has no equal and passes straight through; the others may be
repeated, and they alone are shuffled and compared exactly. A false positive
costs the shuffle of one row and changes no result.

The filter has 16 slots a row, however many rows there are. It consists of
segments of ``SEGMENT`` slots, and a hash has all its slots in one of them. A
task sorts its hashes by segment and works on one segment after the other, in
both passes; counts of tasks are combined piece by piece, a task for each few.
A filter of one segment is broadcast, which is 8 MB at most; several lie in the
shared folder, and a task reads those that its rows ask for.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoloir.llm.common import BLANKS, free_name, stored, text_of
from isoloir.session import scratch_folder

#: Slots of a segment: what a task holds of the filter, eight megabytes of bits.
SEGMENT = 1 << 26
#: Slots that each row hits.
HITS = 4
#: Slots of a piece, the unit that tasks' counts are combined in.
PIECE = 1 << 20
#: Hashes that a task sorts together.
WINDOW = 1 << 21


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(text_of(text), BLANKS, " ")


def text_hash(text: str) -> Column:
    return F.sha2(normalised(text), 256)


def slots_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    """The ``HITS`` different slots within its segment of each 64-bit hash, one row per hash."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    hits = np.arange(HITS, dtype=np.uint64)
    return ((h[:, None] + hits * step[:, None]) & np.uint64(slots - 1)).astype(np.int64)


def segments_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each hash."""
    h = hashes.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)


def filter_size(rows: int) -> tuple[int, int]:
    """How many segments, and slots of each (a power of two): 16 slots a row or more."""
    if 16 * rows > SEGMENT:
        return -(-16 * rows // SEGMENT), SEGMENT
    return 1, max(PIECE, 1 << max(0, 16 * rows - 1).bit_length())


def _by_segment(hashes: np.ndarray, segments: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each segment that is hit, and the places of its hashes."""
    if not len(hashes):
        return
    segment = segments_of(hashes, segments)
    order = np.argsort(segment, kind="stable")
    found, first = np.unique(segment[order], return_index=True)
    for number, at in zip(found.tolist(), np.split(order, first[1:]), strict=True):
        yield number, at


def _windows(hashes: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Batches of hashes, as many together as make a window."""
    waiting, size = [], 0
    for batch in hashes:
        waiting.append(batch)
        size += len(batch)
        if size >= WINDOW:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting


def _packed(places: np.ndarray) -> bytes:
    found = np.zeros(PIECE, bool)
    found[places] = True
    return zlib.compress(np.packbits(found).tobytes(), 1)


def repeated_slots(hashes: DataFrame, segments: int, slots: int) -> DataFrame:
    """``segment``, ``piece`` and one bit per slot, packed: whether several rows of ``h`` hit it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window in _windows(b.column(0).to_numpy() for b in batches):
            together = np.concatenate(window)
            for segment, at in _by_segment(together, segments):
                hit, n = np.unique(slots_of(together[at], slots), return_counts=True)
                piece, place = hit // PIECE, hit % PIECE
                found, first = np.unique(piece, return_index=True)
                edges = [*first.tolist(), len(hit)]
                parts = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": np.full(len(found), segment, np.int64),
                        "piece": found,
                        "once": [_packed(place[p]) for p in parts],
                        "twice": [_packed(place[p][n[p] > 1]) for p in parts],
                    }
                )

    def combine(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = np.zeros(PIECE // 8, np.uint8), np.zeros(PIECE // 8, np.uint8)
        for part in parts:
            for a, b in zip(part["once"], part["twice"], strict=True):
                a = np.frombuffer(zlib.decompress(a), np.uint8)
                twice |= np.frombuffer(zlib.decompress(b), np.uint8) | (once & a)
                once |= a
        twice = zlib.compress(twice.tobytes(), 1)
        yield pd.DataFrame({"segment": [key[0]], "piece": [key[1]], "twice": [twice]})

    counted = hashes.select("h").mapInArrow(count, "segment long, piece long, once binary, twice binary")
    return counted.groupBy("segment", "piece").applyInPandas(combine, "segment long, piece long, twice binary")


def _bits(pieces: Iterator[tuple[int, bytes]], slots: int) -> np.ndarray:
    bits = np.zeros(slots // 8, np.uint8)
    for piece, twice in pieces:
        start = piece * (PIECE // 8)
        bits[start : start + PIECE // 8] = np.frombuffer(zlib.decompress(twice), np.uint8)
    return bits


def _filter(hashes: DataFrame, segments: int, slots: int) -> Callable[[int], np.ndarray]:
    """A function that tasks call for the bits of a segment."""
    repeated, spark = repeated_slots(hashes, segments, slots), hashes.sparkSession
    if segments == 1:
        # One segment at most: a proven bound.
        pieces = ((r.piece, r.twice) for r in repeated.toLocalIterator())
        shared = spark.sparkContext.broadcast(_bits(pieces, slots).tobytes())
        return lambda segment: np.frombuffer(shared.value, np.uint8)
    folder = scratch_folder(spark, "filter")
    repeated.write.partitionBy("segment").parquet(folder)

    def read(segment: int) -> np.ndarray:
        import pyarrow.parquet
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(f"{folder}/segment={segment}")
        table = pyarrow.parquet.read_table(path, columns=["piece", "twice"], filesystem=system, partitioning=None)
        return _bits(zip(table["piece"].to_pylist(), table["twice"].to_pylist(), strict=True), slots)

    return read


def may_repeat(hashes: DataFrame, rows: int) -> object:
    """A function of a 64-bit hash column: false only where no other row has it."""
    segments, slots = filter_size(rows)
    bits_of = _filter(hashes, segments, slots)

    def answers(window: list[np.ndarray]) -> Iterator[np.ndarray]:
        together = np.concatenate(window)
        found = np.zeros(len(together), bool)
        for segment, at in _by_segment(together, segments):
            bits, hit = bits_of(segment), slots_of(together[at], slots)
            # packbits puts the first slot of a byte highest.
            seen = bits[hit >> 3] >> (7 - (hit & 7).astype(np.uint8))
            found[at] = (seen & 1).all(axis=1)
        yield from np.split(found, np.cumsum([len(b) for b in window])[:-1])

    @F.pandas_udf("boolean")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for window in _windows(h.to_numpy() for h in batches):
            yield from map(pd.Series, answers(window))

    return ask


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after each run of ASCII white space became one
    space; null counts as empty. The smallest id of a group stays; of rows that
    repeat it, one. A null id comes after all others. Other columns of ``docs``
    are ignored. An empty table gives an empty result.
    """
    hashed = stored(docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_sha256")), "hashes")
    h = F.xxhash64("text_sha256")
    ask = may_repeat(hashed.select(h.alias("h")), hashed.count())
    asked = hashed.withColumn("asked", ask(h))
    alone = asked.where(~F.col("asked")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # Repeated rows of one document become one row with a count before the join. Both sides
    # of the join are stored, so that each is shuffled for it alone: then Spark can split a
    # text that very many documents have, which it cannot below an aggregate.
    rows = asked.where("asked").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("copies"))
    rows = stored(rows, "repeated")
    groups = rows.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    groups = stored(groups, "groups")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    compared = (
        rows.join(groups, "text_sha256")
        .select("doc_id", "keep_id", "group_size", "text_sha256", copy)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
    )
    return alone.unionByName(compared.select(alone.columns))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text an earlier one has; columns unchanged.

    Only rows that may be repeated are shuffled. The row with the smallest id of
    a group stays, a null id last; of rows that tie, any one.
    """
    sha, asked, place = (free_name(docs, c) for c in ("text_sha256", "asked", "place"))
    hashes = docs.select(F.xxhash64(text_hash(text)).alias("h"))
    ask = may_repeat(hashes, docs.count())
    tagged = docs.withColumn(sha, text_hash(text)).withColumn(asked, ask(F.xxhash64(sha)))
    first = Window.partitionBy(sha).orderBy(F.col(doc_id).asc_nulls_last())
    # Spark keeps the first of each partition before it shuffles, so a text that a
    # third of the rows share reaches its task as one row per partition.
    compared = tagged.where(F.col(asked)).withColumn(place, F.row_number().over(first))
    alone = tagged.where(~F.col(asked)).select(*docs.columns)
    return alone.unionByName(compared.where(F.col(place) == 1).select(*docs.columns))
