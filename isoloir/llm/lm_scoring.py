"""Stupid-backoff scores of a corpus against its own n-grams.

Counts are a table of n-grams partitioned by hash (``blocks``). Every block of documents is
joined to the counts of its own n-grams, and the scores of the words are summed per document.
Tasks cut the documents they read into blocks and hash their words once; what moves of a text
is a number for each of its words.

A word's score is the count of the longest n-gram that ends in it, divided by the count of
the n-gram without it, times ``BACKOFF`` for every order that had to be left out. An n-gram of
two or more words counts if it occurs ``LEAST_COUNT`` times; a word alone always counts, and
is divided by all words. Logarithms are summed as whole millionths, so that the sum does not
depend on its order. N-grams are told apart by hashes of 64 bits.

``score_relational`` gives the same scores as a plan of rows: a row for each different n-gram
of a document, a table of counts grouped by n-gram, a join on it, and sums per document. It
moves many times what the blocks do (the figures are in the README).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloir.llm import blocks
from isoloir.llm.blocks import (
    BUCKET_GRAMS,
    DENSE,
    REQUESTS,
    answers,
    mix,
    pack_dense,
    requests,
    sums_of,
    unpack_dense,
)
from isoloir.llm.common import byte_ranges, give_back, small_batches, stored, string_bytes, text_of

ORDER = 3
BACKOFF = 0.4
LEAST_COUNT = 2

SCORES = "doc_id {key}, n_words long, n_backoffs long, log_score double"


class Words(NamedTuple):
    """The words of some texts, end to end, as hashes, and how many each text has."""

    hashes: np.ndarray
    sizes: np.ndarray


def words_of(texts: Iterable[bytes]) -> Words:
    known: dict[bytes, int] = {}
    parts = []
    for text in texts:
        words = text.split()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    sizes = np.array([len(p) for p in parts], np.int64)
    return Words(np.concatenate(parts) if parts else np.zeros(0, np.uint64), sizes)


def pack_words(hashes: np.ndarray) -> tuple[list[bytes], bytes]:
    """The different words of a block, and for each place which of them stands there.

    Words that occur about equally often, by powers of two, are one ascending list; those that
    occur most have the smallest numbers.
    """
    found, place, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    often = np.frexp(counts.astype(np.float64))[1]
    order = np.argsort(-often, kind="stable")
    number = np.empty(len(found), np.uint64)
    number[order] = np.arange(len(found), dtype=np.uint64)
    edges = np.flatnonzero(np.diff(often[order])) + 1
    lists = [pack_dense(part) for part in np.split(found[order], edges)]
    return lists, blocks.pack_small(number[place])


def unpack_words(lists: Iterable[bytes], numbers: bytes) -> np.ndarray:
    found = np.concatenate([unpack_dense(part) for part in lists])
    return found[blocks.unpack_small(numbers).astype(np.int64)]


def blocks_of(docs: DataFrame, key: str, block_bytes: int) -> DataFrame:
    """Blocks of about ``block_bytes`` of ``docs(doc_id, text)``, from the rows as tasks read them.

    A block is numbered by its task and its place there. A text that is longer is by itself.
    """
    names = ["block", "doc_ids", "sizes", "lists", "numbers"]

    def block(number: int, ids: list[pa.Array], words: list[Words]) -> pa.RecordBatch:
        lists, numbers = pack_words(np.concatenate([w.hashes for w in words]))
        sizes = np.concatenate([w.sizes for w in words])
        ids = pa.concat_arrays(ids)
        columns = [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([sizes], pa.list_(pa.int64())),
            pa.array([lists], pa.list_(pa.binary())),
            pa.array([numbers], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 33, 0
        ids: list[pa.Array] = []
        words: list[Words] = []
        for batch in batches:
            data, ends = string_bytes(batch.column(1))
            for start, stop in byte_ranges(ends, block_bytes):
                more = int(ends[stop] - ends[start])
                if ids and size + more > block_bytes:
                    yield block(number, ids, words)
                    number, size, ids, words = number + 1, 0, [], []
                ids.append(batch.column(0).slice(start, stop - start))
                words.append(words_of(data[ends[k] : ends[k + 1]].tobytes() for k in range(start, stop)))
                size += more
        if ids:
            yield block(number, ids, words)
        give_back()

    layout = f"block long, doc_ids array<{key}>, sizes array<long>, lists array<binary>, numbers binary"
    return docs.select("doc_id", "text").mapInArrow(run, layout)


class Grams:
    """The n-grams of a block of texts: for every order, one hash per word it ends in.

    ``0`` stands where a text has too few words before; the n-gram of no words, which counts
    all words, is ``EMPTY``.
    """

    EMPTY = np.uint64(1)

    def __init__(self, words: Words, order: int) -> None:
        hashes, self.sizes = words
        starts = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.place = np.arange(len(hashes)) - starts
        self.hashes = [mix(hashes + np.uint64(2))]
        for n in range(2, order + 1):
            longer = np.zeros(len(hashes), np.uint64)
            before = self.hashes[-1][:-1] * np.uint64(0x9E3779B97F4A7C15)
            longer[1:] = mix(before + hashes[1:] + np.uint64(n))
            longer[self.place < n - 1] = 0
            self.hashes.append(longer)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that occur, ascending, and how often."""
        found, counts = np.unique(np.concatenate([[self.EMPTY], *self.hashes]), return_counts=True)
        counts[found == self.EMPTY] = len(self.place)
        return found[found != 0], counts[found != 0].astype(np.uint64)

    def sums(self, told: np.ndarray) -> tuple[float, np.ndarray]:
        """Of all words, and for every order and word of its n-gram, from ``counted``'s sums."""
        every = np.concatenate([[self.EMPTY], *self.hashes])
        every.sort()
        found = every[np.append(True, every[1:] != every[:-1])]
        del every
        total = np.zeros(len(found), np.float64)
        total[found != 0] = told
        of = np.empty((len(self.hashes), len(self.place)))
        # Order by order, so that a block's hashes are never sorted with their places at once.
        for k, hashes in enumerate(self.hashes):
            ascending = np.argsort(hashes)
            of[k, ascending] = total[np.searchsorted(found, hashes[ascending])]
        return total[np.searchsorted(found, self.EMPTY)], of


def _score_words(grams: Grams, everything: float, of: np.ndarray, backoff: float, least: int) -> tuple:
    """Millionths of the logarithm of each word's score, and the orders left out."""
    order, n = of.shape
    score, left_out = np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    for k in range(order, 0, -1):
        there = open_ & (grams.hashes[k - 1] != 0)
        use = there & (of[k - 1] >= (least if k > 1 else 1))
        at = np.flatnonzero(use)
        context = of[k - 2][at - 1] if k > 1 else everything
        share = of[k - 1][at].astype(np.float64) / context
        lost = left_out[at]
        score[at] = np.rint(1e6 * np.log(share * backoff ** lost.astype(np.float64))).astype(np.int64)
        open_ &= ~use
        left_out[there & ~use] += 1
    return score, left_out


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    backoff: float = BACKOFF,
    least: int = LEAST_COUNT,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_backoffs`` and ``log_score`` of every row.

    ``n_backoffs`` is the number of orders left out over all words. A null or empty text has
    no words and a score of 0. Rows that repeat an id are scored each; other columns are
    ignored; an empty table gives an empty result. Rows must come the same whenever they are
    read, as those of files do: what a lost task had cut into blocks is cut again.
    """
    small_batches(docs.sparkSession)
    key = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    text_bytes = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, text_bytes // 6 * order // BUCKET_GRAMS)
    # Words are held as numbers, so blocks are twice as large as those of texts: fewer n-grams
    # are in several.
    dealt = blocks_of(picked, key, 2 * blocks.BLOCK_BYTES).groupBy("block")

    def state(group: tuple, block: pa.Table) -> pa.Table:
        found, counts = _grams(block, order).counted()
        asked = requests(group[0].as_py(), found, counts, 64, buckets, DENSE)
        give_back()
        return pa.Table.from_pandas(asked, asked_schema, preserve_index=False)

    def score(block: pa.Table, sums: pa.Table) -> pa.Table:
        grams = _grams(block, order)
        counts = grams.sums(sums_of(sums.to_pandas(), DENSE))
        score, left_out = _score_words(grams, *counts, backoff, least)
        ends = np.cumsum(grams.sizes)
        run = [np.append(0, np.cumsum(v)) for v in (score, left_out)]
        by_doc = [r[ends] - r[ends - grams.sizes] for r in run]
        ids = block.column("doc_ids").combine_chunks().flatten()
        columns = [ids, *map(pa.array, (grams.sizes, by_doc[1], by_doc[0] / 1e6))]
        del grams, counts, score, left_out, run
        give_back()
        return pa.Table.from_arrays(columns, ["doc_id", "n_words", "n_backoffs", "log_score"])

    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    asked_schema = pa.schema(list(zip([f.split()[0] for f in REQUESTS.split(", ")], kinds, strict=True)))
    told = answers(dealt.applyInArrow(state, REQUESTS), DENSE).groupBy("block")
    return dealt.cogroup(told).applyInArrow(score, SCORES.format(key=key))


def _grams(block: pa.Table, order: int) -> Grams:
    """The n-grams of the one block in ``block``."""
    sizes = block.column("sizes").combine_chunks().flatten().to_numpy()
    hashes = unpack_words(block.column("lists")[0].as_py(), block.column("numbers")[0].as_py())
    return Grams(Words(hashes, sizes), order)


def exploded_grams(docs: DataFrame, order: int) -> DataFrame:
    """A row for each different ending of ``order`` words in each row of ``docs(row, text)``.

    ``times`` is how often it occurs; ``grams`` has the n-grams of one to ``order`` words that
    end there, ``contexts`` those of one to ``order - 1`` words before the last one. 0 stands
    where the text has too few words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_order = np.stack(Grams(words_of([text.encode()]), order).hashes, 1).view(np.int64)
                before = np.zeros_like(by_order[:, : order - 1])
                before[1:] = by_order[:-1, : order - 1]
                ends, times = np.unique(np.hstack([by_order, before]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": np.full(len(ends), row, np.int64),
                        "times": times,
                        "grams": pa.array(list(ends[:, :order]), pa.list_(pa.int64())),
                        "contexts": pa.array(list(ends[:, order:]), pa.list_(pa.int64())),
                    }
                )

    layout = "row long, times long, grams array<long>, contexts array<long>"
    return docs.select("row", "text").mapInArrow(run, layout)


def _relational_score(order: int, everything: float, backoff: float, least: int) -> tuple[Column, Column]:
    """Millionths of the logarithm of a word's score, and the orders left out, from its counts."""
    score, lost, none = F.lit(None).cast("long"), F.lit(None).cast("int"), F.lit(0).cast("long")
    for k in range(1, order + 1):  # the longest is put in front last
        here = F.coalesce(F.col(f"g{k}"), none)
        context = F.lit(everything) if k == 1 else F.coalesce(F.col(f"c{k - 1}"), none).cast("double")
        # Longer orders that the text has words for, and that do not count.
        above = sum((F.col("present") >= n).cast("int") for n in range(k + 1, order + 1)) if k < order else F.lit(0)
        share = here / context * F.pow(F.lit(backoff), above.cast("double"))
        use = here >= (least if k > 1 else 1)
        score = F.when(use, F.rint(1e6 * F.log(share)).cast("long")).otherwise(score)
        lost = F.when(use, above).otherwise(lost)
    return score, lost


def score_relational(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    backoff: float = BACKOFF,
    least: int = LEAST_COUNT,
) -> DataFrame:
    """The rows of ``score_documents``, from n-grams as rows."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), text_of(text).alias("text")
    )
    numbered = stored(numbered, "numbered")
    grams = stored(exploded_grams(numbered, order), "grams")
    everything = float(grams.agg(F.sum("times")).first()[0] or 0)
    counted = grams.select("times", F.explode("grams").alias("gram")).where("gram <> 0")
    counts = stored(counted.groupBy("gram").agg(F.sum("times").alias("n")), "counts")

    names = [f"g{k}" for k in range(1, order + 1)] + [f"c{k}" for k in range(1, order)]
    asked = grams.withColumn("ending", F.monotonically_increasing_id())
    present = F.size(F.filter("grams", lambda g: g != 0))
    asked = asked.select(
        "row", "ending", "times", present.alias("present"),
        F.posexplode(F.concat("grams", "contexts")).alias("kind", "gram"),
    )
    # Both sides are files, so that Spark can split an n-gram that every document has.
    told = asked.where("gram <> 0").join(counts, "gram")
    by_kind = [F.max(F.when(F.col("kind") == k, F.col("n"))).alias(name) for k, name in enumerate(names)]
    scored = told.groupBy("row", "ending", "times", "present").agg(*by_kind)
    score, lost = _relational_score(order, everything, backoff, least)
    sums = scored.groupBy("row").agg(
        F.sum("times").alias("n_words"),
        F.sum(F.col("times") * lost).alias("n_backoffs"),
        F.sum(F.col("times") * score).alias("millionths"),
    )
    whole = numbered.select("row", "doc_id").join(sums, "row", "left").fillna(0, ["n_words", "n_backoffs", "millionths"])
    return whole.select("doc_id", "n_words", "n_backoffs", (F.col("millionths") / 1e6).alias("log_score"))
