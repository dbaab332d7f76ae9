"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal text are a group, and a group goes to one shard. Every group has a
vector of bytes, tokens and rows; the largest are placed first, each on the shard where the
dot product of its vector with what the shard has left is highest. Bytes weigh most, so their
sums are what comes out near equal.

What is placed is bounded, however many documents there are. Groups are dealt by their hash
to ``BUCKETS`` buckets, whose vectors are summed where the rows are. A group of which a
dimension is more than ``HEAVY`` of the whole is placed by itself, and there are at most
three times ``1 / HEAVY`` of those; only rows of buckets that large are looked through for
them. The rest of a bucket is placed as one. A group that alone would fill more than a shard
is split by the hash of its rows into parts of half a shard.

Rows are numbered within a shard by the counts of hash ranges, so that no task has to see a
shard, and are written once, into the shard's folder, with their number.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoloir.llm.common import free_name, stored, text_of
from isoloir.session import scratch_folder

SHARDS = 16
LAW = "bytes"
BUCKETS = 1 << 14
HEAVY = 1 / 4096
#: What a dimension counts in the dot product: bytes, tokens, rows.
WEIGHTS = (1.0, 0.05, 0.05)
#: Bytes of text that rows of one hash range have, about.
RANGE_BYTES = 16 << 20
WORD = r"[^\x20\x09-\x0D]+"

_NONE = -1


def size_of(text: str) -> Column:
    """Bytes of the text in UTF-8 and one; a null has none."""
    return F.octet_length(text_of(text)).cast("long") + 1


def words_of(text: str) -> Column:
    """Words as tokens; another count can be given instead."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def place(vectors: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """The shard of each vector, the largest placed first; equal products go to the first shard."""
    capacity = np.maximum(vectors.sum(0) / shards, 1e-9)
    share = vectors / capacity
    left = np.ones((shards, vectors.shape[1]))
    found = np.zeros(len(vectors), np.int64)
    weighted = share * np.array(weights)
    for k in np.argsort(-weighted.sum(1), kind="stable").tolist():
        found[k] = shard = int(np.argmax(left @ weighted[k]))
        left[shard] -= share[k]
    return found


def _vector(rows: DataFrame, *keys: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("bytes", "tokens", "rows")]
    return rows.groupBy(*keys).agg(*sums)


def _numbers(rows: list) -> np.ndarray:
    return np.array([(r["bytes"], r["tokens"], r["rows"]) for r in rows], np.float64).reshape(-1, 3)


def placements(
    measured: DataFrame, shards: int, buckets: int = BUCKETS, heavy: float = HEAVY
) -> tuple[DataFrame, DataFrame]:
    """Where groups go, from rows of ``group``, ``row_hash``, ``bytes``, ``tokens``, ``rows``.

    The first table has ``group`` and ``parts`` of the groups placed by themselves, the second
    the ``shard`` of every ``bucket`` and of every ``group`` and ``part``, where what does not
    apply is -1. Both have a bounded number of rows.
    """
    spark = measured.sparkSession
    bucket = _bucket(F.col("group"), buckets).alias("bucket")
    dealt = measured.select("*", bucket)
    # At most one row for each bucket.
    sums = _vector(dealt, "bucket").collect()
    vectors = _numbers(sums)
    total = np.maximum(vectors.sum(0), 1)
    of_bucket = {r["bucket"]: v for r, v in zip(sums, vectors, strict=True)}
    large = [b for b, v in of_bucket.items() if (v / total > heavy).any()]
    groups: list = []
    if large:
        wanted = spark.createDataFrame([(b,) for b in large], "bucket int")
        # Fewer rows than three times 1 / heavy, in both tables.
        inside = _vector(dealt.join(F.broadcast(wanted), "bucket", "left_semi"), "bucket", "group")
        over = [F.col(c) > heavy * float(t) for c, t in zip(("bytes", "tokens", "rows"), total, strict=True)]
        groups = inside.where(over[0] | over[1] | over[2]).collect()
    parts = {}
    for r, v in zip(groups, _numbers(groups), strict=True):
        of_bucket[r["bucket"]] = of_bucket[r["bucket"]] - v
        fill = (v / total).max() * shards
        parts[r["group"]] = 1 if fill <= 1 else math.ceil(2 * fill)
    alone = spark.createDataFrame(list(parts.items()), "group long, parts int")
    split = {g: n for g, n in parts.items() if n > 1}
    items = [(_NONE, r["group"], 0) for r in groups if r["group"] not in split]
    found = [_numbers([r for r in groups if r["group"] not in split])]
    if split:
        # At most so many groups as there are shards in each dimension.
        rows = measured.join(F.broadcast(alone.where("parts > 1")), "group")
        rows = rows.select("*", _part(F.col("row_hash"), F.col("parts")).alias("part"))
        cut = _vector(rows, "group", "part").collect()
        items += [(_NONE, r["group"], r["part"]) for r in cut]
        found.append(_numbers(cut))
    rest = {b: v for b, v in of_bucket.items() if v[2] > 0}
    items += [(b, 0, _NONE) for b in rest]
    found.append(np.array(list(rest.values()), np.float64).reshape(-1, 3))
    order = sorted(range(len(items)), key=items.__getitem__)
    vectors = np.concatenate(found)[order]
    rows = [(*items[k], int(s)) for k, s in zip(order, place(vectors, shards), strict=True)]
    return alone, spark.createDataFrame(rows, "bucket int, group long, part int, shard int")


def _bucket(group: Column, buckets: int) -> Column:
    return F.pmod(group, F.lit(buckets)).cast("int")


def _part(row_hash: Column, parts: Column) -> Column:
    return F.pmod(row_hash, parts.cast("long")).cast("int")


def group_of(text: str) -> Column:
    return F.xxhash64(text_of(text))


def row_hash_of(docs: DataFrame) -> Column:
    """A hash of all that can be hashed of a row."""
    fields = [f.name for f in docs.schema if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in fields])


def assign(rows: DataFrame, group: Column, row_hash: Column, placed: tuple[DataFrame, DataFrame], to: str) -> DataFrame:
    """``rows`` with their shard in column ``to``, from the tables of ``placements``."""
    g, parts, part, bucket = (free_name(rows, c) for c in ("group", "parts", "part", "bucket"))
    alone, shards = placed
    # Both tables are bounded, see there.
    found = rows.withColumn(g, group).join(F.broadcast(alone.toDF(g, parts)), g, "left")
    lone = F.col(parts).isNotNull()
    keys = {
        part: F.when(lone, _part(row_hash, F.col(parts))).otherwise(_NONE),
        bucket: F.when(lone, F.lit(_NONE)).otherwise(_bucket(F.col(g), BUCKETS)),
        g: F.when(lone, F.col(g)).otherwise(0),
    }
    found = found.withColumns(keys).join(F.broadcast(shards.toDF(bucket, g, part, to)), [bucket, g, part], "left")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], to)


def write_shards(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    tokens: Column | None = None,
    shards: int = SHARDS,
    range_bytes: int = RANGE_BYTES,
) -> str:
    """Write every row of ``docs`` to the folder of its shard below ``path``; returns ``path``.

    A folder is named ``shard=K`` and its rows have all columns of ``docs`` and ``slot``, from
    0 without gaps within the shard; a column of ``docs`` of one of these two names is refused.
    ``tokens`` is what counts as a row's tokens (its words, unless given). Equal texts share a
    shard unless they alone would fill more than one. A null text counts as empty and has size
    1; rows that repeat are rows each; an empty table writes no shard. Without ``path`` a new
    folder in the shared scratch folder is taken. Rows must come the same whenever they are
    read, as those of files do.
    """
    taken = {c.lower() for c in docs.columns} & {"shard", "slot"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are needed for the result")
    path = scratch_folder(docs.sparkSession, "shards") if path is None else path
    row_hash, span, rank, first = (free_name(docs, c) for c in ("row_hash", "span", "rank", "first"))
    measured = docs.select(
        group_of(text).alias("group"),
        row_hash_of(docs).alias("row_hash"),
        size_of(text).alias("bytes"),
        (words_of(text) if tokens is None else tokens).alias("tokens"),
        F.lit(1).cast("long").alias("rows"),
    )
    # A few numbers a row: whatever is counted, texts are read once for it and once to be written.
    measured = stored(measured, "measured")
    placed = placements(measured, shards)
    total = measured.agg(F.sum("bytes")).first()[0] or 0
    spans = max(1, math.ceil(total / shards / range_bytes))

    def dealt(rows: DataFrame, group: Column, name: str) -> DataFrame:
        """With the shard, and the range of row hashes within it."""
        found = assign(rows, group, F.col(name), placed, "shard")
        return found.withColumn(span, F.pmod(F.col(name), F.lit(spans)).cast("int"))

    counts = dealt(measured, F.col("group"), "row_hash").groupBy("shard", span).agg(F.count("*").alias("n"))
    counts = stored(counts, "ranges")
    so_far = Window.partitionBy("shard").orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", span, F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias(first))
    here = Window.partitionBy("shard", span).orderBy(row_hash)
    sharded = dealt(docs.withColumn(row_hash, row_hash_of(docs)), group_of(text), row_hash)
    ranked = sharded.withColumn(rank, F.row_number().over(here).cast("long") - 1)
    numbered = ranked.join(firsts, ["shard", span])
    slot = (F.col(first) + F.col(rank)).alias("slot")
    out = numbered.select("shard", *[F.col(f"`{c}`") for c in docs.columns], slot)
    out.write.partitionBy("shard").parquet(path)
    return path


def read_shards(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The written rows: ``columns``, those of the documents, then ``slot`` and ``shard``."""
    schema = T.StructType([*columns, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def shard_table(written: DataFrame, text: str = "text", law: str = LAW) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``
    of rows read from shards. Under this law an added shard would change where rows go, so
    ``grown_shard`` is null."""
    return written.select(
        "doc_id",
        size_of(text).alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        F.lit(law).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
