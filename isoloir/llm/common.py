"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloir.session import scratch_folder

#: Rows with whole texts that reach a Python worker at a time.
BATCH_ROWS = 500
#: ASCII white space, as a class for Java's and DuckDB's regular expressions.
BLANKS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read back.

    The files cut the lineage: a lost executor costs no earlier stage.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read.stored_at = path
    return read


def discard(*frames: DataFrame) -> None:
    """Remove the files of what ``stored`` returned, once nothing that is still to run reads them."""
    for frame in frames:
        spark = frame.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python workers get whole texts ``rows`` at a time, unless the session says how many.

    Ten thousand rows at a time, Spark's default, are some dozen megabytes of text, several
    times over, in every worker and in the executor beside it.
    """
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key) == default:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return the memory that a Python worker has freed, at the end of its task.

    Workers stay for later stages, beside an executor that wants the memory for those.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name where a column is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by the hash of ``key``: the same on every run."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def agreed_labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1), one row for each id that has one label only."""
    named = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    named = named.where("doc_id IS NOT NULL AND label IN (0, 1)")
    both = named.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    return both.where("label = most").drop("most")


def one_text_each(docs: DataFrame, named: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``label`` and ``text`` of each id in ``named``: of rows that repeat it, the least hash's."""
    said = F.col(text).cast("string")
    texts = docs.select(F.col(doc_id).alias("doc_id"), said.alias("text")).join(named, "doc_id")
    first = F.min(F.struct(F.xxhash64("text"), F.col("text").alias("text")))
    # Repeats are met where the rows are: a task sends one text for each id it has.
    return texts.groupBy("doc_id").agg(F.first("label").alias("label"), first.alias("kept")).select("label", "kept.text")


def rows_of(batch: pa.RecordBatch, slice_rows: int = 256) -> Iterator[dict]:
    """The rows of a batch, few at a time as Python objects."""
    for start in range(0, batch.num_rows, slice_rows):
        yield from batch.slice(start, slice_rows).to_pylist()


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column's texts, end to end, and the places where texts begin and end.

    A null is no bytes. Nothing is decoded, and nothing is copied but the places.
    """
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("")
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def string_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The column of texts that ``string_bytes`` would take apart."""
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, buffers)


def byte_ranges(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; one that is longer is by itself."""
    start, rows = 0, len(ends) - 1
    while start < rows:
        stop = int(np.searchsorted(ends, ends[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop
