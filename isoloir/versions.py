"""Versions of a stored table: whole or not at all, and never seen half done.

A table is a folder of data folders, each written once by one job under a name of its own, and
of numbered pointers. A pointer says which data folder holds each election, and which layers
were made of them. Readers take the pointer of the highest number, so that whatever a writer
does is seen when its pointer appears, all of it together, and what fails before that changes
nothing. A pointer is written aside and then renamed to its number; of two writers who go for
the same one, the second is told.

Layers stand in the same pointer with their scales and with the number of the stations they
were made of, so that one that stations have left behind is known to be so.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoloir.functions.columns import col
from isoloir.schema import ELECTION

POINTERS, DATA = "versions", "data"


class Outrun(RuntimeError):
    """Another writer has published the version that this one was going to be."""


@dataclass(frozen=True)
class Pointer:
    """What a version of the table is. Folders are named below the table's own."""

    number: int = 0
    partition: str = ELECTION
    #: The data folder of each partition value that has rows.
    folders: dict[str, str] = field(default_factory=dict)
    #: The version in which the folders changed last.
    stations: int = 0
    #: For each layer its data folder, its scales, and the ``stations`` it was made of.
    layers: dict[str, dict] = field(default_factory=dict)


class _Files:
    """The few things asked of whatever file system a table lies on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.base = path.rstrip("/")
        self.system = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        if not self.system.exists(at):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(at)]

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> bool:
        """False if ``to`` is there already."""
        fs = self.jvm.org.apache.hadoop.fs
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = fs.FileContext.getFileContext(self.system.getUri(), self.conf)
        try:
            source, target = (self.system.makeQualified(self.path(n)) for n in (name, to))
            context.rename(source, target, none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _numbers(files: _Files) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names(POINTERS) if n[0].isdigit())


def current(spark: SparkSession, path: str, version: int | None = None) -> Pointer | None:
    """The pointer of a version, the latest if none is named; ``None`` where there is no table."""
    files = _Files(spark, path)
    numbers = _numbers(files)
    if version is not None and version not in numbers:
        raise ValueError(f"{path} has no version {version}; it has {numbers}")
    if not numbers:
        return None
    return Pointer(**json.loads(files.read(f"{POINTERS}/{version or numbers[-1]}.json")))


def _publish(spark: SparkSession, path: str, pointer: Pointer) -> Pointer:
    files, aside = _Files(spark, path), f"{POINTERS}/_{uuid.uuid4().hex}"
    files.write(aside, json.dumps(asdict(pointer)))
    if not files.rename(aside, f"{POINTERS}/{pointer.number}.json"):
        files.remove(aside)
        raise Outrun(f"version {pointer.number} of {path} has been published by another writer")
    return pointer


def _clustered(df: DataFrame, partition: str, cluster_by: Sequence[str]) -> DataFrame:
    if not cluster_by:
        return df
    keys = [col(partition), *[col(c) for c in cluster_by]]
    return df.hint("rebalance", *keys).sortWithinPartitions(*keys)


def publish_stations(
    df: DataFrame,
    path: str,
    elections: Iterable[object] | None = None,
    partition: str = ELECTION,
    cluster_by: Sequence[str] = (),
    bloom_on: Sequence[str] = (),
) -> Pointer:
    """A new version in which the elections of ``df`` replace their stored rows, all together.

    One job writes them, however many they are, and ``df`` is computed once. With
    ``elections`` exactly those are replaced: one that has no rows in ``df`` has none
    afterwards, and rows of others are not written. ``cluster_by`` sorts for later reads;
    ``bloom_on`` adds filters by which reads skip row groups that hold none of the wanted
    values. A null partition value is refused. Readers of earlier versions are not disturbed.
    """
    spark, data = df.sparkSession, f"{DATA}/{uuid.uuid4().hex}"
    before = current(spark, path) or Pointer(partition=partition)
    if before.partition != partition:
        raise ValueError(f"{path} is partitioned by {before.partition!r}, not {partition!r}")
    named = None if elections is None else [str(e) for e in elections]
    rows = df if named is None else df.where(col(partition).cast("string").isin(named))
    writer = _clustered(rows, partition, cluster_by).write.partitionBy(partition)
    for name in bloom_on:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(f"{path.rstrip('/')}/{data}")
    files, prefix = _Files(spark, path), f"{partition}="
    found = {n.removeprefix(prefix): f"{data}/{n}" for n in files.names(data) if n.startswith(prefix)}
    if any(v == "__HIVE_DEFAULT_PARTITION__" or "%" in v for v in found):
        files.remove(data)
        raise ValueError(f"cannot name a folder after a value of {partition!r}: {sorted(found)}")
    kept = {v: f for v, f in before.folders.items() if v not in (named or ())}
    number = before.number + 1
    return _publish(spark, path, replace(before, number=number, stations=number, folders={**kept, **found}))


def read_published(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    election: object | None = None,
    version: int | None = None,
) -> DataFrame:
    """The rows of a version, the latest if none is named, with the partition column last.

    ``schema`` has all columns; without it, they are read from the files. With ``election``
    only its folder is read. What is published meanwhile does not change what was asked for.
    """
    pointer = current(spark, path, version)
    if pointer is None:
        raise ValueError(f"{path} has no version")
    if schema is None and not pointer.folders:
        raise ValueError(f"version {pointer.number} of {path} has no rows: name the schema")
    chosen = pointer.folders if election is None else {v: f for v, f in pointer.folders.items() if v == str(election)}
    by_data: dict[str, list[str]] = {}
    for folder in (chosen or dict(list(pointer.folders.items())[:1])).values():
        by_data.setdefault(folder.rsplit("/", 1)[0], []).append(f"{path.rstrip('/')}/{folder}")
    parts = []
    for data, folders in by_data.items():
        reader = spark.read.option("basePath", f"{path.rstrip('/')}/{data}")
        parts.append((reader if schema is None else reader.schema(schema)).parquet(*folders))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out if chosen else out.where(F.lit(False))


def publish_layer(
    points: DataFrame, path: str, name: str, scales: dict, stations: int
) -> Pointer:
    """A new version that has the layer ``name``: its points and its scales, together.

    ``stations`` is the version that the layer was made of. Stations that were published
    meanwhile stay as they are, and the layer counts as behind them.
    """
    spark, data = points.sparkSession, f"{DATA}/{uuid.uuid4().hex}"
    points.write.parquet(f"{path.rstrip('/')}/{data}")
    before = current(spark, path)
    if before is None:
        raise ValueError(f"{path} has no stations")
    layer = {"folder": data, "scales": scales, "stations": stations}
    return _publish(spark, path, replace(before, number=before.number + 1, layers={**before.layers, name: layer}))


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the latest ``keep`` versions, and data that none of those refers to.

    Readers of a removed version fail, and so does a writer whose data are not in a pointer
    yet: call it when nobody writes. Returns the numbers that are gone.
    """
    files = _Files(spark, path)
    numbers = _numbers(files)
    gone, kept = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
    used = set()
    for number in kept:
        pointer = current(spark, path, number)
        folders = [*pointer.folders.values(), *(x["folder"] for x in pointer.layers.values())]
        used |= {folder.split("/")[1] for folder in folders}
    for number in gone:
        files.remove(f"{POINTERS}/{number}.json")
    for name in set(files.names(DATA)) - used:
        files.remove(f"{DATA}/{name}")
    return gone
