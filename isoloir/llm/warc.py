"""WARC records in ZIP packages: written once, then read by ranges.

A package is a ZIP with two stored members: ``archive/data.warc.gz``, one gzip
member per record, and ``indexes/index.cdx``, one line per record with its place.
Readers get the ZIP's directory, the index, and then ranges of the archive member;
nothing is extracted, and the ranges of one package are dealt out to many tasks.

Packages lie in the shared folder that ``spark.checkpoint.dir`` names, or in any folder
whose scheme ``pyarrow.fs`` opens on the executors. A task writes under names of its own;
only packages in the manifest, which has what successful attempts wrote, are read, so
a lost executor or a second attempt leaves nothing that counts.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoloir.llm.common import rows_of, stored, text_of
from isoloir.llm.exact_dedup import may_repeat
from isoloir.llm.zip_archive import read_range, stored_members
from isoloir.session import scratch_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: A package is closed once it holds so many bytes or records.
PACKAGE_BYTES = 32 << 20
PACKAGE_RECORDS = 50_000
#: Records that lie together are read by ranges of about so many bytes.
RANGE_BYTES = 2 << 20
#: A task reads ranges of about so many bytes in all.
TASK_BYTES = 64 << 20
#: Responses with smaller payloads are all kept.
REVISIT_FROM = 0
DATE = "2000-01-01T00:00:00Z"

MANIFEST = "package string, bytes long, records long"
RANGES = "package string, start long, size long, lengths array<long>"
RECORDS = (
    "page_id long, package string, record_at long, record_type string, refers_to long,"
    " target_uri string, payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record, gzipped. A revisit has the HTTP head of its page but no payload."""
    uri = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head.insert(5, f"WARC-Refers-To: {refers_to}")
        head.insert(5, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse_record(data: bytes) -> dict:
    """Type, ids, uri, payload size and digest; both are checked where it has its payload."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload), base32_sha1(payload)) != (size, digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what was written")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "refers_to": page_of(fields["WARC-Refers-To"]) if revisit else None,
        "target_uri": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if revisit else payload,
    }


def _open(path: str) -> tuple:
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def with_originals(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``original`` and ``first``.

    Of pages with equal payloads the one with the smallest id is the original, ``first`` of
    them; null ids come last. Of rows that repeat the smallest id, one is the first.

    Only pages whose payload may have an equal are shuffled (``exact_dedup.may_repeat``), and
    the groups are stored, so that Spark can split a payload that very many pages have.
    """
    sha, none = F.sha1(F.encode("html", "UTF-8")), F.lit(None)
    picked = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        text_of(html).alias("html"),
    )
    hashed = stored(picked.select("page_id", sha.alias("sha")), "payloads")
    ask = may_repeat(hashed.select(F.xxhash64("sha").alias("h")), hashed.count())
    # Counted where the rows are; a payload that many pages have is a row per page and task.
    rows = hashed.where(ask(F.xxhash64("sha"))).groupBy("sha", "page_id").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("page_id").isNull(), F.col("page_id").alias("original"), F.col("n").alias("ties")))
    groups = rows.groupBy("sha").agg(least.alias("least"), F.sum("n").alias("n"))
    groups = stored(groups.where("n > 1").select("sha", "least.original", "least.ties"), "groups")

    tagged = picked.withColumn("sha", sha).withColumn("asked", ask(F.xxhash64("sha")))
    columns = ["page_id", "url", "html", "original", "first"]
    alone = tagged.where("NOT asked").withColumns({"original": none.cast("long"), "first": F.lit(True)})
    # A page that was asked for in vain has no group.
    compared = tagged.where("asked").join(groups, "sha", "left")
    compared = compared.withColumn("first", F.col("ties").isNull() | F.col("page_id").eqNullSafe(F.col("original")))
    tied = F.coalesce(F.col("first") & (F.col("ties") > 1), F.lit(False))
    place = F.row_number().over(Window.partitionBy("sha").orderBy("url"))
    again = compared.where(tied).withColumn("first", place == 1)
    parts = [alone, compared.where(~tied), again]
    return parts[0].select(columns).unionByName(parts[1].select(columns)).unionByName(parts[2].select(columns))


def write_packages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    package_bytes: int = PACKAGE_BYTES, package_records: int = PACKAGE_RECORDS,
    revisit_from: int = REVISIT_FROM,
) -> DataFrame:
    """The manifest of the written packages: path, bytes, records. One record per row.

    The payload is the html in UTF-8, null as empty; a null url has an empty target, and
    blanks and control characters of a url are percent-encoded. Of records with equal
    payloads of ``revisit_from`` bytes or more, the one with the smallest id (null last; of
    rows that repeat it, one) is a response, the others revisit it. Other columns
    of ``pages`` are ignored; an empty table writes no package.
    """
    folder = scratch_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        package = None
        for batch in batches:
            for row in rows_of(batch):
                if package is None:
                    package = _Package(fs, base, folder)
                payload = row["html"].encode()
                first = row["first"] or len(payload) < revisit_from
                refers_to = None if first else record_name(row["original"])
                package.add(write_record(row["page_id"], row["url"], payload, refers_to))
                if package.bytes >= package_bytes or len(package.lengths) >= package_records:
                    yield package.close()
                    package = None
        if package is not None:
            yield package.close()

    return stored(with_originals(pages, page_id, url, html).mapInArrow(run, MANIFEST), "manifest")


class _Package:
    """A ZIP that is being written: records stream into the archive member."""

    def __init__(self, fs: object, base: str, folder: str) -> None:
        name = f"{uuid.uuid4().hex}.wacz"
        self.path = f"{folder}/{name}"
        self.file = fs.open_output_stream(f"{base}/{name}")
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.lengths: list[int] = []
        self.bytes = 0

    def add(self, record: bytes) -> None:
        self.member.write(record)
        self.lengths.append(len(record))
        self.bytes += len(record)

    def close(self) -> pa.RecordBatch:
        self.member.close()
        lines, at = [], 0
        for n in self.lengths:
            lines.append(json.dumps({"offset": at, "length": n, "filename": ARCHIVE}))
            at += n
        self.zip.writestr(INDEX, "\n".join(lines))
        self.zip.close()
        self.file.close()
        return pa.RecordBatch.from_pydict(
            {"package": [self.path], "bytes": [self.bytes], "records": [len(self.lengths)]}
        )


def record_ranges(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges of the packages' archive members, whole records each, from directory and index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("package").to_pylist():
                fs, place = _open(path)
                with fs.open_input_file(place) as file:
                    found = {m.name: m for m in stored_members(file, file.size())}
                    index = read_range(file, found[INDEX].start, found[INDEX].size)
                yield _ranges(path, found[ARCHIVE].start, index, range_bytes)

    return manifest.select("package").mapInArrow(run, RANGES)


def _ranges(path: str, base: int, index: bytes, range_bytes: int) -> pa.RecordBatch:
    out: dict[str, list] = {"package": [], "start": [], "size": [], "lengths": []}
    for line in index.decode().split("\n"):
        entry = json.loads(line)
        start, length = base + entry["offset"], entry["length"]
        follows = out["start"] and out["start"][-1] + out["size"][-1] == start
        if follows and out["size"][-1] + length <= range_bytes:
            out["size"][-1] += length
            out["lengths"][-1].append(length)
        else:
            for name, value in zip(out, (path, start, length, [length]), strict=True):
                out[name].append(value)
    return pa.RecordBatch.from_pydict(out, schema=pa.schema(
        {"package": pa.string(), "start": pa.int64(), "size": pa.int64(), "lengths": pa.list_(pa.int64())}
    ))


def read_records(
    manifest: DataFrame, payload: bool = True, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Every record of the packages; ``payload`` is null for revisits, or if not asked for."""
    schema = pa.schema(
        {
            "page_id": pa.int64(), "package": pa.string(), "record_at": pa.int64(),
            "record_type": pa.string(), "refers_to": pa.int64(), "target_uri": pa.string(),
            "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                fs, place = _open(part["package"])
                with fs.open_input_file(place) as file:
                    data = read_range(file, part["start"], part["size"])
                at, records = 0, []
                for n in part["lengths"]:
                    record = parse_record(data[at : at + n])
                    record |= {"package": part["package"], "record_at": part["start"] + at}
                    if not payload:
                        record["payload"] = None
                    records.append(record)
                    at += n
                yield pa.RecordBatch.from_pylist(records, schema=schema)

    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    least = manifest.sparkSession.sparkContext.defaultParallelism
    # The rows are a few bytes each; the bytes they stand for set the number of tasks.
    dealt = record_ranges(manifest, range_bytes).repartition(max(least, total // TASK_BYTES), "package", "start")
    return dealt.mapInArrow(run, RECORDS)
