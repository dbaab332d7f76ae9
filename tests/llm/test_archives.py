import base64
import hashlib
import io
import struct
import zipfile
from collections import defaultdict

import pytest
from isoloir.llm import warc
from isoloir.llm.zip_archive import members, read_range, stored_members
from pyarrow import fs

PAGES = [
    (5, "http://a.example/x", "<p>é</p>"),
    (2, "http://b.example/ y\r\nWARC-Type: none", "<p>é</p>"),
    (2, "http://b.example/ y\r\nWARC-Type: none", "<p>é</p>"),
    (9, None, "<p>é</p>"),
    (3, "", None),
    (4, "http://c.example/", ""),
    (7, "http://d.example/中", "WARC/1.1\r\n\r\n" * 3),
    (8, "http://e.example/", "z" * 3_000_000),
    (None, "http://f.example/", "<p>é</p>"),
    (None, "http://g.example/", "only"),
    (11, "http://h.example/", "<p>e</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "x", 1) for p in PAGES]
    schema = "page_id long, url string, html string, package string, original int"
    return spark.createDataFrame(rows, schema).repartition(3)


def want(pages=PAGES):
    ids, used = defaultdict(list), set()
    for i, _, html in pages:
        ids[html or ""].append(i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        first = min((x for x in ids[html or ""] if x is not None), default=None)
        response = i == first and data not in used
        if response:
            used.add(data)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


def described(records):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str
    )


def test_records_come_back(pages):
    manifest = warc.write_packages(pages)
    records = warc.read_records(manifest).collect()
    assert described(records) == want()
    payloads = {i: (html or "").encode() for i, _, html in PAGES if i is not None}
    for r in records:
        if r.record_type == "revisit":
            assert r.payload is None
        elif r.page_id is not None:
            assert bytes(r.payload) == payloads[r.page_id]
    assert {r.target_uri for r in records} >= {"http://b.example/%20y%0D%0AWARC-Type:%20none", ""}


def test_small_packages_and_ranges(pages):
    manifest = warc.write_packages(pages, package_records=2)
    assert manifest.count() >= 6
    assert described(warc.read_records(manifest, payload=False, range_bytes=1).collect()) == want()


def test_short_payloads_are_all_responses(pages):
    records = warc.read_records(warc.write_packages(pages, revisit_from=9)).collect()
    assert {r.payload_bytes for r in records if r.record_type == "revisit"} == {9}


def test_half_of_all_pages_are_one_payload(spark):
    """Also by pages without an id, and by rows that repeat the smallest one."""
    rows = [(k, f"http://h{k}.example/", "empty" if k % 2 else f"page {k}") for k in range(1, 400)]
    rows += [(1, "http://h1.example/", "empty")] * 5 + [(None, "http://n.example/", "empty")] * 3
    rows += [(None, f"http://o{k % 2}.example/", "no id") for k in range(4)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = described(warc.read_records(warc.write_packages(docs), payload=False).collect())
    assert got == want(rows) and sum(r[3] == "response" for r in got) == 201


def test_only_repeated_payloads_are_shuffled(spark):
    rows = [(k, "u", "twice" if k < 20 else f"page {k}") for k in range(5000)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = warc.with_originals(docs, "page_id", "url", "html")
    assert found.where("first").count() == 4981 and found.where("original = 0").count() == 20


def test_no_pages(pages):
    manifest = warc.write_packages(pages.where("false"))
    assert warc.read_records(manifest).collect() == []


def test_packages_are_plain_zip_files_of_plain_gzip_members(pages):
    import gzip

    row = warc.write_packages(pages.coalesce(1)).orderBy("records").collect()[-1]
    system, path = fs.FileSystem.from_uri(row.package)
    with system.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
        assert archive.namelist() == [warc.ARCHIVE, warc.INDEX]
        assert {i.compress_type for i in archive.infolist()} == {zipfile.ZIP_STORED}
        data = gzip.decompress(archive.read(warc.ARCHIVE))
    assert data.count(b"WARC-Record-ID") == row.records


def archive(entries, **kind):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = kind.get("comment", b"")
        for name, data, method, large in entries:
            with z.open(zipfile.ZipInfo(name) if method is None else _info(name, method), "w", force_zip64=large) as m:
                m.write(data)
    return out


def _info(name, method):
    info = zipfile.ZipInfo(name)
    info.compress_type = method
    return info


@pytest.mark.parametrize("comment", [b"", b"note PK\x05\x06" + b"x" * 300])
def test_members_of_an_archive(comment):
    entries = [
        ("a.txt", b"first", zipfile.ZIP_STORED, False),
        ("é.gz", b"second" * 9, zipfile.ZIP_STORED, True),
        ("packed", b"third" * 99, zipfile.ZIP_DEFLATED, False),
        ("empty", b"", zipfile.ZIP_STORED, False),
    ]
    if comment:
        # A comment that looks like an end record is told apart by its length.
        entries = entries[:1]
    file = archive(entries, comment=comment)
    length = len(file.getvalue())
    found = members(file, length)
    assert [m.name for m in found] == [e[0] for e in entries]
    for member in stored_members(file, length):
        data = {e[0]: e[1] for e in entries}[member.name]
        assert read_range(file, member.start, member.size) == data


def as_zip64(plain):
    """The same archive with all sizes and places in ZIP64 records."""
    at = plain.rfind(b"PK\x05\x06")
    count, size, start = struct.unpack_from("<HII", plain, at + 10)
    directory, out, p = plain[start : start + size], b"", 0
    for _ in range(count):
        head = bytearray(directory[p : p + 46])
        n, extra, note = struct.unpack_from("<HHH", head, 28)
        packed, full, local = (*struct.unpack_from("<II", head, 20), struct.unpack_from("<I", head, 42)[0])
        name = directory[p + 46 : p + 46 + n]
        struct.pack_into("<II", head, 20, 0xFFFFFFFF, 0xFFFFFFFF)
        struct.pack_into("<I", head, 42, 0xFFFFFFFF)
        field = struct.pack("<HH3Q", 1, 24, full, packed, local)
        other = struct.pack("<HH2s", 0x9999, 2, b"zz")
        struct.pack_into("<H", head, 30, len(field) + len(other))
        struct.pack_into("<H", head, 32, 0)
        out += bytes(head) + name + other + field
        p += 46 + n + extra + note
    end = plain[:start] + out
    record = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, len(out), start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, len(end), 1)
    last = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return end + record + locator + last


def test_zip64_directory():
    plain = archive([("a", b"first", zipfile.ZIP_STORED, False), ("b", b"second", zipfile.ZIP_STORED, False)])
    large = as_zip64(plain.getvalue())
    found = members(io.BytesIO(large), len(large))
    assert [(m.name, read_range(io.BytesIO(large), m.start, m.size)) for m in found] == [
        ("a", b"first"), ("b", b"second")
    ]


def test_broken_archives_are_refused():
    with pytest.raises(ValueError, match="not a ZIP"):
        members(io.BytesIO(b"nothing"), 7)
    data = archive([("a", b"first", zipfile.ZIP_STORED, False)]).getvalue()
    broken = data.replace(b"PK\x01\x02", b"PK\x01\x03")
    with pytest.raises(ValueError, match="central directory"):
        members(io.BytesIO(broken), len(broken))


def test_changed_payload_is_noticed():
    import gzip

    record = gzip.decompress(warc.write_record(1, "http://a.example/", b"payload", None))
    with pytest.raises(ValueError, match="not what was written"):
        warc.parse_record(gzip.compress(record.replace(b"payload\r\n", b"pAyload\r\n")))
