"""Reading and writing the directory of a ZIP file, ZIP64 included, by ranges.

A reader gets the end record, from there the central directory, and from that the
place of every stored member; members themselves are not read. The layouts are those of
the published ZIP file format specification (APPNOTE).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from typing import BinaryIO

#: Fixed values of the format.
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
LONGEST_COMMENT = 0xFFFF


@dataclass(frozen=True)
class Member:
    """A member's name, method (0: stored), and the place of its bytes."""

    name: str
    method: int
    start: int
    size: int


def read_range(file: BinaryIO, start: int, size: int) -> bytes:
    file.seek(start)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"the archive ends within bytes {start} to {start + size}")
    return data


def _directory(file: BinaryIO, length: int) -> tuple[int, int, int]:
    """Start, size and number of entries of the central directory."""
    tail_at = max(0, length - LONGEST_COMMENT - 22)
    tail = read_range(file, tail_at, length - tail_at)
    at = tail.rfind(END)
    # A comment follows the record; bytes of a comment that look like a record do not end so.
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 != count and FULL32 not in (size, start):
        return start, size, count
    locator = read_range(file, tail_at + at - 20, 20)
    if locator[:4] != LOCATOR64:
        raise ValueError("a ZIP64 archive without its locator")
    record = read_range(file, struct.unpack_from("<Q", locator, 8)[0], 56)
    if record[:4] != END64:
        raise ValueError("a ZIP64 archive without its end record")
    count, size, start = struct.unpack_from("<QQQ", record, 32)
    return start, size, count


def _large(extra: bytes, wanted: list[int]) -> list[int]:
    """Values that are too large for their field stand in the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(values) if v == FULL32 else v for v in wanted]
        at += 4 + size
    return wanted


def members(file: BinaryIO, length: int) -> list[Member]:
    """Every member, in the order of the central directory."""
    start, size, count = _directory(file, length)
    directory, at, found = read_range(file, start, size), 0, []
    for _ in range(count):
        if directory[at : at + 4] != ENTRY:
            raise ValueError("a broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, name_len, extra_len, note_len = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + name_len]
        extra = directory[at + 46 + name_len : at + 46 + name_len + extra_len]
        plain, packed, local = _large(extra, [plain, packed, local])
        head = read_range(file, local, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header at {local}")
        # Name and extra field of the local header have lengths of their own.
        skip = sum(struct.unpack_from("<HH", head, 26))
        coding = "utf-8" if flags & 0x800 else "cp437"
        found.append(Member(name.decode(coding), method, local + 30 + skip, packed))
        at += 46 + name_len + extra_len + note_len
    return found


def stored_members(file: BinaryIO, length: int) -> list[Member]:
    """Members whose bytes stand in the archive as they are."""
    return [m for m in members(file, length) if m.method == 0]
