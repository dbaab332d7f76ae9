"""Counts over a corpus of hashed n-grams, asked for and answered in blocks.

Documents are dealt out to blocks. A block states which different hashes it has and how
often; the statements are dealt by hash range to buckets, where the counts of all blocks are
summed; each block gets back the sums for its own hashes, in their order. What moves is one
number of a few bytes for each different n-gram of a block, in both directions. A hash that
every document has is one entry per block, so no bucket outgrows the others.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a block has, about, and different n-grams of all blocks in a bucket.
BLOCK_BYTES = 8 << 20
BUCKET_GRAMS = 1 << 20

REQUESTS = "block long, bucket long, hashes binary, counts binary"
ANSWERS = "block long, bucket long, sums binary"


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, after that number of bytes."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers, as the steps between them."""
    return pack(np.diff(values, prepend=np.zeros(1, np.uint64)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_small(values: np.ndarray) -> bytes:
    """Unsigned numbers, most of them small: all lowest bytes first, then the next, compressed."""
    raw = pack(values)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0]).T
    return raw[:1] + zstandard.ZstdCompressor(1).compress(planes.tobytes())


def unpack_small(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return unpack(data[:1] + planes.reshape(data[0], -1).T.tobytes())


_DENSE = struct.Struct("<IBQ")


def pack_dense(values: np.ndarray) -> bytes:
    """Different ascending numbers in about two bits each more than their spacing has.

    The Elias-Fano form: of every number's distance to the first, the lowest bits as they are,
    and the rest as ones in a row of bits, as many zeros apart as the rest grows.
    """
    if not len(values):
        return b""
    first, count = values[0], len(values)
    far = values - first
    bits = max(0, int(far[-1]).bit_length() - count.bit_length())
    rest = (far >> np.uint64(bits)).astype(np.int64) + np.arange(count)
    ones = np.zeros(int(rest[-1]) + 1, np.uint8)
    ones[rest] = 1
    whole, odd = divmod(bits, 8)
    low = far.astype("<u8").view(np.uint8).reshape(-1, 8)
    parts = [low[:, :whole].tobytes()]
    if odd:
        parts.append(np.packbits(np.unpackbits(low[:, whole : whole + 1], 1, odd, "little")).tobytes())
    return b"".join([_DENSE.pack(count, bits, int(first)), *parts, np.packbits(ones).tobytes()])


def unpack_dense(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    count, bits, first = _DENSE.unpack_from(data)
    whole, odd = divmod(bits, 8)
    low = np.zeros((count, 8), np.uint8)
    at = _DENSE.size
    low[:, :whole] = np.frombuffer(data, np.uint8, count * whole, at).reshape(count, whole)
    at += count * whole
    if odd:
        size = -(-count * odd // 8)
        split = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=count * odd).reshape(count, odd)
        low[:, whole] = np.packbits(split, 1, "little")[:, 0]
        at += size
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=at)))
    rest = (ones - np.arange(count)).astype(np.uint64)
    return (rest << np.uint64(bits)) + low.view("<u8").ravel() + np.uint64(first)


class Coding(NamedTuple):
    """How statements write their ascending hashes, and their counts and sums."""

    pack_hashes: Callable[[np.ndarray], bytes]
    unpack_hashes: Callable[[bytes], np.ndarray]
    pack_counts: Callable[[np.ndarray], bytes]
    unpack_counts: Callable[[bytes], np.ndarray]


PLAIN = Coding(pack_sorted, unpack_sorted, pack, unpack)
#: Smaller, for more work.
DENSE = Coding(pack_dense, unpack_dense, pack_small, unpack_small)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def block_of(key: Column, blocks: int) -> Column:
    """The block of a document, from a hash of its id."""
    return F.pmod(key, F.lit(blocks))


def block_count(text_bytes: int) -> int:
    return max(1, -(-text_bytes // BLOCK_BYTES))


def requests(
    block: int, hashes: np.ndarray, counts: np.ndarray, bits: int, buckets: int, coding: Coding = PLAIN
) -> pd.DataFrame:
    """The statement of a block, by bucket: its different hashes of ``bits`` bits, ascending."""
    # 31 leading bits times the number of buckets stay within 63 bits.
    lead = hashes >> np.uint64(bits - 31) if bits >= 31 else hashes << np.uint64(31 - bits)
    bucket = (lead * np.uint64(buckets)) >> np.uint64(31)
    found, first = np.unique(bucket, return_index=True)
    edges = np.append(first, len(hashes))
    parts = [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return pd.DataFrame(
        {
            "block": np.full(len(found), block, np.int64),
            "bucket": found.astype(np.int64),
            "hashes": [coding.pack_hashes(hashes[p]) for p in parts],
            "counts": [coding.pack_counts(counts[p]) for p in parts],
        }
    )


def answers(asked: DataFrame, coding: Coding = PLAIN) -> DataFrame:
    """For every statement, the sums over all blocks in the order of its hashes."""

    def sum_bucket(statements: pd.DataFrame) -> pd.DataFrame:
        hashes = [coding.unpack_hashes(h) for h in statements["hashes"]]
        counts = np.concatenate([coding.unpack_counts(c) for c in statements["counts"]])
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        # Sums below 2 ** 53 are exact.
        sums = np.bincount(place, counts).astype(np.uint64)[place]
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        return pd.DataFrame(
            {
                "block": statements["block"],
                "bucket": statements["bucket"],
                "sums": [coding.pack_counts(s) for s in np.split(sums, ends)],
            }
        )

    return asked.groupBy("bucket").applyInPandas(sum_bucket, ANSWERS)


def sums_of(parts: pd.DataFrame, coding: Coding = PLAIN) -> np.ndarray:
    """The sums a block got back, in the order of its ascending hashes."""
    if not len(parts):
        return np.zeros(0, np.uint64)
    return np.concatenate([coding.unpack_counts(s) for s in parts.sort_values("bucket")["sums"]])
