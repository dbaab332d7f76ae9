"""Shingles of whole blocks of texts at once.

A text's words are runs of bytes that are no ASCII white space, A-Z counting as a-z. The hash
of a word is the sum of a number for each of its bytes times a power for the byte's place,
modulo 2 ** 64; running sums over the block give the hashes of all words without a step for
each. A shingle's hash mixes those of its words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from isoloir.llm.blocks import mix
from isoloir.llm.common import byte_ranges

SHINGLE = 5
#: Bytes of texts that are worked on together, about; a longer text is by itself.
BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(_BASE)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _byte_numbers() -> np.ndarray:
    numbers = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
    numbers[65:91] = numbers[97:123]
    return numbers


_NUMBERS = _byte_numbers()


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of the one that undoes it modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(size, base, np.uint64)
        factors[:1] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def _chain(hashes: np.ndarray, first: np.ndarray | slice, length: int, count: int) -> np.ndarray:
    """Hashes of ``count`` runs of ``length`` words; ``first`` are the runs' first words."""
    h = np.full(count, length, np.uint64)
    for k in range(length):
        words = hashes[k : k + count] if isinstance(first, slice) else hashes[first + k]
        h = mix(h * _STEP + words)
    return h


def _block(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    size = len(data)
    # As large as most blocks, so that the powers are made once.
    power, undo = _powers(max(BLOCK_BYTES, 1 << (size - 1).bit_length()))
    word = ~_BLANK[data]
    inner = ends[(ends > 0) & (ends < size)]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    begins[inner] = word[inner]
    stops[:-1] &= ~word[1:]
    stops[inner - 1] = word[inner - 1]
    begins, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_NUMBERS[data] * power[:size], out=sums[1:])
    hashes = mix((sums[stops] - sums[begins]) * undo[begins])
    first = np.searchsorted(begins, ends)
    words = np.diff(first)
    runs = _chain(hashes, slice(None), SHINGLE, max(0, len(hashes) - SHINGLE + 1))
    short = {}
    for length in range(1, SHINGLE):
        those = np.flatnonzero(words == length)
        short.update(zip(those.tolist(), _chain(hashes, first[those], length, len(those)), strict=True))
    out = []
    for k, (a, n) in enumerate(zip(first[:-1].tolist(), words.tolist(), strict=True)):
        if n >= SHINGLE:
            found = np.sort(runs[a : a + n - SHINGLE + 1])
            different = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=different[1:])
            out.append(found[different])
        else:
            out.append(np.array([short[k]] if n else [], np.uint64))
    return out


def shingle_sets_of(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The different hashed shingles, ascending, of each text of those that stand end to end.

    Fewer words than a shingle's are one shingle; no words, none.
    """
    out: list[np.ndarray] = []
    for a, b in byte_ranges(ends, BLOCK_BYTES):
        if ends[b] > ends[a]:
            out += _block(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
        else:
            out += [np.zeros(0, np.uint64)] * (b - a)
    return out


def shingles(text: str | bytes | None) -> np.ndarray:
    """The shingles of one text; a null has none."""
    said = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(said, np.uint8)
    return shingle_sets_of(data, np.array([0, len(data)]))[0]
