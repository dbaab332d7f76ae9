"""Fill-in-the-middle transformation by displacement scatter.

A text is cut twice and its parts are put in another order behind sentinels. Work is done on
whole blocks of texts, as one run of bytes: cuts are found by scanning where code points
begin, each part of each text has one shift from its old place to its new one, and the
differences of neighbouring shifts, written where parts begin, sum up to the shift of every
byte. One scatter then builds all outputs of the block. The way back scans outputs for the
sentinels and gathers the bytes by shifts made in the same way; it needs the output and its
form only.

Which texts are cut, and where, is drawn from the hash of ``SEED`` and the document's id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloir.llm.common import byte_ranges, small_batches, string_array, string_bytes, text_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Texts of a hundred that stay plain, and of those cut, the ones whose suffix comes first.
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
SEED = 1
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
#: Bytes that are worked on together, about; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

TRANSFORMED = (
    "doc_id {key}, n long, form string, prefix_chars long, middle_chars long, output string"
)


def draws(doc_id: object, seed: int = SEED) -> bytes:
    """Four big-endian 32-bit numbers of a document; a null id counts as an empty one."""
    return hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16]


@dataclass
class Transformed:
    """Outputs of a block, end to end, and how each text was cut."""

    data: np.ndarray
    ends: np.ndarray
    forms: np.ndarray
    chars: np.ndarray
    prefix_chars: np.ndarray
    middle_chars: np.ndarray


def sentinels(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sentinels begin that lie within one text, and in which text."""
    second = data[1:-1]
    known = (second == PREFIX[1]) | (second == SUFFIX[1]) | (second == MIDDLE[1])
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & known & (data[2:] == PREFIX[2]))
    text = np.searchsorted(ends, at, "right") - 1
    inside = at + len(PREFIX) <= ends[text + 1]
    return at[inside], text[inside]


def _shifts(size: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The shift of each of ``size`` bytes.

    ``parts`` has the places where the first, second ... part of every text begins, and its
    shift. A part without bytes begins where the next one does and cancels out.
    """
    places = np.stack([p for p, _ in parts], 1).ravel()
    shifts = np.stack([s for _, s in parts], 1).ravel()
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, places, np.diff(shifts, prepend=0))
    return np.cumsum(steps[:-1], out=steps[:-1])


def transform(data: np.ndarray, ends: np.ndarray, drawn: np.ndarray) -> Transformed:
    """The outputs of texts that stand end to end; ``drawn`` has four numbers for each."""
    starts, stops = ends[:-1], ends[1:]
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(begins, ends)
    chars = np.diff(first)
    forms = np.where(drawn[:, 3] % 100 < SUFFIX_FIRST_BELOW, SPM, PSM)
    forms[(chars == 0) | (drawn[:, 2] % 100 >= PLAIN_FROM)] = PLAIN
    forms[sentinels(data, ends)[1]] = PLAIN
    cut = np.sort(drawn[:, :2].astype(np.int64) % (chars[:, None] + 1), 1)
    # The code point after a text's last one begins where the text ends.
    begins = np.append(begins, len(data))
    p, m = begins[first[:-1] + cut[:, 0]], begins[first[:-1] + cut[:, 1]]
    plain, spm, mark = forms == PLAIN, forms == SPM, len(PREFIX)
    out_ends = ends + 3 * mark * np.append(0, np.cumsum(~plain))
    o, prefix, middle, suffix = out_ends[:-1], p - starts, m - p, stops - m
    to_prefix = np.where(spm, o + 2 * mark + suffix, o + mark)
    to_suffix = np.where(spm, o + mark, o + 2 * mark + prefix)
    to_middle = o + 3 * mark + prefix + suffix
    stay = o - starts
    shift = _shifts(
        len(data),
        [
            (starts, np.where(plain, stay, to_prefix - starts)),
            (p, np.where(plain, stay, to_middle - p)),
            (m, np.where(plain, stay, to_suffix - m)),
        ],
    )
    out = np.empty(int(out_ends[-1]), np.uint8)
    out[np.arange(len(data)) + shift] = data
    for name, at in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k, byte in enumerate(name):
            out[at[~plain] - mark + k] = byte
    return Transformed(out, out_ends, forms, chars, cut[:, 0], middle_chars=cut[:, 1] - cut[:, 0])


def restore(data: np.ndarray, ends: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, end to end, from outputs and their forms."""
    plain, spm, mark = forms == PLAIN, forms == SPM, len(PREFIX)
    at, text = sentinels(data, ends)
    at = at[~plain[text]]
    if len(at) != 3 * (~plain).sum():
        raise ValueError("an output without its three sentinels")
    found = np.zeros((len(forms), 3), np.int64)
    found[~plain] = at.reshape(-1, 3)
    starts, stops = ends[:-1], ends[1:]
    one = (np.where(plain, starts, found[:, 0] + mark), np.where(plain, starts, found[:, 1]))
    two = (np.where(plain, starts, found[:, 1] + mark), np.where(plain, starts, found[:, 2]))
    # A plain text is all middle.
    middle = (np.where(plain, starts, found[:, 2] + mark), stops)
    prefix = tuple(np.where(spm, b, a) for a, b in zip(one, two, strict=True))
    suffix = tuple(np.where(spm, a, b) for a, b in zip(one, two, strict=True))
    text_ends = ends - 3 * mark * np.append(0, np.cumsum(~plain))
    place, parts = text_ends[:-1], []
    for begin, end in (prefix, middle, suffix):
        parts.append((place, begin - place))
        place = place + (end - begin)
    size = int(text_ends[-1])
    return data[np.arange(size) + _shifts(size, parts)], text_ends


def transform_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
    restored: bool = False,
) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` of every row.

    ``form`` is ``plain`` (the text itself), ``psm`` or ``spm`` (the order of prefix, suffix
    and middle); of plain texts the numbers are null. With ``restored`` a column of that name
    has the text as rebuilt from output and form. A null text counts as empty, and an empty
    one is plain, as is one that has a sentinel. Rows that repeat an id are cut each, a null
    id counts as an empty one; other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    layout = TRANSFORMED.format(key=docs.schema[doc_id].dataType.simpleString())
    layout += ", restored string" if restored else ""
    names = [f.strip().split()[0] for f in layout.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = string_bytes(batch.column(1))
            for a, b in byte_ranges(ends, BLOCK_BYTES):
                ids = batch.column(0).slice(a, b - a)
                drawn = b"".join(draws(i, seed) for i in ids.to_pylist())
                numbers = np.frombuffer(drawn, ">u4").reshape(-1, 4)
                t = transform(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], numbers)
                plain = t.forms == PLAIN
                columns = [
                    ids,
                    pa.array(t.chars),
                    pa.array(np.array(FORMS, object)[t.forms], pa.string()),
                    pa.array(t.prefix_chars, mask=plain),
                    pa.array(t.middle_chars, mask=plain),
                    string_array(t.data, t.ends),
                ]
                if restored:
                    columns.append(string_array(*restore(t.data, t.ends, t.forms)))
                yield pa.RecordBatch.from_arrays(columns, names)

    picked = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).cast("string").alias("text"))
    return picked.mapInArrow(run, layout)


def restore_documents(transformed: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row, from ``form`` and ``output`` alone.

    An output that lacks the sentinels its form promises raises.
    """
    key = transformed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = string_bytes(batch.column(2))
            forms = np.array([FORMS.index(f) for f in batch.column(1).to_pylist()], np.int64)
            for a, b in byte_ranges(ends, BLOCK_BYTES):
                texts = restore(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], forms[a:b])
                ids = batch.column(0).slice(a, b - a)
                yield pa.RecordBatch.from_arrays([ids, string_array(*texts)], ["doc_id", "text"])

    return transformed.select("doc_id", "form", "output").mapInArrow(run, f"doc_id {key}, text string")
