"""Quality rules: counts over the whole text, then a trained verdict.

The base rules count words, symbols, repeated lines and words in repeated passages. The
verdict is a logistic regression on hashed word and character n-grams, trained on
labelled rows and calibrated on rows it was not fitted to, against a fixed threshold.
Texts are scored in Arrow batches.

The model is fitted on at most ``SAMPLE`` rows of each label, chosen by the hash of
their id; a row is at most ``2 * SLOTS`` numbers, so the driver holds a bounded amount.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloir.llm.common import agreed_labels, bounded_sample, give_back, one_text_each, small_batches
from isoloir.llm.logistic import fit_dense, fit_sparse, sigmoid

#: Labelled rows of each label that the model is fitted on, at most.
SAMPLE = 1000
#: Slots that words hash to, and as many for characters.
SLOTS = 1 << 13
#: Every so many-th row of the sample calibrates the model instead of fitting it.
CALIBRATE = 4
#: A text is kept from this probability of good quality on.
KEEP_FROM = 0.5
#: Base rules: fewer words, or a larger share of words in repeated passages, fail.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

#: Different words that a task keeps hashes of, about.
KEPT_WORDS = 100_000

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURES = f"{COUNTS}, base_failed boolean, quality double, kept boolean"

_MIX = np.uint32(2654435769)
_CHAR_FACTORS = (np.uint32(1), np.uint32(69069), np.uint32(1664525))


@dataclass(frozen=True)
class QualityModel:
    """Weights by slot (words, then characters), and the calibration of their sum.

    ``None`` for the weights is the model without rows of both labels: it keeps all.
    """

    weights: np.ndarray | None
    slope: float = 1.0
    bias: float = 0.0

    def probability(self, words: np.ndarray, chars: np.ndarray) -> float:
        if self.weights is None:
            return 1.0
        z = 0.0
        for slots in (words, chars):
            if len(slots):
                z += float(self.weights[slots].mean(dtype=np.float64)) * SCALE
        return float(sigmoid(np.float64(self.slope * z + self.bias)))


#: Shares of slots are small numbers; this factor brings them near one.
SCALE = 8.0


def _slots(hashes: np.ndarray, first: int) -> np.ndarray:
    return (hashes.astype(np.uint32) * _MIX >> np.uint32(19)).astype(np.int64) + first


def word_slots(hashes: np.ndarray) -> np.ndarray:
    """Slots of the words, from their 32-bit hashes, and of pairs of neighbours."""
    pairs = hashes[:-1] * np.uint32(69069) + hashes[1:]
    return np.concatenate([_slots(hashes, 0), _slots(pairs, 0)])


def char_slots(text: str) -> np.ndarray:
    """Slots of the n-grams of one to three characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = []
    for n in (1, 2, 3):
        size = len(codes) - n + 1
        if size > 0:
            h = np.full(size, n, np.uint32)
            for k in range(n):
                h = h * np.uint32(31) + codes[k : k + size] * _CHAR_FACTORS[k]
            out.append(_slots(h, SLOTS))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_words(ids: np.ndarray) -> int:
    """Words within ``WINDOW``-word windows that occur twice or more in the text."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = h * np.uint64(6364136223846793005) + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    ordered = np.sort(h)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # windows that are equal have equal hashes
    words = ids.tolist()
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    seen = Counter(windows)
    starts = np.fromiter((seen[w] > 1 for w in windows), bool, n)
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[k : k + n] |= starts
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


class TextReader:
    """Reads texts as words; a word's hash is computed once for many texts."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.hashes = array("I")

    def words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").split()
        ids = self.ids
        for word in set(words).difference(ids):
            ids[word] = len(ids)
            self.hashes.append(zlib.crc32(word))
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def word_hashes(self, ids: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.hashes, np.uint32)[ids] if len(ids) else np.zeros(0, np.uint32)


def measure(text: str | None, model: QualityModel, reader: TextReader) -> tuple:
    """The values of ``MEASURES``. Null counts as a text without words."""
    text = text or ""
    ids = reader.words(text)
    n = len(ids)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(ids)
    failed = n < LEAST_WORDS or 100 * repeats > MOST_REPEATED_PERCENT * n
    quality = model.probability(word_slots(reader.word_hashes(ids)), char_slots(text))
    kept = not failed and quality >= KEEP_FROM
    return n, word_chars, symbols, repeated_lines(text), repeats, failed, quality, kept


def measures(model: QualityModel, text: str = "text") -> Column:
    """A struct of ``MEASURES``, scored in Arrow batches."""
    names = [f.split()[0] for f in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = TextReader()
        for texts in batches:
            out = []
            for text in texts:
                if len(reader.ids) > KEPT_WORDS:
                    reader = TextReader()
                out.append(measure(text, model, reader))
            yield pd.DataFrame(out, columns=names)
        del reader
        give_back()

    return run(F.col(text).cast("string"))


def features(labelled: DataFrame) -> DataFrame:
    """Slots and values of each labelled text, as bytes of 16-bit and 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, reader = [], TextReader()
            for text in batch.column("text").to_pylist():
                text = text or ""
                found, values = [], []
                words = word_slots(reader.word_hashes(reader.words(text)))
                for slots in (words, char_slots(text)):
                    hit, n = np.unique(slots, return_counts=True)
                    found.append(hit.astype("<u2"))
                    values.append((n * (SCALE / max(1, len(slots)))).astype("<f4"))
                out.append((np.concatenate(found).tobytes(), np.concatenate(values).tobytes()))
            yield pa.RecordBatch.from_pydict(
                {"label": batch.column("label"), "slots": [x[0] for x in out], "shares": [x[1] for x in out]},
                schema=pa.schema({"label": pa.int32(), "slots": pa.binary(), "shares": pa.binary()}),
            )

    return labelled.mapInArrow(run, "label int, slots binary, shares binary")


def labelled_texts(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """``label`` and ``text`` of at most ``SAMPLE`` labelled documents of each label."""
    named = agreed_labels(labels, doc_id, label)
    picks = [bounded_sample(named.where(F.col("label") == v), "doc_id", SAMPLE) for v in (0, 1)]
    # Two thousand ids at most: a proven bound. One text each, so the rows are bounded too.
    return one_text_each(docs, F.broadcast(picks[0].unionByName(picks[1])), doc_id, text)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> QualityModel:
    """A model of ``label`` (1: good), fitted and calibrated on a bounded sample.

    A null label or id teaches nothing, nor does an id whose labels contradict each other; of
    rows of ``docs`` that repeat an id, one is read, the same on every run. A null text counts
    as empty. Without rows of both labels the model keeps all that the base rules keep.

    The sample has as many rows of each label; the probability is made that of rows as
    frequent as all labelled rows are.
    """
    rows = features(labelled_texts(docs, labels, doc_id, text, label)).collect()
    rows.sort(key=lambda r: (zlib.crc32(r.slots), bytes(r.slots)))
    y = np.array([r.label for r in rows], np.float64)
    fitted = np.array([k % CALIBRATE != 0 for k in range(len(rows))], bool)
    if any(not (y[part] == v).any() for part in (fitted, ~fitted) for v in (0, 1)):
        return QualityModel(None)
    sizes = np.array([len(r.slots) // 2 for r in rows])
    at = np.repeat(np.arange(len(rows)), sizes)
    slots = np.frombuffer(b"".join(bytes(r.slots) for r in rows), "<u2").astype(np.int64)
    values = np.frombuffer(b"".join(bytes(r.shares) for r in rows), "<f4").astype(np.float64)
    use = fitted[at]
    place = np.cumsum(fitted) - 1
    weights, _ = fit_sparse(place[at[use]], slots[use], values[use], y[fitted], 2 * SLOTS)
    z = np.bincount(at, values * weights[slots], len(rows))
    slope, bias = fit_dense(z[~fitted][:, None], y[~fitted])
    counts = {r.label: r["count"] for r in agreed_labels(labels, doc_id, label).groupBy("label").count().collect()}
    sampled = y[~fitted].sum() / (1 - y[~fitted]).sum()
    bias += np.log(counts[1] / counts[0]) - np.log(sampled)
    return QualityModel(weights.astype(np.float32), float(slope), float(bias))


def measure_documents(
    docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``MEASURES`` of every row; other columns are ignored.

    A null or empty text has no words and fails the base rules. Repeated rows are
    measured each; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    measured = docs.select(F.col(doc_id).alias("doc_id"), measures(model, text).alias("m"))
    return measured.select("doc_id", "m.*")


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules and the model keep; columns unchanged.

    A null or empty text has too few words and goes. Rows that repeat are judged each; an
    empty table stays empty; columns of any other name pass through.
    """
    small_batches(docs.sparkSession)
    return docs.where(measures(model, text)["kept"])
