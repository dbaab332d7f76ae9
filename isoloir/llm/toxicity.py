"""Toxicity: a linear-chain conditional random field over the words of a text.

Two states, plain and toxic. Only documents are labelled, so words are labelled from them
first: a word, or the first letters of words, that toxic documents have in many different
contexts and clean ones hardly ever, is toxic where a toxic document has it. A chain is a
sentence, however long; the field sees the word, its first and last letters,
and its neighbours. Forward-backward gives each word's probability of being toxic; the two
highest of a document give its score, and words from one half on are its toxic spans.

The field is fitted on at most ``SAMPLE`` toxic and twice as many clean documents, chosen by
the hash of their id, and on ``SENTENCES`` sentences of them at most.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloir.llm.common import agreed_labels, bounded_sample, give_back, one_text_each, small_batches
from isoloir.llm.logistic import fit_dense, sigmoid

#: Toxic documents the field is fitted on, at most; clean ones: twice as many.
SAMPLE = 1500
SENTENCES = 6000
#: Words of a chain that are stepped through; a longer one is cut into segments whose ends
#: are told what lies beyond them, so that the cut changes no probability.
SEGMENT = 64
#: Slots that features hash to.
SLOTS = 1 << 17
#: Words that are scored together, and different words that a task keeps.
BLOCK_WORDS = 200_000
KEPT_WORDS = 100_000
#: A document is toxic from this score on, a word from this probability on.
TOXIC_FROM, SPAN_FROM = 0.7, 0.5
#: A key is toxic if chance gives its contexts to toxic documents less often than this, and
#: clean documents have it in no more than this share of the contexts.
CHANCE, CLEAN_SHARE = 1e-4, 0.05

MARKS = b".,;:!?*$%&#|<>\"'()[]{}"
ENDS = (b".", b"!", b"?")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TAGGED = "doc_id {key}, score double, n_toxic long, spans array<struct<start: int, end: int>>"


def own_keys(word: bytes) -> tuple[bytes, ...]:
    """Features of a word itself: any word, it, its first letters and its last."""
    return (b"", b"w" + word, b"3" + word[:3], b"4" + word[:4], b"5" + word[:5], b"s" + word[-3:])


#: Own features, then the one that a word gives to the next and the one to the previous.
OWN = 6
BEFORE, AFTER, WIDTH = OWN, OWN + 1, OWN + 2


def plain_form(word: bytes) -> bytes:
    return word.lower().strip(MARKS)


class Vocabulary:
    """Feature slots of each different word: its own, and those it gives its neighbours."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.ids: dict[bytes, int] = {}
        self._slots = array("i")
        self._ends = bytearray()

    def read(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        ids = self.ids
        for word in set(words).difference(ids):
            ids[word] = len(ids)
            form = plain_form(word)
            keys = (*own_keys(form), b"p" + form, b"n" + form)
            self._slots.extend([zlib.crc32(k) % SLOTS for k in keys])
            self._ends.append(word.endswith(ENDS))
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def slots(self) -> np.ndarray:
        return np.array(self._slots, np.int32).reshape(-1, WIDTH)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Whether each word ends a sentence."""
        return np.array(self._ends, np.uint8)[ids] == 1


def chains(ends: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the chains of words, given sentence ends and document numbers."""
    n = len(ends)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.ones(n, bool)
    first[1:] = ends[:-1] | (docs[1:] != docs[:-1])
    starts = np.flatnonzero(first)
    return starts, np.diff(np.append(starts, n))


@dataclass
class Field:
    """Weights of the features for the toxic state, and of the transitions."""

    weights: np.ndarray
    moves: np.ndarray
    calibration: np.ndarray

    def emissions(self, slots: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log-odds of the toxic state of each word before its neighbours' states count."""
        by_word = self.weights[slots]
        own = by_word[:, :OWN].sum(1)[ids]
        before, after = by_word[ids, BEFORE], by_word[ids, AFTER]
        first = np.zeros(len(ids), bool)
        first[starts] = True
        own[1:] += np.where(first[1:], 0, before[:-1])
        own[:-1] += np.where(first[1:], 0, after[1:])
        return np.clip(own, -30, 30)


def _segments(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of the segments of chains, and the number of each within its chain."""
    parts = -(-lengths // SEGMENT)
    chain = np.repeat(np.arange(len(lengths)), parts)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    return starts[chain] + number * SEGMENT, np.minimum(lengths[chain] - number * SEGMENT, SEGMENT), number


def _forward(
    prior: np.ndarray, potential: np.ndarray, move: np.ndarray, starts: np.ndarray, alive: list[int], out: np.ndarray | None
) -> np.ndarray:
    """Messages along segments, the longest first, from ``prior``; returns those at their ends.

    A segment may have several messages, which keep their proportion to each other.
    """
    last = prior.copy()
    for t, k in enumerate(alive):
        now = last[:k] @ move if t else last[:k].copy()
        at = starts[:k] + t
        now[..., 1] *= potential[at][:, None]
        now /= now.sum((1, 2), keepdims=True)
        last[:k] = now
        if out is not None:
            out[at] = now[:, 0]
    return last


def _beyond(
    transfer: np.ndarray, number: np.ndarray, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What each segment is told at its first word and at its last, by the others of its chain."""
    n = len(number)
    prior, behind = np.ones((n, 2)), np.ones((n, 2))
    # Messages at the ends; a chain's first segment has the same one in both rows.
    ended = transfer[:, 0].copy()
    by_number = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[by_number], np.arange(1, number.max() + 2))
    steps = [by_number[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    for at in steps:
        prior[at] = ended[at - 1] @ move
        said = (ended[at - 1][:, None] @ transfer[at])[:, 0]
        ended[at] = said / said.sum(1, keepdims=True)
    for at in reversed(steps):
        said = (transfer[at] @ behind[at][:, :, None])[:, :, 0]
        behind[at - 1] = said / said.sum(1, keepdims=True)
    return prior, behind


def forward_backward(
    emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray, count: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Each word's probability of the toxic state, and the expected counts of the moves if wanted.

    All segments advance together, so that a step is one array operation. Of chains that have
    several, the messages between them come from the products of their steps.
    """
    n = len(emissions)
    if not n:
        return np.zeros(0), np.zeros((2, 2)) if count else None
    potential, move = np.exp(emissions), np.exp(moves)
    begin, size, number = _segments(starts, lengths)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]
    prior, behind = np.ones((len(begin), 2)), np.ones((len(begin), 2))
    if number.any():
        first = (number == 0)[order]
        basis = np.where(first[:, None, None], np.ones((2, 2)), move)
        transfer = np.empty((len(begin), 2, 2))
        transfer[order] = _forward(basis, potential, move, begin, alive, None)
        told = _beyond(transfer, number, move)
        prior, behind = told[0][order], told[1][order]
    ahead, back = np.empty((n, 2)), np.empty((n, 2))
    _forward(prior[:, None], potential, move, begin, alive, ahead)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        back[at] = behind[:k]
        now = behind[:k].copy()
        now[:, 1] *= potential[at]
        now = now @ move.T
        behind[:k] = now / now.sum(1, keepdims=True)
    both = ahead * back
    toxic = both[:, 1] / both.sum(1)
    if not count:
        return toxic, None
    follows = np.ones(n, bool)
    follows[starts] = False
    at = np.flatnonzero(follows)
    right = back[at]
    right[:, 1] *= potential[at]
    pair = ahead[at - 1][:, :, None] * move * right[:, None, :]
    return toxic, (pair / pair.sum((1, 2), keepdims=True)).sum(0)


def fit_field(sentences: list[tuple[list[bytes], list[int]]], steps: int = 80) -> Field:
    """A field from tagged sentences, by Adam on the penalised likelihood."""
    vocabulary = Vocabulary()
    texts = [vocabulary.read(b" ".join(words).decode()) for words, _ in sentences]
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    tags = np.array([t for _, found in sentences for t in found], np.float64)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    starts, sizes = starts[sizes > 0], sizes[sizes > 0]
    field = Field(np.zeros(SLOTS), np.zeros((2, 2)), np.zeros(3))
    if not tags.any():
        return field
    slots = vocabulary.slots().astype(np.int64)
    first = np.zeros(len(ids), bool)
    first[starts] = True
    seen = np.zeros((2, 2))
    follow = ~first[1:]
    np.add.at(seen, (tags[:-1][follow].astype(int), tags[1:][follow].astype(int)), 1)
    theta = np.zeros(SLOTS + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        field.weights, field.moves = theta[:SLOTS], theta[SLOTS:].reshape(2, 2)
        odds = field.emissions(slots, ids, starts)
        toxic, counts = forward_backward(odds, starts, sizes, field.moves, count=True)
        error = toxic - tags
        g = np.zeros_like(theta)
        per_word = np.bincount(ids, error, len(slots))
        g[:SLOTS] = np.bincount(slots[:, :OWN].ravel(), np.repeat(per_word, OWN), SLOTS)
        follows, leads = np.where(first[1:], 0, error[1:]), np.where(first[1:], 0, error[:-1])
        g[:SLOTS] += np.bincount(slots[ids[:-1], BEFORE], follows, SLOTS)
        g[:SLOTS] += np.bincount(slots[ids[1:], AFTER], leads, SLOTS)
        g[SLOTS:] = (counts - seen).ravel()
        g = g / len(sizes) + 1e-5 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return field


def word_probabilities(
    texts: list[str | None], field: Field, vocabulary: Vocabulary | None = None
) -> Iterator[np.ndarray]:
    """For each text, each word's probability of being toxic; a vocabulary serves further texts."""
    vocabulary, waiting, words = vocabulary or Vocabulary(), [], 0
    for k, text in enumerate(texts):
        waiting.append(vocabulary.read(text))
        words += len(waiting[-1])
        if words >= BLOCK_WORDS or k == len(texts) - 1:
            yield from _block(vocabulary, waiting, field)
            waiting, words = [], 0
            if len(vocabulary.ids) > KEPT_WORDS:
                vocabulary.forget()


def _block(vocabulary: Vocabulary, texts: list[np.ndarray], field: Field) -> Iterator[np.ndarray]:
    ids, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    if len(ids):
        starts, lengths = chains(vocabulary.ends(ids), np.repeat(np.arange(len(texts)), sizes))
        odds = field.emissions(vocabulary.slots(), ids, starts)
        toxic, _ = forward_backward(odds, starts, lengths, field.moves)
    else:
        toxic = np.zeros(0)
    yield from np.split(toxic, np.cumsum(sizes)[:-1])


def document_features(toxic: np.ndarray) -> tuple[float, float]:
    """Log-odds of the two most toxic words; words that are missing count as plain."""
    top = np.sort(np.partition(toxic, -2)[-2:]) if len(toxic) > 1 else np.append(np.zeros(2 - len(toxic)), toxic)
    odds = np.log(np.clip(top, 1e-4, 1 - 1e-4)) - np.log(np.clip(1 - top, 1e-4, 1))
    return float(odds[1]), float(odds[0])


def document_score(toxic: np.ndarray, field: Field) -> float:
    high, low = document_features(toxic)
    a, b, c = field.calibration
    return float(sigmoid(np.float64(a * high + b * low + c)))


def spans_of(text: str | None, toxic: np.ndarray) -> list[dict]:
    """Start and end, in code points, of the words from ``SPAN_FROM`` on."""
    hits = set(np.flatnonzero(toxic >= SPAN_FROM).tolist())
    if not hits:
        return []
    words = enumerate(WORD.finditer(text or ""))
    return [{"start": m.start(), "end": m.end()} for k, m in words if k in hits]


# --- training -------------------------------------------------------------------------------


def training_texts(
    docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str, text: str, label: str
) -> DataFrame:
    """``label`` and ``text`` of the sampled documents among those that may be learned from."""
    named = agreed_labels(labels, doc_id, label).where(usable)
    clean = bounded_sample(named.where("label = 0"), "doc_id", 2 * SAMPLE)
    # No more toxic than clean ones: else a word would have to be very frequent before its
    # being in toxic documents only is no chance.
    toxic = bounded_sample(named.where("label = 1"), "doc_id", min(SAMPLE, clean.count()))
    few = F.broadcast(toxic.unionByName(clean))  # 3 * SAMPLE ids at most
    return one_text_each(docs, few, doc_id, text)


def toxic_keys(texts: DataFrame) -> set[bytes]:
    """Words and first letters that mark toxic documents, by the contexts they have there."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for row in batch.to_pylist():
                words = [plain_form(w) for w in (row["text"] or "").encode().split()]
                for k, word in enumerate(words):
                    if len(word) > 2:
                        around = b" ".join((*words[max(0, k - 1) : k], b"_", *words[k + 1 : k + 2]))
                        here = (row["label"], zlib.crc32(around))
                        found.update((key, *here) for key in {b"w" + word, b"4" + word[:4], b"5" + word[:5]})
            keys = list(found)
            yield pa.RecordBatch.from_pydict(
                {"key": [f[0] for f in keys], "label": pa.array([f[1] for f in keys], pa.int32()),
                 "context": pa.array([f[2] for f in keys], pa.int64())}
            )

    seen = texts.mapInArrow(contexts, "key binary, label int, context long").distinct()
    counts = seen.groupBy("key").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("toxic"),
        F.count(F.when(F.col("label") == 0, 1)).alias("clean"),
    )
    totals = seen.groupBy("label").count()
    size = {r.label: r["count"] for r in totals.collect()}
    share = size.get(1, 0) / max(1, sum(size.values()))
    if not 0 < share < 1:
        return set()
    # If share ** toxic is no small chance, the key is too rare to tell.
    least = math.ceil(math.log(CHANCE) / math.log(share))
    # A sample's words bound the rows; those that pass are fewer still.
    few = counts.where((F.col("toxic") >= least) & (F.col("clean") <= CLEAN_SHARE * F.col("toxic")))
    return {bytes(r.key) for r in few.select("key").collect()}


def is_toxic_word(word: bytes, keys: set[bytes]) -> bool:
    return b"w" + word in keys or b"5" + word[:5] in keys or b"4" + word[:4] in keys


def tagged_sentences(texts: DataFrame, keys: set[bytes]) -> list[tuple[list[bytes], list[int]]]:
    """Sentences of toxic documents with a toxic word, and as many of clean ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"toxic": [], "words": [], "tags": []}
            for row in batch.to_pylist():
                vocabulary = Vocabulary()
                ids = vocabulary.read(row["text"])
                words = list(vocabulary.ids)
                starts, lengths = chains(vocabulary.ends(ids), np.zeros(len(ids)))
                for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
                    said = [words[i] for i in ids[start : start + n].tolist()]
                    marks = [int(row["label"] == 1 and is_toxic_word(plain_form(w), keys)) for w in said]
                    if row["label"] == 0 or any(marks):
                        out["toxic"].append(any(marks))
                        out["words"].append(b" ".join(said))
                        out["tags"].append(bytes(marks))
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema({"toxic": pa.bool_(), "words": pa.binary(), "tags": pa.binary()})
            )

    found = texts.mapInArrow(run, "toxic boolean, words binary, tags binary").distinct()
    picks = [bounded_sample(found.where(F.col("toxic") == v), "words", SENTENCES) for v in (True, False)]
    rows = picks[0].unionByName(picks[1]).collect()
    return [(bytes(r.words).split(), list(bytes(r.tags))) for r in rows]


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Field:
    """A field learned from labelled documents; ``usable`` says of ``doc_id`` which ones.

    A null label or id teaches nothing, nor does an id whose labels contradict each other; of
    rows of ``docs`` that repeat an id, one is read, the same on every run. Without toxic and
    clean documents, or without a word that tells them apart, every document scores near zero.
    """
    usable = F.lit(True) if usable is None else usable
    # Few rows; dealt out, so that a sample of long texts is no single task.
    texts = training_texts(docs, labels, usable, doc_id, text, label).repartition(12).persist()
    try:
        field = fit_field(sorted(tagged_sentences(texts, toxic_keys(texts))))
        field.calibration = _calibrate(texts, field)
    finally:
        texts.unpersist()
    return field


def _calibrate(texts: DataFrame, field: Field) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(t) for t in word_probabilities(batch.column("text").to_pylist(), field)]
            yield pa.RecordBatch.from_pydict(
                {"label": batch.column("label"), "high": [f[0] for f in found], "low": [f[1] for f in found]},
                schema=pa.schema({"label": pa.int32(), "high": pa.float64(), "low": pa.float64()}),
            )

    rows = sorted(map(tuple, texts.mapInArrow(run, "label int, high double, low double").collect()))
    y = np.array([r[0] for r in rows], np.float64)
    if not (field.weights.any() and 0 < y.sum() < len(y)):
        return np.array([0.0, 0.0, -5.0])
    return fit_dense(np.array([r[1:] for r in rows]), y)


# --- application ----------------------------------------------------------------------------


def tag_documents(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score``, ``n_toxic`` and ``spans`` of every row; others are ignored.

    A null or empty text has a score as any text without toxic words. Repeated rows are
    scored each; an empty table gives an empty result. Spans count code points.
    """
    small_batches(docs.sparkSession)
    key = docs.schema[doc_id].dataType.simpleString()
    spans = pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, marked = [], []
            for text, toxic in zip(texts, word_probabilities(texts, field, vocabulary), strict=True):
                scores.append(document_score(toxic, field))
                marked.append(spans_of(text, toxic))
            columns = [
                batch.column(0),
                pa.array(scores, pa.float64()),
                pa.array([len(m) for m in marked], pa.int64()),
                pa.array(marked, spans),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_toxic", "spans"])
        vocabulary.forget()
        give_back()

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, TAGGED.format(key=key))


def keep_clean(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``TOXIC_FROM``; columns unchanged.

    A null or empty text has no toxic word and stays. Rows that repeat are scored each; an
    empty table stays empty; columns of any other name pass through.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary()
        for texts in batches:
            found = word_probabilities(texts.tolist(), field, vocabulary)
            yield pd.Series([document_score(t, field) for t in found], dtype="float64")
        vocabulary.forget()
        give_back()

    return docs.where(score(F.col(text).cast("string")) < TOXIC_FROM)
