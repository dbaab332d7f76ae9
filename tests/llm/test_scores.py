import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from isoloir.llm import lm_scoring, quality, toxicity
from isoloir.llm.queries import QUERIES, held_out
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from .conftest import ODD_TEXTS, counted, sentence, words_of

# --- quality --------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(k, k + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_base_counts_match_brute_force(odd, none):
    model = quality.QualityModel(None)
    got = quality.measure_documents(odd, model).collect()
    want = Counter((i, *base_counts(t), 1.0, not base_counts(t)[5]) for i, t in ODD_TEXTS)
    assert counted(got) == want
    assert quality.measure_documents(none, model).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "#", "\n", " ", "\t", "a b c d e", "\x0b"]), max_size=60))
def test_base_counts_of_any_text(parts):
    text = "".join(parts)
    measured = quality.measure(text, quality.QualityModel(None), quality.TextReader())
    assert measured[:6] == base_counts(text)


def labelled(spark, make, n=400):
    rows = [(k, make(k, k % 2), k % 2) for k in range(n)]
    return (
        spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
        spark.createDataFrame([(k, y) for k, _, y in rows] + [(n + 1, None)], "doc_id long, quality int"),
    )


def test_model_tells_good_from_poor(spark):
    def make(k, good):
        text = sentence(k, 30)
        return text if good else " ".join(f"{w}{'$#%'[j % 3]}" for j, w in enumerate(text.split()))

    docs, labels = labelled(spark, make)
    model = quality.train(docs, labels)
    measured = quality.measure_documents(docs, model).collect()
    assert all(r.kept == (r.doc_id % 2 == 1) for r in measured)
    assert quality.train(docs, labels).weights.tobytes() == model.weights.tobytes()
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id % 2 for r in kept.collect()} == {1}


def test_model_without_both_labels_keeps_all(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert quality.train(odd, labels).weights is None
    assert quality.train(odd, labels.where("false")).weights is None


def test_scores_are_those_of_the_fitted_features(spark):
    docs, labels = labelled(spark, lambda k, good: sentence(k, 12) + ("" if good else " ###"), 80)
    model = quality.train(docs, labels)
    rows = quality.features(docs.withColumn("label", F.lit(1)).select("label", "text")).collect()
    texts = [r.text for r in docs.collect()]
    for text, row in zip(texts, rows, strict=True):
        slots = np.frombuffer(bytes(row.slots), "<u2").astype(int)
        z = float(np.frombuffer(bytes(row.shares), "<f4") @ model.weights[slots])
        p = quality.measure(text, model, quality.TextReader())[6]
        assert abs(p - 1 / (1 + math.exp(-(model.slope * z + model.bias)))) < 1e-4


def test_quality_of_the_test_documents(spark):
    measured = QUERIES["op1_quality_rules"](spark, SF_DIR).withColumnRenamed("quality", "p")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = measured.join(labels, "doc_id").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in rows[:100]:
        assert tuple(r)[1:7] == base_counts(texts[r.doc_id])
    fair = [r for r in rows if not r.base_failed]
    assert sum(r.kept == (r.quality == 1) for r in fair) >= 0.97 * len(fair)


# --- toxicity -------------------------------------------------------------------------------


def chain_by_trial(emissions, moves):
    """Marginals by summing over every sequence of states."""
    n = len(emissions)
    total, toxic = 0.0, np.zeros(n)
    for states in np.ndindex(*[2] * n):
        z = sum(e for e, s in zip(emissions, states, strict=True) if s)
        z += sum(moves[a, b] for a, b in zip(states, states[1:], strict=False))
        total += math.exp(z)
        toxic += math.exp(z) * np.array(states)
    return toxic / total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(-4, 4), min_size=1, max_size=6), min_size=1, max_size=5), st.integers(0, 10**6))
def test_marginals_match_every_sequence(sentences, seed):
    moves = np.random.default_rng(seed).normal(size=(2, 2))
    lengths = np.array([len(s) for s in sentences])
    starts = np.cumsum(lengths) - lengths
    toxic, counts = toxicity.forward_backward(np.concatenate(sentences), starts, lengths, moves, count=True)
    want = np.concatenate([chain_by_trial(s, moves) for s in sentences])
    assert np.allclose(toxic, want, atol=1e-9)
    assert np.isclose(counts.sum(), (lengths - 1).sum())


def test_chains_end_with_sentences_and_documents():
    ends = np.array([0, 1, 0, 0, 0] + [0] * 130, bool)
    docs = np.array([0, 0, 0, 1, 1] + [2] * 130)
    starts, lengths = toxicity.chains(ends, docs)
    assert list(zip(starts, lengths, strict=True)) == [(0, 2), (2, 1), (3, 2), (5, 130)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=6), st.integers(0, 10**6))
def test_long_chains_are_one_chain(sizes, seed):
    """Segments of five words give what whole chains give, counts too."""
    random = np.random.default_rng(seed)
    lengths = np.array(sizes)
    starts, emissions = np.cumsum(lengths) - lengths, random.normal(size=lengths.sum(), scale=4)
    moves = random.normal(size=(2, 2), scale=2)
    found = []
    for segment in (5, 10**6):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(toxicity, "SEGMENT", segment)
            found.append(toxicity.forward_backward(emissions, starts, lengths, moves, count=True))
    assert np.allclose(found[0][0], found[1][0], atol=1e-9) and np.allclose(found[0][1], found[1][1], atol=1e-6)


def test_a_sentence_of_five_hundred_words_is_not_cut(field):
    """A toxic word is told alike wherever in the sentence it stands, at a cut or not."""
    found = set()
    for place in (10, 63, 64, 65, 128, 300, 490):
        words = ["banal"] * 500
        words[place] = "grobian"
        (toxic,) = toxicity.word_probabilities([" ".join(words)], field)
        assert np.flatnonzero(toxic >= 0.5).tolist() == [place]
        found.add(round(float(toxic[place]), 9))
    assert len(found) == 1


def corpus(n):
    """Toxic documents have two or three words of a stem, the rest of the words are common."""
    docs, labels = [], []
    for k in range(n):
        words, toxic = sentence(k, 40).split(), k % 4 == 0
        for j in range(2 + k % 2) if toxic else ():
            words[(7 * k + 11 * j) % 40] = ("grobian", "zankvolk", f"zank{sentence(k + j, 1)}")[j % 3] + ",."[j % 2]
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def field(spark):
    docs, labels = corpus(600)
    frames = (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )
    return toxicity.train(*frames, ~held_out())


def test_toxic_words_are_found_in_other_documents(spark, field):
    docs, labels = corpus(900)
    rows = toxicity.tag_documents(spark.createDataFrame(docs[600:], "doc_id long, text string"), field).collect()
    texts, toxic = dict(docs), dict(labels)
    right = sum((r.score >= toxicity.TOXIC_FROM) == toxic[r.doc_id] for r in rows)
    assert right >= 0.98 * len(rows)
    for r in rows:
        assert r.n_toxic == len(r.spans)
        for s in r.spans if r.score >= toxicity.TOXIC_FROM else ():
            word = texts[r.doc_id][s.start : s.end]
            assert word.startswith(("grobian", "zank")) and " " not in word


def test_awkward_texts_have_scores(odd, none, field):
    rows = toxicity.tag_documents(odd, field).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD_TEXTS)
    by_text = {r.doc_id: r.score for r in rows}
    assert by_text[4] == by_text[5] == by_text[6] < 0.5
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.tag_documents(none, field).collect() == []
    assert toxicity.keep_clean(odd, field).columns == odd.columns


def test_scores_do_not_depend_on_the_batch(field):
    texts = [t for _, t in ODD_TEXTS] + [t for _, t in corpus(60)[0]]
    together = [toxicity.document_score(p, field) for p in toxicity.word_probabilities(texts, field)]
    alone = [toxicity.document_score(next(toxicity.word_probabilities([t], field)), field) for t in texts]
    assert np.allclose(together, alone, atol=1e-12)


def test_without_labels_nothing_is_toxic(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    field = toxicity.train(odd, labels)
    assert all(r.score < 0.5 for r in toxicity.tag_documents(odd, field).collect())


def test_held_out_documents_are_not_learned_from(spark):
    docs, labels = corpus(300)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    texts = toxicity.training_texts(
        frame, spark.createDataFrame(labels, "doc_id long, toxic int"), ~held_out(), "doc_id", "text", "toxic"
    )
    import zlib

    out = {t for k, t in docs if zlib.crc32(str(k).encode()) % 3 == 1}
    learned = {r.text for r in texts.collect()}
    assert len(out) > 50 and not out & learned and len(learned) == len(docs) - len(out)


def labels_of(spark, rows, label="toxic"):
    return spark.createDataFrame(rows, f"doc_id long, {label} int")


def test_repeated_and_contradicting_labels(spark):
    """An id that very many rows have is read once; one with two labels is not learned from."""
    docs = [(k, sentence(k, 20)) for k in range(8)] + [(3, sentence(1000 + k, 20)) for k in range(5000)]
    docs += [(None, "x")] * 10
    labels = [(k, k % 2) for k in range(8)] * 3 + [(1, 0), (4, 1), (None, 1), (6, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    texts = toxicity.training_texts(frame, labels_of(spark, labels), F.lit(True), "doc_id", "text", "toxic")
    assert sorted(r.label for r in texts.collect()) == [0, 0, 0, 1, 1, 1]
    rows = quality.labelled_texts(frame, labels_of(spark, labels, "quality"), "doc_id", "text", "quality").collect()
    assert sorted(r.label for r in rows) == [0, 0, 0, 1, 1, 1]
    again = quality.labelled_texts(frame.repartition(7), labels_of(spark, labels, "quality"), "doc_id", "text", "quality")
    assert counted(again.collect()) == counted(rows)


def test_nine_of_ten_labelled_documents_are_toxic(spark):
    docs, labels = [], []
    for k in range(600):
        words, toxic = sentence(k, 40).split(), k % 10 > 0
        if toxic:
            words[(7 * k) % 40] = "grobian"
            words[(7 * k + 11) % 40] = "zankvolk,"
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = toxicity.train(frame, labels_of(spark, labels))
    new = [(k, " ".join([*sentence(k, 20).split(), *(["zankvolk", "grobian"] if k % 2 else ["und"]), *sentence(k + 1, 9).split()])) for k in range(2000, 2100)]
    rows = toxicity.tag_documents(spark.createDataFrame(new, "doc_id long, text string"), found).collect()
    assert sum((r.score >= toxicity.TOXIC_FROM) == bool(r.doc_id % 2) for r in rows) >= 98


def test_a_rarer_toxic_word_is_learned(spark):
    """In thirty of eight hundred toxic documents, beside words that all of them have."""
    docs, labels = corpus(1200)
    docs = [(k, t + " seltsamkerl") if k % 4 == 0 and k % 40 == 0 else (k, t) for k, t in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    texts = toxicity.training_texts(frame, labels_of(spark, labels), F.lit(True), "doc_id", "text", "toxic")
    assert b"wseltsamkerl" in toxicity.toxic_keys(texts)


# --- language model -------------------------------------------------------------------------


def backoff_scores(rows, order, backoff, least):
    counts = Counter()
    for _, text in rows:
        words = tuple(words_of(text))
        counts[()] += len(words)
        for n in range(1, order + 1):
            counts.update(words[k : k + n] for k in range(len(words) - n + 1))
    out = Counter()
    for i, text in rows:
        words, total, left_out = tuple(words_of(text)), 0, 0
        for k in range(len(words)):
            lost = 0
            for n in range(min(order, k + 1), 0, -1):
                gram = words[k + 1 - n : k + 1]
                if n == 1 or counts[gram] >= least:
                    total += round(1e6 * math.log(counts[gram] / counts[gram[:-1]] * backoff**lost))
                    break
                lost += 1
            left_out += lost
        out[i, len(words), left_out, total / 1e6] += 1
    return out


@pytest.mark.parametrize(("order", "least"), [(1, 2), (2, 2), (3, 2), (3, 5)])
def test_scores_match_brute_force(odd, order, least):
    got = lm_scoring.score_documents(odd, order=order, least=least).collect()
    want = backoff_scores(ODD_TEXTS, order, 0.4, least)
    rounded = lambda rows: Counter({(*r[:3], round(r[3], 3)): n for r, n in rows.items()})
    assert rounded(counted(got)) == rounded(want)


@pytest.mark.parametrize(("order", "least"), [(1, 2), (2, 2), (3, 2), (3, 5)])
def test_rows_of_grams_give_the_same_scores(odd, none, order, least):
    got = lm_scoring.score_relational(odd, order=order, least=least).collect()
    rounded = lambda rows: Counter({(*r[:3], round(r[3], 3)): n for r, n in rows.items()})
    assert rounded(counted(got)) == rounded(backoff_scores(ODD_TEXTS, order, 0.4, least))
    assert lm_scoring.score_relational(none, order=order, least=least).collect() == []


def test_scores_over_many_blocks(spark, monkeypatch):
    # Driver-side sizes: thirty blocks and several buckets.
    from isoloir.llm import blocks

    rows = [(k, sentence(k % 40, 50)) for k in range(200)]
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm_scoring, "BUCKET_GRAMS", 1000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert counted(lm_scoring.score_documents(docs, order=3).collect()) == backoff_scores(rows, 3, 0.4, 2)


def test_no_documents_have_no_scores(none):
    assert lm_scoring.score_documents(none).collect() == []


def test_scores_of_long_and_of_empty_texts(spark, monkeypatch):
    # Blocks of two thousand bytes: long texts are blocks of their own, empty ones share one.
    from isoloir.llm import blocks

    rows = [(1, ""), (2, None), (3, sentence(3, 3000)), (3, "a"), (4, " \n "), (5, sentence(3, 10)), (6, "a b a b")]
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert counted(lm_scoring.score_documents(docs).collect()) == backoff_scores(rows, lm_scoring.ORDER, 0.4, 2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=200), st.integers(0, 64))
def test_numbers_come_back_from_their_codings(values, bits):
    from isoloir.llm.blocks import pack_dense, pack_small, unpack_dense, unpack_small

    numbers = np.array(values, np.uint64) >> np.uint64(min(bits, 63))
    assert unpack_small(pack_small(numbers)).tolist() == numbers.tolist()
    ascending = np.unique(numbers)
    assert unpack_dense(pack_dense(ascending)).tolist() == ascending.tolist()
    assert lm_scoring.unpack_words(*lm_scoring.pack_words(numbers)).tolist() == numbers.tolist()
