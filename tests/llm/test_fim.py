import hashlib

import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from isoloir.llm import fill_in_middle as fim
from isoloir.llm.queries import op12_fill_in_middle
from pyspark.sql import functions as F

from .conftest import ODD_TEXTS, counted

ODD = [
    *ODD_TEXTS,
    (20, "a <P> in it " * 5),
    (21, "<S"),
    (22, "<<S<P"),
    (23, "M>" * 40),
    (24, "é中𝄞" * 30),
    (25, "𝄞"),
]


def by_hand(doc_id, text):
    """One text at a time, by slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def frame(spark, rows):
    clashing = [(i, t, "x", 1) for i, t in rows]
    return spark.createDataFrame(clashing, "doc_id long, text string, form string, n int").repartition(3)


def test_texts_are_cut_like_by_hand_and_come_back(spark):
    # Many ids, so that every form and cut at either end occurs.
    rows = ODD + [(k, ODD[k % len(ODD)][1] or "x") for k in range(100, 400) if len(ODD[k % len(ODD)][1] or "") < 6000]
    got = fim.transform_documents(frame(spark, rows), restored=True)
    want = [(i, *by_hand(i, t), t or "") for i, t in rows]
    assert counted(got.collect()) == counted(want)
    assert {w[2] for w in want} == set(fim.FORMS)
    back = fim.restore_documents(got.select("form", "output", "doc_id"))
    assert counted(back.collect()) == counted((i, t or "") for i, t in rows)


def test_no_rows_and_a_broken_output(spark):
    assert fim.transform_documents(frame(spark, [])).collect() == []
    with pytest.raises(ValueError, match="sentinels"):
        fim.restore(np.frombuffer(b"<P>a<S>b", np.uint8), np.array([0, 8]), np.array([fim.PSM]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("<>PSMé𝄞 a", max_size=12), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))))
def test_any_block_comes_back(texts):
    encoded = [t.encode() for t, _ in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    ends = np.cumsum([0, *map(len, encoded)])
    drawn = np.array([d for _, d in texts], np.uint32).reshape(-1, 4)
    out = fim.transform(data, ends, drawn)
    restored, places = fim.restore(out.data, out.ends, out.forms)
    assert restored.tobytes() == data.tobytes() and places.tolist() == ends.tolist()
    for k, (text, _) in enumerate(texts):
        said = out.data[out.ends[k] : out.ends[k + 1]].tobytes().decode()
        a, b = out.prefix_chars[k], out.prefix_chars[k] + out.middle_chars[k]
        whole = {
            fim.PLAIN: text,
            fim.PSM: f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}",
            fim.SPM: f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}",
        }
        assert said == whole[out.forms[k]]


def test_registered_query_restores_every_document(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    whole = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    got = op12_fill_in_middle(spark, SF_DIR)
    assert got.join(whole, "doc_id").where("sha = restored_sha256").count() == docs.count() == got.count()
