"""The registered queries that have no SQL, on the test tables."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from isoloir.llm import quality, toxicity, url_filter
from isoloir.llm.queries import (
    held_out,
    op1_quality_rules,
    op2_toxicity,
    op4_byte_bpe,
    op9_packing,
    op10_url_filter,
)
from pyspark.sql import functions as F

from tests.conftest import SF_DIR

from .test_tokens import check_packing
from .test_urls import parts, rule

LARGE = "/root/testdata/sf0.1"


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


def labels(spark, folder=SF_DIR):
    return spark.read.parquet(f"{folder}/labels.parquet")


def test_quality_of_documents_not_learned_from(spark):
    """Labels of every third document are kept back; the model must do without them."""
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    known = labels(spark, LARGE)
    model = quality.train(docs, known.where(~held_out()))
    judged = quality.measure_documents(docs, model).join(known.where(held_out()), "doc_id")
    counts = {(r.quality, r.kept): r.n for r in judged.groupBy(known.quality, "kept").agg(F.count("*").alias("n")).collect()}
    poor, good = (sum(n for (q, _), n in counts.items() if q == v) for v in (0, 1))
    assert poor > 150 and good > 500
    assert counts.get((0, False), 0) >= 0.95 * poor and counts.get((1, True), 0) >= 0.95 * good
    assert op1_quality_rules(spark, SF_DIR).where("kept AND base_failed").isEmpty()


def test_toxicity_of_documents_not_learned_from(spark):
    scored = op2_toxicity(spark, LARGE)
    judged = scored.where("held_out").join(labels(spark, LARGE), "doc_id")
    rows = judged.select("toxic", "score", "predicted").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert len(toxic) > 100 and all(0 <= r.score <= 1 and r.predicted == (r.score >= toxicity.TOXIC_FROM) for r in rows)
    # A hundredth of the labels call documents toxic that have no toxic word.
    assert sum(r.predicted == r.toxic for r in rows) >= 0.98 * len(rows)
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.005 * len(rows)
    ids = [r.doc_id for r in op2_toxicity(spark, SF_DIR).where("held_out").collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 3 == 1 for i in ids)


def test_ids_are_the_librarys(spark):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    said = texts(spark)
    rows = op4_byte_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(said)
    for r in rows:
        ids = np.array(library.encode_ordinary(said[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(said[r.doc_id].encode()).hexdigest()


def test_packed_documents(spark):
    used, least = check_packing(op9_packing(spark, SF_DIR).collect(), list(texts(spark).items()), 2048)
    assert used <= least * 1.01 + 1


def test_verdicts_on_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    rows = op10_url_filter(spark, SF_DIR).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        assert r.verdict == url_filter.RULES[r.rule] if r.rule else r.verdict in ("allow", "block")


@pytest.mark.parametrize("hidden", sorted(url_filter.RULES))
def test_verdicts_on_urls_not_learned_from(spark, hidden):
    """Every third url that a rule decides is kept back, and told by the model alone."""
    pages = spark.read.parquet(f"{LARGE}/pages.parquet").select("url").distinct()
    ruled = url_filter.judge(pages, url_filter.UrlModel()).where("rule IS NOT NULL").select("url", "rule", "verdict")
    back = F.crc32(F.col("url").cast("binary")) % 3 == 1
    model = url_filter.train(url_filter.labelled_urls(ruled.where(~back), url_filter.RULES))
    judged = url_filter.judge(ruled.where(back & (F.col("rule") == hidden)).select("url"), model, rules={})
    wanted = url_filter.RULES[hidden]
    counts = {r.verdict: r["count"] for r in judged.groupBy("verdict").count().collect()}
    assert counts, "a rule that decides no url checks nothing"
    assert counts.get(wanted, 0) >= 0.95 * sum(counts.values())
