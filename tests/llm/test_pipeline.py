"""The registered queries against their SQL, and the pipeline against brute force."""

import re
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from isoloir.llm import quality, toxicity
from isoloir.llm.queries import ORACLE, QUERIES, held_out
from pyspark.sql import functions as F

from tests.conftest import SF_DIR

from .conftest import BLANKS, ODD_TEXTS, sentence
from .test_dedup import LOOSE_TEXTS, kept_rows, near_classes, one_row_each
from .test_tokens import check_packing

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(want, key=str)


def test_every_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == list(range(1, 14))


def test_near_duplicates_of_the_test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op8_ngram_jaccard"](spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(near_classes([tuple(r) for r in docs]).elements())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again; the first entry is the input."""
    folder = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SMALL).write.parquet(str(folder / name))
        frames.append(spark.read.parquet(str(folder / name)))
    return frames


def test_stages_return_documents(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "exact_dedup", "ngram_jaccard", "packing"]
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns
        assert 0 < after.count() <= before.count()
        assert after.exceptAll(before).isEmpty()


def test_stages_keep_what_they_should(spark, stages):
    docs, good, clean, once, apart, packed = stages
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in stages[:-1]]

    measured = quality.measure_documents(docs, quality.train(docs, labels)).where("kept")
    assert ids[1] == {r.doc_id for r in measured.select("doc_id").collect()}
    field = toxicity.train(good, labels, ~held_out())
    scored = toxicity.tag_documents(good, field).where(F.col("score") < toxicity.TOXIC_FROM)
    assert ids[2] == {r.doc_id for r in scored.select("doc_id").collect()}

    first = {}
    for r in sorted(clean.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(BLANKS, " ", r.text or ""), r.doc_id)
    assert ids[3] == set(first.values())
    classes = near_classes([(r.doc_id, r.text) for r in once.select("doc_id", "text").collect()])
    assert ids[4] == {least for _, _, least in classes}
    texts = [(r.doc_id, r.text) for r in apart.select("doc_id", "text").collect()]
    used, least = check_packing(packed.collect(), texts, 2048)
    assert used <= least * 1.02 + 1


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    lengths = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert got.columns == stages[-1].columns
    assert got.select(lengths).exceptAll(stages[-1].select(lengths)).isEmpty()
    assert got.count() == stages[-1].count()


def test_documents_of_odd_kinds_pass_every_stage(spark, odd, none):
    docs = odd.withColumn("text", F.when(F.col("doc_id") == 3, None).otherwise(F.col("text")))
    for start in (docs, none):
        frame = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, SMALL)
            assert frame.columns == odd.columns
        assert frame.count() <= start.count()
        corpus_pipeline.STAGES[-1][1](spark, frame, SMALL).count()


def test_rows_with_loose_ids_pass_both_dedups_like_brute_force(spark):
    docs = spark.createDataFrame(ODD_TEXTS + LOOSE_TEXTS, "doc_id long, text string").repartition(3)
    once = corpus_pipeline.drop_copies(spark, docs, SMALL).cache()
    rows = [tuple(r) for r in once.collect()]
    assert (None, sentence(70, 30)) in rows and {(30, LOOSE_TEXTS[4][1]), (30, LOOSE_TEXTS[5][1])} < set(rows)
    apart = corpus_pipeline.drop_near_copies(spark, once, SMALL)
    assert apart.columns == docs.columns
    assert kept_rows(apart.collect(), rows) == one_row_each(rows)


@pytest.mark.parametrize("missing", ["isoloir.llm", "corpus_pipeline", "tiktoken"])
def test_the_rest_works_without_this_part(tmp_path, missing):
    root = Path(corpus_pipeline.__file__).parent
    code = (
        "import sys; sys.path.insert(0, sys.argv[1]); "
        f"sys.modules['{missing}'] = None; import __spark_entry__ as e; "
        "assert not any(n.startswith('op') for n in e.queries()) and 'flagship' in e.queries()"
    )
    subprocess.run([sys.executable, "-B", "-c", code, str(root)], check=True, cwd=tmp_path)
