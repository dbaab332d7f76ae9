"""The corpus pipeline: quality, toxicity, exact and near duplicates, packing.

Each stage works on all rows that its predecessor kept and returns the columns of
``documents``; the last returns the packed pieces. Classifiers learn from the labelled
documents among a stage's own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isoloir.llm import exact_dedup, ngram_join, packing, quality, toxicity
from isoloir.llm.common import read_table, stored
from isoloir.llm.queries import held_out, public_file


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and their model keep.

    A null or empty text goes. Without labels of both kinds among ``docs`` only the rules
    decide; labels that contradict each other are left out. Rows that repeat are judged each.
    An empty table stays empty; other columns pass through unchanged, as in every stage.
    """
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic.

    A null or empty text stays. Without toxic and clean labels among ``docs`` all stay.
    Rows that repeat are scored each; an empty table stays empty.
    """
    labels = read_table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels, ~held_out()))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the first.

    Nulls and empty texts are equal texts. The smallest id stays, a null one last; of rows
    that tie, any one. An empty table stays empty.
    """
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links into a class, the first.

    Nulls and texts without words are in no class and stay. The smallest id stays, a null one
    last; rows that repeat an id are documents each. An empty table stays empty.
    """
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, placed in sequences.

    A null or empty text is one piece. Rows that repeat are packed each; an empty table gives
    no pieces. The result has the columns of pieces, whatever those of ``docs`` are.
    """
    return packing.pack_documents(docs, public_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", drop_poor),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("packing", pack),
]
#: A trained model's verdicts and a packing are not SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
