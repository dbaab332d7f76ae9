"""Every registered query against the same answer in SQL."""

import math
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as contract  # noqa: E402
from isoloir.checks.queries import QUERIES  # noqa: E402
from isoloir.checks.sql import ORACLE  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def sortable(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries()) >= set(QUERIES)


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "colour_class" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=sortable)
    answer = duck.execute(ORACLE[name])
    assert sorted(d[0] for d in answer.description) == names
    quoted = ", ".join(f'"{n}"' for n in names)
    wanted = duck.execute(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall()
    wanted = sorted(wanted, key=sortable)
    assert len(got) == len(wanted)
    assert got, "a query without rows checks nothing"
    for g, w in zip(got, wanted):
        assert all(same(a, b) for a, b in zip(g, w)), (g, w)
