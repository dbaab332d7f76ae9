"""The plans Spark makes of the operators."""

import re
from contextlib import contextmanager

import pytest
from conftest import SF_DIR, executed_plan, plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from isoloir.checks.queries import QUERIES
from isoloir.operators import (
    apply_scales,
    attach_by_key,
    drop_incomplete,
    fit_scales,
    quantile_thresholds,
    where_any_pair,
    where_equals,
    where_member,
    where_prefix,
    where_without_prefixes,
)
from isoloir.operators.selection import covering_ranges
from isoloir.plans.questions import (
    commune_pairs,
    communes_by_department,
    communes_in_chunks,
    stations_in,
)
from isoloir.schema import CODE, COMMUNE, FRANCE_2017
from isoloir.sinks import replace_stations
from isoloir.sinks.tables import _clustered
from isoloir.sources import read_delimited, read_stations


@contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def pushed(df):
    return re.search(r"PushedFilters: (\[.*?\]), ReadSchema", plan_of(df)).group(1)


def test_selections_reach_the_scan(spark):
    part = table(spark, "part")
    assert "In(p_brand" in pushed(where_member(part, "p_brand", ["Brand#1", "Brand#2"]))
    assert "EqualTo(p_brand,Brand#1)" in pushed(where_equals(part, "p_brand", "Brand#1"))
    assert "StringStartsWith(p_brand,Brand#1)" in pushed(where_prefix(part, "p_brand", "Brand#1"))
    assert "Not(StringStartsWith(p_brand,Z))" in pushed(where_without_prefixes(part, "p_brand", "Z"))
    assert "IsNotNull(p_brand)" in pushed(drop_incomplete(part, ["p_brand"]))
    pairs = stations_in(part, [("ECONOMY", "Brand#1"), ("PROMO", "Brand#2")], "p_brand", "p_type")
    assert "In(p_brand" in pushed(pairs) and "In(p_type" in pushed(pairs)


def test_prefix_default_that_matches_keeps_nulls(spark):
    df = spark.createDataFrame([("75001",), ("13001",), (None,)], "p string")
    assert rows(where_prefix(df, "p", "75")) == [("75001",)]
    assert rows(where_prefix(df, "p", "75", default="75000")) == [("75001",), (None,)]


def test_only_used_columns_are_read(spark, files):
    df = read_delimited(spark, files["export_2017.csv"], FRANCE_2017.export).select("Commune")
    assert "ReadSchema: struct<Commune:string>" in plan_of(df)


def test_election_is_pruned(spark, stations_2017, tmp_path):
    path = str(tmp_path / "stations")
    replace_stations(stations_2017, path)
    plan = plan_of(stations_in(read_stations(spark, path, 2017), ["Bourg"]))
    assert "election#" in re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    assert f"EqualTo(`{COMMUNE}`,Bourg)" in plan


def test_filter_goes_below_the_union(stations_2017):
    plan = stations_in(stations_2017, ["Bourg"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("Filter")


def test_colouring_is_one_projection(spark):
    orders = table(spark, "orders").select("o_orderkey", "o_totalprice")
    scales = fit_scales(orders, "o_totalprice", "o_totalprice", "o_totalprice", "o_totalprice")
    plan = plan_of(apply_scales(orders, scales, "o_totalprice", "o_totalprice"))
    assert "Exchange" not in plan and "Join" not in plan
    assert "WholeStageCodegen" in plan or "*(1) Project" in plan


def test_quantile_rounds_read_one_column_and_push_their_spans(spark, monkeypatch):
    lineitem = table(spark, "lineitem")
    plans = []
    collect = DataFrame.collect

    def watched(df):
        plans.append(plan_of(df))
        return collect(df)

    monkeypatch.setattr(DataFrame, "collect", watched)
    quantile_thresholds(lineitem, "l_extendedprice", steps=50, few_rows=0)
    rounds = [plan for plan in plans if "span#" in plan]
    assert len(rounds) >= 2
    for plan in rounds:
        assert "ReadSchema: struct<l_extendedprice:double>" in plan
        # Counted where the rows are before anything is shuffled.
        assert re.search(r"Exchange hashpartitioning\(span#.*\n.*HashAggregate\(", plan)
    assert "GreaterThanOrEqual(l_extendedprice" in rounds[1]


def test_build_shuffles_nothing_when_the_geo_side_is_small(stations_2017):
    plan = plan_of(stations_2017)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_large_sides_are_not_broadcast(spark):
    with settings(spark, autoBroadcastJoinThreshold="1KB", adaptive__autoBroadcastJoinThreshold="1KB"):
        df = QUERIES["composite_key_join"](spark, SF_DIR)
        assert "SortMergeJoin" in executed_plan(df)


@pytest.mark.parametrize("hash_below,join", [("0b", "SortMergeJoin"), ("64MB", "ShuffledHashJoin")])
def test_a_key_with_a_third_of_the_rows_is_split(spark, hash_below, join):
    lineitem = table(spark, "lineitem").select(
        F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")).alias("k"),
        F.concat(*[F.sha2(F.concat("l_extendedprice", F.lit(i)), 256) for i in range(4)]).alias(
            "payload"
        ),
    )
    orders = table(spark, "orders").select(F.col("o_orderkey").alias("ok"), "o_totalprice")
    small = dict(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__maxShuffledHashJoinLocalMapThreshold=hash_below,
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
        files__maxPartitionBytes="64KB",
    )
    with settings(spark, **small):
        df = attach_by_key(
            lineitem.repartition(16),
            orders,
            F.col("k").cast("string"),
            F.col("ok").cast("string"),
            ("k", "payload"),
            ("o_totalprice",),
        )
        plan = executed_plan(df)
        assert f"{join}(skew=true)" in plan
        assert df.count() == lineitem.count()


def test_distinct_pairs_combine_before_the_shuffle(spark):
    plan = plan_of(commune_pairs(table(spark, "part"), ["ECONOMY"], "p_type", "p_brand"))
    assert re.search(r"HashAggregate.*Exchange hashpartitioning\(p_type#\d+, p_brand#\d+", plan, re.S)
    assert plan.count("HashAggregate(") >= 2


def test_writing_shuffles_only_to_cluster(stations_2017):
    assert "REBALANCE" not in plan_of(_clustered(stations_2017, "election", ()))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(
        _clustered(stations_2017, "election", (CODE, COMMUNE))
    )


@pytest.mark.parametrize("n", [3, 10_000, 10_001, 20_000])
def test_a_listed_selection_never_shuffles_what_it_selects_from(spark, n):
    part = table(spark, "part").select("p_brand", F.col("p_partkey").cast("string").alias("k"))
    for df in (
        where_member(part, "k", [str(i) for i in range(0, 2 * n, 2)]),
        where_any_pair(part.withColumn("d", F.lit("x")), "d", "k", [("x", str(i)) for i in range(0, 2 * n, 2)]),
    ):
        with settings(spark, adaptive__enabled="false"):
            assert "Exchange hashpartitioning" not in plan_of(df)
        assert df.count() == part.where(f"cast(k as int) % 2 = 0 AND cast(k as int) < {2 * n}").count()


def test_lists_long_lists_and_tables_select_alike(spark):
    df = spark.createDataFrame([(1, "n1", "a"), (2, "n2", "b"), (3, None, "c")], "id int, name string, x string")
    values = ["\tn1\n", " ", None, "n1", "\u00a0n1\x1f"]
    as_table = spark.createDataFrame([(v,) for v in values], "v string")
    for chosen, options in ((values, {}), (values, {"inline": 0}), (values, {"inline": 0, "filtered": 0}), (as_table, {})):
        found = where_member(df, "name", chosen, **options)
        assert found.columns == df.columns and rows(found) == [(1, "n1", "a")]
    pairs = [("\tn1\n", " a "), ("n2", "a"), (" ", "b"), (None, None)]
    as_table = spark.createDataFrame(pairs, "v string, w string")
    for chosen, options in ((pairs, {}), (pairs, {"inline": 0}), (pairs, {"inline": 0, "filtered": 0}), (as_table, {})):
        found = where_any_pair(df, "name", "x", chosen, **options)
        assert found.columns == df.columns and rows(found) == [(1, "n1", "a")]
    assert where_member(df, "name", []).count() == where_any_pair(df, "name", "x", []).count() == 0


def test_ten_thousand_pairs_of_different_first_values(spark):
    df = spark.range(30_000).selectExpr("cast(id as string) a", "cast(id % 9 as string) b")
    pairs = [(str(k), str(k % 9)) for k in range(0, 20_000, 2)]
    assert where_any_pair(df, "a", "b", pairs).count() == len(pairs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def scanned_rows(df):
    """Rows that the scan gave to the filter above it, after running the query."""
    with settings(df.sparkSession, adaptive__enabled="false"):
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    return max(s.metrics().apply("numOutputRows").value() for s in scans if s.nodeName().startswith("Scan parquet"))


@pytest.fixture(scope="module")
def stored_names(spark, tmp_path_factory):
    """Sixteen row groups: names are spread over them all, codes are not."""
    path = str(tmp_path_factory.mktemp("bloom"))
    rows = spark.range(0, 160_000, 1, 1).selectExpr(
        "concat('name ', id * 7919 % 160000) AS name", "concat('code ', lpad(id, 6, '0')) AS code"
    )
    options = {"parquet.block.size": 200_000, "parquet.bloom.filter.enabled#name": "true", "parquet.enable.dictionary": "false"}
    rows.write.options(**options).mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def test_long_lists_skip_row_groups(spark, stored_names):
    everything = stored_names.count()
    near = [f"name {k * 7919 % 160000}" for k in range(50)]
    wanted = near + [f"absent's \\ {k}" for k in range(3000)]
    found = where_member(stored_names, "name", wanted)
    assert "PushedFilters: [In(name" in plan_of(found) and "Join" not in plan_of(found)
    assert found.count() == 50 and scanned_rows(found) < everything / 3
    # Too many for a filter: the ranges they lie in are one, and the rest is a join.
    codes = [f"code {k:06d}" for k in range(40_000, 65_000)]
    found = where_member(stored_names, "code", codes)
    assert "GreaterThanOrEqual(code" in plan_of(found) and "LeftSemi" in plan_of(found)
    assert found.count() == 25_000 and scanned_rows(found) < everything / 3
    pairs = [(n, f"code {k:06d}") for k, n in enumerate(near)] + [(f"absent {k}", "x") for k in range(3000)]
    found = where_any_pair(stored_names, "name", "code", pairs)
    assert found.count() == 50 and scanned_rows(found) < everything / 3


def test_covering_ranges_hold_every_value():
    values = [f"{k * 7919 % 1000}é" for k in range(1000)] + ["\U0001d11e", "\uffee"]
    spans = covering_ranges(values, 7)
    assert len(spans) <= 7 and all(a.encode() <= b.encode() for a, b in spans)
    assert all(any(a.encode() <= v.encode() <= b.encode() for a, b in spans) for v in values)
    assert all(x[1].encode() < y[0].encode() for x, y in zip(spans, spans[1:]))
    assert covering_ranges([]) == []


def test_written_filters_are_there(spark, tmp_path):
    import pyarrow.parquet as pq

    names = spark.range(5000).selectExpr("concat('n', id) AS `Libellé de la commune`", "1 AS election")
    sizes = []
    for k, bloom in enumerate(((), ("Libellé de la commune",))):
        replace_stations(names, f"{tmp_path}/{k}", bloom_on=bloom)
        files = list((tmp_path / str(k)).rglob("*.parquet"))
        sizes.append(sum(f.stat().st_size for f in files))
        assert all(pq.ParquetFile(f).metadata.num_rows for f in files)
    assert sizes[1] > sizes[0] + 5000


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_hold_what_lists_hold(spark, size):
    pairs = [("a", f"{k * 37 % 501}é") for k in range(501)] * 2 + [("b", "x"), ("b", None), ("c", "z")]
    stations = spark.createDataFrame(pairs, "d string, c string").repartition(5)
    whole = dict(rows(communes_by_department(stations, ["a", "b"], "d", "c")))
    chunks = rows(communes_in_chunks(stations, ["a", "b"], size, "d", "c").orderBy("d", "chunk"))
    for label in ("a", "b"):
        mine = [c for c in chunks if c[0] == label]
        assert [c[1] for c in mine] == list(range(len(mine)))
        assert all(len(c[2]) == size for c in mine[:-1]) and 0 < len(mine[-1][2]) <= size
        assert [v for c in mine for v in c[2]] == [v for v in whole[label] if v is not None]
    assert communes_in_chunks(stations, [], size, "d", "c").collect() == []
