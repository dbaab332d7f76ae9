"""Invariants over whole tables."""

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from isoloir.checks.queries import _stations
from isoloir.checks.sources import export_2017, geo, official
from isoloir.operators import approximate_thresholds, fit_scales, quantile_thresholds
from isoloir.plans.build import export_stations, rebuilt_stations
from isoloir.plans.layers import SHOWN_RATE, map_layer
from isoloir.plans.questions import commune_pairs, communes_by_department, departments
from isoloir.schema import COMMUNE, FRANCE_2017, LABEL, STORED_SCHEMA
from isoloir.sinks import write_stations_jdbc
from isoloir.sources import read_stations_jdbc


@pytest.fixture(scope="module")
def stations(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stations") / "table")
    _stations(spark, SF_DIR, 2017).write.parquet(path)
    return spark.read.parquet(path)


def test_union_keeps_every_row(spark, stations):
    exported = export_stations(export_2017(spark, SF_DIR), FRANCE_2017)
    rebuilt = rebuilt_stations(official(spark, SF_DIR), geo(spark, SF_DIR), FRANCE_2017)
    assert stations.count() == exported.count() + rebuilt.count()
    assert stations.union(stations).count() == 2 * stations.count()


def test_layer_keeps_every_row_and_its_ranges(stations):
    layer = map_layer(stations).persist()
    assert layer.count() == stations.count()
    classes, sizes = layer.agg(
        F.array(F.min("colour_class"), F.max("colour_class")),
        F.array(F.min("size"), F.max("size")),
    ).first()
    assert classes == [0, 5] and sizes == [0.0, 50.0]
    assert layer.where("colour <> stroke_colour").count() == 0
    layer.unpersist()


def test_class_never_falls_as_the_rate_rises(stations):
    layer = map_layer(stations)
    bounds = rows(
        layer.groupBy("colour_class")
        .agg(F.min(SHOWN_RATE), F.max(SHOWN_RATE), F.count("*"))
        .orderBy("colour_class")
    )
    assert [b[0] for b in bounds] == list(range(6))
    assert all(low[2] < high[1] for low, high in zip(bounds, bounds[1:]))
    share = sum(b[3] for b in bounds) / 6
    assert all(abs(b[3] - share) < 0.1 * share for b in bounds)


def test_scales_do_not_depend_on_the_partitioning(stations):
    one, many = fit_scales(stations.coalesce(1)), fit_scales(stations.repartition(13))
    assert one == many
    assert one.thresholds == quantile_thresholds(stations, "Pourcentage_Abstentions")


def test_approximate_scales_are_near(stations):
    exact = quantile_thresholds(stations, "Pourcentage_Abstentions")
    near = approximate_thresholds(stations, "Pourcentage_Abstentions")
    assert near == pytest.approx(exact, abs=0.5)
    assert fit_scales(stations, accuracy=10_000).thresholds == near


def test_department_lists_hold_the_distinct_pairs(stations):
    labels = [r[0] for r in rows(departments(stations))]
    assert labels == sorted(set(labels))
    nested = communes_by_department(stations, labels)
    flat = rows(nested.select(LABEL, F.explode("communes")))
    wanted = rows(stations.select(LABEL, COMMUNE).distinct())
    assert sorted(flat) == sorted(wanted) == sorted(rows(commune_pairs(stations, labels)))
    assert all(r[1] == sorted(r[1]) for r in rows(nested))


def test_relational_calls(spark, stations, monkeypatch):
    """What is asked of Spark's JDBC source; no database runs here."""
    calls = []
    monkeypatch.setattr(
        DataFrameWriter, "jdbc", lambda self, url, table, **kw: calls.append((url, table, kw))
    )
    empty = spark.createDataFrame([], STORED_SCHEMA)
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, url, table, **kw: calls.append((url, table, kw)) or empty
    )
    monkeypatch.setattr(DataFrameReader, "load", lambda self: empty)
    monkeypatch.setattr(
        DataFrameReader, "options", lambda self, **kw: calls.append(("options", kw)) or self
    )
    write_stations_jdbc(stations, "jdbc:x", "stations_2017", 12, {"user": "u"})
    read_stations_jdbc(spark, "jdbc:x", "stations_2017", ["a < 1", "a >= 1"])
    read_stations_jdbc(spark, "jdbc:x", "stations_2017", properties={"user": "u"}, fetch_size=7)
    rows = {"fetchsize": "10000"}
    assert calls == [
        ("jdbc:x", "stations_2017", {"properties": {"user": "u"}}),
        ("jdbc:x", "stations_2017", {"predicates": ["a < 1", "a >= 1"], "properties": rows}),
        ("options", {"url": "jdbc:x", "dbtable": "stations_2017", "fetchsize": "7", "user": "u"}),
    ]
