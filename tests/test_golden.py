"""The invented files through the whole build, then every question."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from isoloir.operators.scales import fit_scales
from isoloir.plans.build import read_election
from isoloir.plans.layers import CHANNELS, SHOWN_RATE, TOOLTIP, map_layer, national_layer
from isoloir.plans.questions import (
    commune_pairs,
    communes_by_department,
    departments,
    in_department,
    metropolitan,
    stations_in,
)
from isoloir.functions import col
from isoloir.schema import CODE, COMMUNE, ELECTION, FRANCE_2017, LABEL, STATION_SCHEMA, STORED_SCHEMA

WANTED_2017 = {
    ("01", "Ain", "Bourg", 1000, 205, 20.5, 46.2, 5.22, "Ain (01)", "1 rue A Bourg 1000"),
    ("33", "Gironde", "Bordeaux", 900, 100, 11.11, 44.8, -0.58, "Gironde (33)", "2 quai B Bordeaux 33000"),
    ("75", "Paris", "Paris", 1200, 240, 20.0, 48.86, 2.34, "Paris (75)", "4 place du Louvre 75001 Paris"),
    ("75", "Paris", "Paris", 800, 80, 10.0, 48.87, 2.35, "Paris (75)", None),
}
WANTED_2022 = {
    ("33", "Gironde", "Bordeaux", 950, 190, 20.0, 44.8, -0.58, "Gironde (33)", "Ecole B Bordeaux"),
    ("ZA", "Guadeloupe", "Les Abymes", 400, 200, 50.0, 16.27, -61.5, "Guadeloupe (ZA)", "Ecole G Les Abymes"),
    ("75", "Paris", "Paris", 1000, 250, 25.0, 48.86, 2.34, "Paris (75)", "4 place du Louvre 75001 Paris"),
}


def test_stations_2017(stations_2017):
    got = rows(stations_2017)
    assert len(got) == 4
    assert {r[:-1] for r in got} == WANTED_2017
    assert {r[-1] for r in got} == {2017}


def test_stations_2022_with_gzipped_geo(stations_2022):
    got = rows(stations_2022)
    assert len(got) == 3
    assert {r[:-1] for r in got} == WANTED_2022


def test_station_types(stations_2017):
    assert [(f.name, f.dataType) for f in stations_2017.schema] == [
        (f.name, f.dataType) for f in STORED_SCHEMA
    ]
    assert stations_2017.drop(ELECTION).columns == STATION_SCHEMA.fieldNames()


def test_postal_zero_can_be_kept(spark, files):
    kept = read_election(
        spark,
        FRANCE_2017,
        files["export_2017.csv"],
        files["official_2017.txt"],
        files["geo.csv"],
        keep_postal_zero=True,
    )
    assert rows(kept.where(F.col(COMMUNE) == "Bourg").select("`Adresse complète`")) == [
        ("1 rue A Bourg 01000",)
    ]


def test_departments(stations_2017):
    assert rows(departments(stations_2017)) == [("Ain (01)",), ("Gironde (33)",), ("Paris (75)",)]


def test_departments_collated(spark):
    df = spark.createDataFrame([("Épinal",), ("eA",), ("Foix",), ("Épinal",)], f"`{LABEL}` string")
    assert rows(departments(df)) == [("Foix",), ("eA",), ("Épinal",)]
    assert rows(departments(df, collation="fr")) == [("eA",), ("Épinal",), ("Foix",)]


def test_communes_by_department(stations_2017):
    got = dict(rows(communes_by_department(stations_2017, ["Ain (01)", "Paris (75)", " "])))
    assert got == {"Ain (01)": ["Bourg"], "Paris (75)": ["Paris"]}
    assert rows(communes_by_department(stations_2017, [])) == []


def test_pairs_and_lists_agree(stations_2017):
    labels = ["Ain (01)", "Gironde (33)", "Paris (75)"]
    nested = communes_by_department(stations_2017, labels)
    flat = rows(nested.select(LABEL, F.explode("communes")))
    assert sorted(flat) == sorted(rows(commune_pairs(stations_2017, labels)))


def test_stations_in(stations_2017):
    assert [r[2] for r in rows(stations_in(stations_2017, [" Bordeaux ", ""]))] == ["Bordeaux"]
    assert rows(stations_in(stations_2017, ["", None])) == []
    assert rows(stations_in(stations_2017, [])) == []


def test_stations_in_pairs(spark, stations_2017):
    assert len(rows(stations_in(stations_2017, [("Paris (75)", "Paris")]))) == 2
    assert rows(stations_in(stations_2017, [("Ain (01)", "Paris")])) == []
    assert rows(stations_in(stations_2017, [("", "Paris"), ("Ain (01)", " ")])) == []
    chosen = spark.createDataFrame([(" Paris (75)", "Paris"), ("Ain (01)", "Paris")], "d string, c string")
    assert len(rows(stations_in(stations_2017, chosen.union(chosen)))) == 2
    with pytest.raises(TypeError):
        stations_in(stations_2017, ["Paris", ("Ain (01)", "Bourg")])


def test_metropolitan(stations_2022):
    assert {r[2] for r in rows(metropolitan(stations_2022))} == {"Bordeaux", "Paris"}
    overseas = stations_2022.limit(1).withColumn(CODE, F.explode(F.array(*map(F.lit, ("971", "988", "96", "9")))))
    assert {r[0] for r in rows(metropolitan(overseas).select(col(CODE)))} == {"96", "9"}


def test_in_department(stations_2017):
    assert len(rows(in_department(stations_2017, "75"))) == 2
    assert rows(in_department(stations_2017, "7")) == []


def test_layer_of_all_rows(stations_2017):
    scales = fit_scales(stations_2017)
    assert scales.thresholds == pytest.approx((10.555, 11.11, 15.555, 20.0, 20.25), abs=1e-9)
    assert scales.centre == pytest.approx((46.835, 2.32), abs=1e-9)
    layer = map_layer(stations_2017)
    assert layer.columns == ["latitude", "longitude", *TOOLTIP, *CHANNELS]
    got = sorted(
        rows(layer.select(SHOWN_RATE, "colour_class", "colour", "stroke_colour", "Inscrits", "size"))
    )
    assert got == [
        (10.0, 0, "#FFFF00", "#FFFF00", 800, 0.0),
        (11.11, 2, "#FF9900", "#FF9900", 900, 12.5),
        (20.0, 4, "#FF3300", "#FF3300", 1200, 50.0),
        (20.5, 5, "#FF0000", "#FF0000", 1000, 25.0),
    ]


def test_layer_of_one_station(stations_2017):
    one = map_layer(stations_in(stations_2017, ["Bordeaux"]))
    assert rows(one.select("colour_class", "colour", "size")) == [(5, "#FF0000", 25.0)]


def test_layer_of_no_station(stations_2017):
    assert rows(map_layer(stations_in(stations_2017, []))) == []


def test_scales_belong_to_the_shown_rows(stations_2017):
    paris = map_layer(in_department(stations_2017, "75"))
    got = sorted(rows(paris.select(SHOWN_RATE, "colour_class", "size")))
    assert got == [(10.0, 0, 0.0), (20.0, 5, 50.0)]


def test_national_layer_computed(spark, stations_2022):
    assert national_layer(spark, stations_2022)[0].count() == 2


def test_no_python_in_the_plan(stations_2017):
    plan = plan_of(map_layer(stations_2017))
    assert "Python" not in plan and "Pandas" not in plan
    assert "BroadcastHashJoin" in plan
