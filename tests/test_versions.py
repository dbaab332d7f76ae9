"""Tables with versions: all of a change or nothing of it, and layers that know their stations."""

import pytest
from conftest import plan_of, rows
from isoloir import versions
from isoloir.operators import fit_scales
from isoloir.plans.layers import (
    StaleLayer,
    map_layer,
    publish_national_layer,
    published_national_layer,
)
from isoloir.plans.questions import metropolitan, stations_in
from isoloir.schema import ELECTION, STORED_SCHEMA
from isoloir.sinks import replace_stations
from isoloir.sources import read_stations
from isoloir.versions import Outrun, current, publish_stations, read_published, remove_old_versions
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame


@pytest.fixture
def both(stations_2017, stations_2022):
    return stations_2017.unionByName(stations_2022)


def counts(df):
    return dict(rows(df.groupBy(ELECTION).count()))


def test_versions_are_read_as_they_were(spark, both, stations_2017, tmp_path):
    path = str(tmp_path / "t")
    assert publish_stations(both, path).number == 1
    publish_stations(stations_in(stations_2017, ["Bourg"]), path)
    publish_stations(both.where("false"), path, elections=[2022])
    assert counts(read_stations(spark, path)) == {2017: 1}
    assert [counts(read_stations(spark, path, version=v)) for v in (1, 2)] == [{2017: 4, 2022: 3}, {2017: 1, 2022: 3}]
    assert read_stations(spark, path, 2022).count() == 0 and read_stations(spark, path, 2022, 1).count() == 3
    assert read_stations(spark, path).schema == STORED_SCHEMA
    assert sorted(rows(read_stations(spark, path, version=1)), key=str) == sorted(rows(both), key=str)
    publish_stations(both.where("false"), path, elections=[2017])
    assert read_stations(spark, path).count() == 0
    with pytest.raises(ValueError, match="no version 9"):
        read_stations(spark, path, version=9)
    with pytest.raises(ValueError, match="no version"):
        read_published(spark, str(tmp_path / "none"))


def test_a_plain_folder_is_read_as_before(spark, both, tmp_path):
    path = str(tmp_path / "plain")
    replace_stations(both, path)
    assert current(spark, path) is None and read_stations(spark, path, 2017).count() == 4


def test_failure_in_the_second_election_changes_neither(spark, both, stations_2017, tmp_path):
    path = str(tmp_path / "t")
    publish_stations(both, path)
    before = sorted(rows(read_stations(spark, path)), key=str)
    broken = both.withColumn(
        "Inscrits", F.when(F.col(ELECTION) == 2022, F.raise_error(F.lit("no such file")).cast("int")).otherwise(0)
    )
    with pytest.raises(Exception, match="no such file"):
        publish_stations(broken.repartition(4), path)
    assert sorted(rows(read_stations(spark, path)), key=str) == before
    # A reader that has resolved a version keeps it, whatever is published afterwards.
    old = read_stations(spark, path)
    publish_stations(stations_2017.where("false"), path, elections=[2017, 2022])
    assert sorted(rows(old), key=str) == before and read_stations(spark, path).count() == 0


def test_several_elections_are_one_computation(spark, both, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    once = spark.createDataFrame(both.rdd.map(counted), both.schema)
    publish_stations(once, str(tmp_path / "t"), elections=[2017, 2022])
    assert read.value == 7


def test_the_second_of_two_writers_is_told(spark, both, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_stations(both, path)
    seen = current(spark, path)
    publish_stations(both.where(f"{ELECTION} = 2017"), path)
    monkeypatch.setattr(versions, "current", lambda *a: seen)
    with pytest.raises(Outrun, match="version 2"):
        publish_stations(both.where("false"), path, elections=[2017])
    monkeypatch.undo()
    assert current(spark, path).number == 2 and read_stations(spark, path).count() == 7
    assert not [n for n in versions._Files(spark, path).names("versions") if n.startswith("_")]


def test_values_that_name_no_folder(spark, both, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="folder"):
        publish_stations(both.withColumn(ELECTION, F.lit(None).cast("int")), path)
    with pytest.raises(ValueError, match="folder"):
        publish_stations(both.withColumn(ELECTION, F.lit("a/b")), path)
    publish_stations(both, path)
    with pytest.raises(ValueError, match="partitioned by"):
        publish_stations(both, path, partition="Abstentions")


def test_old_versions_go_with_their_data(spark, both, tmp_path):
    path = str(tmp_path / "t")
    for part in (both, both.where(f"{ELECTION} = 2022"), both.where(f"{ELECTION} = 2022")):
        publish_stations(part, path)
    assert remove_old_versions(spark, path, keep=1) == [1, 2]
    # The first version's data are still those of 2017.
    assert counts(read_stations(spark, path)) == {2017: 4, 2022: 3}
    assert len(versions._Files(spark, path).names("data")) == 2
    with pytest.raises(ValueError, match="no version 1"):
        read_stations(spark, path, version=1)


# Layers


def test_a_layer_follows_its_stations(spark, both, stations_2022, tmp_path):
    path = str(tmp_path / "t")
    publish_stations(stations_2022, path)
    with pytest.raises(StaleLayer):
        published_national_layer(spark, path, on_stale="raise")
    layer, scales = publish_national_layer(spark, path)
    assert sorted(rows(layer), key=str) == sorted(rows(map_layer(metropolitan(stations_2022))), key=str)
    assert scales == fit_scales(metropolitan(stations_2022))
    made = current(spark, path).number
    assert published_national_layer(spark, path, on_stale="raise")[1] == scales
    assert current(spark, path).number == made
    publish_stations(both, path)
    with pytest.raises(StaleLayer):
        published_national_layer(spark, path, on_stale="raise")
    layer, scales = published_national_layer(spark, path)
    assert scales == fit_scales(metropolitan(both)) and layer.count() == metropolitan(both).count()
    assert published_national_layer(spark, path, on_stale="raise")[1] == scales


def test_points_and_scales_appear_together(spark, stations_2022, both, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_stations(stations_2022, path)
    before = publish_national_layer(spark, path)[1]
    publish_stations(both, path)
    stale = current(spark, path)

    def fails(*args):
        raise OSError("disk")

    # The points are written, the pointer is not: nothing of the new layer is to be seen.
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", fails)
        with pytest.raises(OSError, match="disk"):
            publish_national_layer(spark, path)
    assert current(spark, path) == stale
    assert stale.layers["national"]["scales"]["size_high"] == before.size_high
    # Stations that change while a layer is being made leave it behind.
    write = DataFrame.write.fget

    def meanwhile(df):
        if "colour" in df.columns:
            monkeypatch.setattr(DataFrame, "write", property(write))
            publish_stations(stations_2022.where("false"), path, elections=[2017])
        return write(df)

    monkeypatch.setattr(DataFrame, "write", property(meanwhile))
    monkeypatch.setattr("isoloir.plans.layers.published_national_layer", lambda *a: None)
    publish_national_layer(spark, path)
    monkeypatch.undo()
    with pytest.raises(StaleLayer):
        published_national_layer(spark, path, on_stale="raise")
    assert published_national_layer(spark, path)[1] == fit_scales(metropolitan(stations_2022))


def test_an_election_is_one_pruned_folder(spark, both, tmp_path):
    path = str(tmp_path / "t")
    publish_stations(both, path)
    plan = plan_of(read_stations(spark, path, 2022))
    assert "election=2022" in plan and "election=2017" not in plan
