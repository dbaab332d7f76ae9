"""Files in, tables out and back."""

import gzip

import pytest
from conftest import EXPORT_2017, SF_DIR, rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql.conf import RuntimeConfig

from isoloir.__main__ import arguments, run
from isoloir.functions import col, drop_first_char
from isoloir.operators import conform, drop_incomplete, fit_scales
from isoloir.plans.layers import layer_with_scales, map_layer, national_layer
from isoloir.plans.questions import metropolitan, stations_in
from isoloir.schema import CODE, COMMUNE, ELECTION, FRANCE_2017, SourceSpec
from isoloir.session import scratch_folder, session_builder
from isoloir.sinks import ensure_database, replace_stations, replace_table, save_layer
from isoloir.sources import clean_copy, read_delimited, read_stations, read_stations_jdbc
from isoloir.sources.tables import jdbc_options


def written(tmp_path, name, data):
    path = tmp_path / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode("utf-8"))
    return str(path)


def spec(*columns, **options):
    return SourceSpec(columns=columns or None, **options)


def test_columns_are_found_by_name_in_the_wanted_order(spark, files):
    df = read_delimited(spark, files["export_2017.csv"], spec("Commune", CODE))
    assert df.columns == ["Commune", CODE]
    assert rows(df)[0] == ("Bourg", "01")
    assert {t for _, t in df.dtypes} == {"string"}


def test_missing_column_fails_before_anything_runs(spark, files):
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        read_delimited(spark, files["export_2017.csv"], spec(CODE, "location"))


def test_repeated_and_empty_header_names_elsewhere(spark, tmp_path):
    path = written(tmp_path, "t.csv", "a;b;b;;c\n1;2;3;4;5;6\n")
    assert rows(read_delimited(spark, path, spec("c", "a"))) == [("5", "1")]


def test_all_columns_without_a_list(spark, files):
    df = read_delimited(spark, files["official_2017.txt"], spec())
    assert len(df.columns) == 8 and "Code du b.vote" in df.columns
    assert df.count() == 4


def test_fields_beyond_the_header_are_ignored(spark, files):
    df = read_delimited(spark, files["official_2017.txt"], FRANCE_2017.official)
    assert rows(df)[-1] == ("13", "Bouches-du-Rhône", "1", "Marseille", "101", "700", "70", "10,00")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_record_terminators(spark, tmp_path, end):
    path = written(tmp_path, "t.csv", "a;b\n01;x\n02;y\n".replace("\n", end))
    assert rows(read_delimited(spark, path, spec("a", "b"))) == [("01", "x"), ("02", "y")]


def test_cr_terminator_leaves_a_line_feed_to_strip(spark, tmp_path):
    path = written(tmp_path, "t.csv", "a;b\r\n01;x\r\n02;y\r\n")
    df = drop_incomplete(read_delimited(spark, path, spec("a", "b", line_sep="\r")))
    assert rows(df.select(drop_first_char("a"), "b")) == [("01", "x"), ("02", "y")]


def test_quotes_separators_and_byte_order_mark(spark, tmp_path):
    text = '\ufeffa;b\n"x;y";"say ""hi"""\n\\;NA\n\n"";"null"\n'
    df = read_delimited(spark, written(tmp_path, "t.csv", text), spec("a", "b"))
    assert rows(df) == [("x;y", 'say "hi"'), ("\\", None), (None, None)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = written(tmp_path, "t.csv", 'a;b\n"x\ny";1\n')
    assert rows(read_delimited(spark, path, spec("a", "b", multiline=True))) == [("x\ny", "1")]


def test_encoding_belongs_to_the_source(spark, tmp_path):
    path = written(tmp_path, "t.csv", "numéro;b\n1;é\n".encode("latin-1"))
    assert rows(read_delimited(spark, path, spec("numéro", "b", encoding="ISO-8859-1"))) == [
        ("1", "é")
    ]
    with pytest.raises(AnalysisException):
        read_delimited(spark, path, spec("numéro"))


def test_gzip_is_read_directly_and_spread(spark, tmp_path):
    lines = "a,b\n" + "".join(f"{i},x\n" for i in range(1000))
    path = written(tmp_path, "t.csv.gz", gzip.compress(lines.encode()))
    one = read_delimited(spark, path, spec("a", separator=","))
    assert one.rdd.getNumPartitions() == 1 and one.count() == 1000
    many = read_delimited(spark, path, spec("a", separator=",", partitions=5))
    assert many.rdd.getNumPartitions() == 5 and many.distinct().count() == 1000


def test_scan_block_splits_the_file(spark, tmp_path):
    path = written(tmp_path, "t.csv", "a;b\n" + "1;xxxxxxxxxx\n" * 20_000)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "32KB")
        df = read_delimited(spark, path, spec("a"))
        assert df.rdd.getNumPartitions() >= 8
        assert df.count() == 20_000
    finally:
        spark.conf.set(key, before)


def test_null_tokens_per_source(spark, tmp_path):
    path = written(tmp_path, "t.csv", "a;b\n-;NA\n")
    assert rows(read_delimited(spark, path, spec("a", "b", na_tokens=("-", "")))) == [(None, "NA")]


def test_clean_copy(spark, files, tmp_path):
    target = str(tmp_path / "copy")
    clean_copy(spark, files["export_2017.csv"], SourceSpec(), target)
    back = read_delimited(spark, target, SourceSpec(separator=","))
    assert back.columns == EXPORT_2017.split("\n")[0].split(";")
    assert sorted(r[0] for r in rows(back.select(CODE))) == ["01", "33"]


def test_types_are_strict(spark):
    df = spark.createDataFrame([("12,5",)], "Inscrits string")
    from pyspark.sql import types as T

    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        conform(df, T.StructType([T.StructField("Inscrits", T.IntegerType())])).collect()


def test_an_election_replaces_only_itself(spark, stations_2017, stations_2022, tmp_path):
    path = str(tmp_path / "stations")
    replace_stations(stations_2017, path)
    replace_stations(stations_2022, path, cluster_by=(CODE, COMMUNE))
    assert read_stations(spark, path).count() == 7
    replace_stations(stations_in(stations_2017, ["Bourg"]), path)
    assert [r[0] for r in rows(read_stations(spark, path, 2017).select(col(COMMUNE)))] == ["Bourg"]
    assert read_stations(spark, path, 2022).count() == 3
    assert sorted(rows(read_stations(spark, path, 2022))) == sorted(rows(stations_2022))


def test_command_line_build(spark, files, stations_2017, tmp_path):
    out = str(tmp_path / "stations")
    argv = ["2017", "--export", files["export_2017.csv"], "--official", files["official_2017.txt"]]
    run(spark, arguments([*argv, "--geo", files["geo.csv.gz"], "--out", out, "--cluster"]))
    got = read_stations(spark, out, 2017)
    assert sorted(rows(got), key=str) == sorted(rows(stations_2017), key=str)


def test_database_and_table(spark, stations_2017, stations_2022, tmp_path):
    assert not ensure_database(spark, "Turnout_Db", str(tmp_path / "db"))
    assert ensure_database(spark, "turnout_db")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    replace_table(stations_2017, "turnout_db.stations")
    replace_table(stations_2022, "turnout_db.stations")
    replace_table(stations_in(stations_2017, ["Bordeaux"]), "turnout_db.stations")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    counts = dict(rows(spark.table("turnout_db.stations").groupBy(ELECTION).count()))
    assert counts == {2017: 1, 2022: 3}


def test_saved_layer(spark, stations_2022, tmp_path):
    path = str(tmp_path / "layer")
    layer, scales = layer_with_scales(metropolitan(stations_2022))
    save_layer(layer, path, scales)
    saved, read = national_layer(spark, saved=path)
    assert sorted(rows(saved)) == sorted(rows(layer)) == sorted(rows(map_layer(metropolitan(stations_2022))))
    assert read == scales and len(read.thresholds) == 5 and read.centre == scales.centre
    save_layer(layer.where("false"), path, fit_scales(metropolitan(stations_2022).where("false")))
    assert national_layer(spark, saved=path)[1].centre is None


def test_national_layer_needs_rows(spark, stations_2022):
    with pytest.raises(ValueError, match="needs stations"):
        national_layer(spark)
    assert national_layer(spark, stations_2022)[1] == fit_scales(metropolitan(stations_2022))


def test_a_named_election_without_rows_has_none_afterwards(spark, stations_2017, stations_2022, tmp_path):
    path = str(tmp_path / "stations")
    both = stations_2017.unionByName(stations_2022)
    replace_stations(both, path)
    replace_stations(stations_2017.where("false"), path, elections=[2017], cluster_by=(CODE,))
    assert dict(rows(read_stations(spark, path).groupBy(ELECTION).count())) == {2022: 3}
    # Rows of elections that are not named are not written.
    replace_stations(both, path, elections=[2017])
    assert dict(rows(read_stations(spark, path).groupBy(ELECTION).count())) == {2017: 4, 2022: 3}
    with pytest.raises(ValueError, match="folder"):
        replace_stations(both, path, elections=["../x"])


def test_jdbc_reader_is_asked_for(spark, monkeypatch):
    asked = jdbc_options("jdbc:x", "stations", 2022, "code", (1, 95), 8, 500)
    assert asked == {
        "url": "jdbc:x", "dbtable": "(SELECT * FROM stations WHERE election = 2022) AS chosen",
        "fetchsize": "500", "partitionColumn": "code", "lowerBound": "1", "upperBound": "95",
        "numPartitions": "8",
    }
    assert jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    with pytest.raises(ValueError, match="bounds"):
        jdbc_options("jdbc:x", "t", split_by="code")
    with pytest.raises(ValueError, match="either"):
        read_stations_jdbc(spark, "jdbc:x", "t", ["a = 1"], split_by="a", bounds=(0, 1), tasks=2)


def test_scratch_folder_is_below_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(f"{base}/scratch-") and first != second


def test_scratch_folder_without_a_checkpoint_folder_is_in_the_warehouse(spark, monkeypatch):
    plain = RuntimeConfig.get
    hidden = lambda self, key, *a: None if key == "spark.checkpoint.dir" else plain(self, key, *a)
    monkeypatch.setattr(RuntimeConfig, "get", hidden)
    assert scratch_folder(spark, "x").startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_session_settings():
    options = session_builder("x", "8MB", hash_join_below="2MB")._options
    assert options["spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"] == "2MB"
    assert options["spark.sql.files.maxPartitionBytes"] == "8MB"
    assert options["spark.sql.ansi.enabled"] == "true"


def test_same_rows_from_one_file_or_many(spark, tmp_path):
    parts = spark.read.parquet(f"{SF_DIR}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("k"), "p_name"
    )
    path = str(tmp_path / "many")
    parts.repartition(7).write.options(header=True, sep=";").csv(path)
    assert sorted(rows(read_delimited(spark, path, spec("k", "p_name")))) == sorted(rows(parts))
