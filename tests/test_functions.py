"""Column functions on edge values."""

import pytest
from conftest import rows, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from isoloir import functions as fn
from isoloir.schema import NA_TOKENS


def one(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_pad_once(spark):
    df = values(spark, "12", "101", "0101", "01234", None)
    assert one(df, fn.pad_once("x", 4)) == ["012", "0101", "0101", "01234", None]
    assert one(values(spark, "1", "02", ""), fn.pad_once("x", 2)) == ["01", "02", "0"]


def test_last_chars(spark):
    assert one(values(spark, "1", "0001", "", None), fn.last_chars("x", 2)) == ["1", "01", "", None]


def test_decimal_comma(spark):
    df = values(spark, "20,53", "20", "20.5", " 7,5 ", None)
    assert one(spark.sql("select 2.5D x"), fn.decimal_comma("x")) == [2.5]
    assert one(df, fn.decimal_comma("x")) == [20.53, 20.0, 20.5, 7.5, None]
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        one(values(spark, "n.c."), fn.decimal_comma("x"))


def test_split_coordinates(spark):
    df = values(spark, "46.2, 5.22", "1,2,3", None)
    assert one(df, fn.latitude_of("x")) == [46.2, 1.0, None]
    assert one(df, fn.longitude_of("x")) == [5.22, 2.0, None]


def test_split_coordinates_without_comma(spark):
    df = values(spark, "48.8")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT: 48.8"):
        one(df, fn.longitude_of("x"))
    assert one(df, fn.latitude_of("x", "null")) == [48.8]
    assert one(df, fn.longitude_of("x", "null")) == [None]
    assert one(values(spark, "a,b"), fn.latitude_of("x", "null")) == [None]
    with pytest.raises(ValueError):
        fn.latitude_of("x", "ignore")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strictness_does_not_depend_on_the_session(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        strict = {
            fn.decimal_comma: "1,2,3",
            fn.latitude_of: "x,5",
            fn.longitude_of: "46.2",
            fn.int_text: "2A",
            lambda c: fn.strict_cast(c, "int"): "3000000000",
        }
        for f, bad in strict.items():
            with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
                one(values(spark, bad), f("x"))
            assert one(values(spark, None), f("x")) == [None]
        assert one(values(spark, "46.2, 5.22"), fn.longitude_of("x")) == [5.22]
        assert one(values(spark, "01000"), fn.int_text("x")) == ["1000"]
        assert one(values(spark, "x", "1,5"), fn.latitude_of("x", "null")) == [None, 1.0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_label_with_code(spark):
    df = spark.createDataFrame([("Ain", "01"), ("Ain", None), (None, "01")], "l string, c string")
    assert one(df, fn.label_with_code("l", "c")) == ["Ain (01)", None, None]


def test_joined_text(spark):
    df = spark.createDataFrame([("1 rue A", "Bourg"), ("x", None)], "a string, b string")
    assert one(df, fn.joined_text("a", "b")) == ["1 rue A Bourg", None]


def test_null_tokens(spark):
    assert len(NA_TOKENS) == 18
    df = values(spark, "NA", "null", "#N/A", "", "na", " NA", "None", None)
    assert one(df, fn.null_tokens("x")) == [None] * 4 + ["na", " NA", "None", None]
    assert one(values(spark, *NA_TOKENS), fn.null_tokens("x")) == [None] * 18
    assert one(values(spark, "NA", "-"), fn.null_tokens("x", ("-",))) == ["NA", None]


def test_int_text(spark):
    df = values(spark, "01000", "1000.0", "33000", None)
    assert one(df, fn.int_text("x")) == ["1000", "1000", "33000", None]


def test_drop_first_char(spark):
    assert one(values(spark, "\n01", "\n", "", None), fn.drop_first_char("x")) == ["01", "", "", None]


def test_default_null(spark):
    assert one(values(spark, "75001", None), fn.default_null("x", "00")) == ["75001", "00"]


def test_keys(spark):
    results = spark.createDataFrame(
        [("75", "1", "101"), ("75", "02", "0205"), ("75", "3", "12")],
        "`d` string, `c` string, `Code du b.vote` string",
    )
    assert one(results, fn.results_key("d", "c", "Code du b.vote")) == [
        "75-01_0101",
        "75-02_0205",
        "75-03_012",
    ]
    numbers = spark.createDataFrame([(75, 1, 101)], "d int, c int, b int")
    assert one(numbers, fn.results_key("d", "c", "b")) == ["75-01_0101"]
    geo = spark.createDataFrame([("75-01", "75001", "0101"), ("75-01", None, "1")], "c string, p string, s string")
    assert one(geo, fn.geo_key("c", "p", "s")) == ["75-01_0101", None]


def test_quantile_class(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.5,), (9.0,), (float("nan"),), (None,)], "v double")
    assert one(df, fn.quantile_class("v", (1.0, 2.0, 3.0))) == [0, 1, 2, 3, None, None]
    assert one(df, fn.quantile_class("v", (1.0,))) == [0, 1, 1, 1, None, None]
    assert one(df, fn.quantile_class("v", ())) == [None] * 6
    colours = one(df, fn.class_colour(fn.quantile_class("v", (1.0, 2.0))))
    assert colours == ["#FFFF00", "#FFCC00", "#FF9900", "#FF9900", None, None]


def test_linear_size(spark):
    df = spark.createDataFrame([(800,), (1000,), (1200,), (None,)], "v int")
    assert one(df, fn.linear_size("v", 800, 1200)) == [0.0, 25.0, 50.0, None]
    assert one(df, fn.linear_size("v", 800, 1200, (10.0, 20.0))) == [10.0, 15.0, 20.0, None]
    assert one(df, fn.linear_size("v", 5, 5)) == [25.0, 25.0, 25.0, None]
    assert one(df, fn.linear_size("v", None, None)) == [None] * 4


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert rows(df.select(fn.col("a.b"), fn.col("c`d"))) == [(1, 2)]
    assert one(df, F.lit(1) + fn.column("a.b")) == [2]
