"""Exact quantiles against numpy, whatever the distribution."""

import math

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql.classic.dataframe import DataFrame

from isoloir.operators import approximate_thresholds, order_statistics, quantile_thresholds
from isoloir.operators.quantiles import numbers_of, start_of

RNG = np.random.default_rng(7)
N = 4000

CASES = {
    "uniform": RNG.random(N) * 100,
    "two decimals": np.round(RNG.random(N) * 100, 2),
    "one value holds a third": np.where(RNG.random(N) < 0.34, 50.0, RNG.random(N) * 100),
    "heavy tail": np.exp(RNG.normal(0, 12, N)),
    "far outliers": np.concatenate([RNG.random(N - 2), [1e300, -1e300]]),
    "whole double range": np.concatenate([RNG.normal(0, 1, N - 2), [1.7e308, -1.7e308]]),
    "neighbouring doubles": 1.0 + np.arange(N) * np.finfo(float).eps,
    "tiny": RNG.random(N) * 5e-322,
    "one value": np.full(N, 3.25),
    "two values": np.where(RNG.random(N) < 0.5, 1.0, 2.0),
    "signed zeros": np.where(RNG.random(N) < 0.5, 0.0, -0.0),
    "one row": np.array([4.5]),
    "two rows": np.array([1.0, 2.0]),
}


def frame(spark, numbers):
    return spark.createDataFrame([(float(x),) for x in numbers], "x double")


@pytest.mark.parametrize("few_rows", [0, 100])
@pytest.mark.parametrize("name", CASES)
def test_order_statistics_are_exact(spark, name, few_rows):
    numbers = np.sort(CASES[name])
    n = len(numbers)
    ranks = sorted({0, n - 1, n // 2, *((n * k) // 6 for k in range(1, 6))})
    values = numbers_of(frame(spark, numbers), "x")
    got = order_statistics(values, ranks, start_of(values, 256), steps=256, few_rows=few_rows)
    assert got == {r: numbers[r] for r in ranks}


@pytest.mark.parametrize("name", ["uniform", "two decimals", "one value holds a third", "one row"])
def test_thresholds_equal_linear_interpolation(spark, name):
    numbers = CASES[name]
    got = quantile_thresholds(frame(spark, numbers), "x")
    wanted = np.quantile(numbers, [k / 6 for k in range(1, 6)])
    assert got == pytest.approx(tuple(wanted), rel=1e-12)


def test_what_is_no_number_is_left_out(spark):
    df = frame(spark, [1.0, 2.0, 3.0, math.nan, math.inf, -math.inf]).union(
        spark.sql("select cast(null as double) x")
    )
    assert quantile_thresholds(df, "x", classes=2) == (2.0,)
    assert quantile_thresholds(df.where("x is null"), "x") == ()


def test_whole_table_in_small_steps(spark):
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    prices = np.array([r[0] for r in lineitem.select("l_extendedprice").collect()])
    wanted = np.quantile(prices, [k / 6 for k in range(1, 6)])
    got = quantile_thresholds(lineitem, "l_extendedprice", steps=32, few_rows=50)
    assert got == pytest.approx(tuple(wanted), rel=1e-12)


SPREAD = {
    "two hundred decades": 10.0 ** RNG.uniform(-100, 100, 300_000),
    "whole double range": RNG.integers(0, 2**63, 300_000).view(np.float64),
    "one value holds two thirds": np.where(RNG.random(300_000) < 0.67, 50.0, RNG.random(300_000) * 100),
}


@pytest.mark.parametrize("name", SPREAD)
def test_few_passes_whatever_the_distribution(spark, name, monkeypatch):
    numbers = np.sort(SPREAD[name][np.isfinite(SPREAD[name])])
    jobs = []
    for action in ("collect", "first"):
        plain = getattr(DataFrame, action)
        monkeypatch.setattr(DataFrame, action, lambda df, plain=plain: (jobs.append(1), plain(df))[1])
    df = spark.createDataFrame(pa.table({"x": numbers}))
    got = quantile_thresholds(df, "x", few_rows=10_000)
    assert len(jobs) <= 4
    places = [(len(numbers) - 1) * (k / 6) for k in range(1, 6)]
    for cut, place in zip(got, places):
        left, right = numbers[math.floor(place)], numbers[math.ceil(place)]
        assert cut == left + (right - left) * (place - math.floor(place))


def test_a_histogram_that_errs_costs_passes_and_no_exactness(spark):
    numbers = np.sort(RNG.random(5000))
    values = numbers_of(frame(spark, numbers), "x")
    wrong = (5000, float(numbers[0]), float(numbers[-1]), [float(x) for x in np.linspace(0.9, 0.95, 65)])
    got = order_statistics(values, [0, 100, 2500, 4999], wrong, steps=64, few_rows=0)
    assert got == {r: numbers[r] for r in (0, 100, 2500, 4999)}


def test_approximate_thresholds(spark):
    numbers = CASES["uniform"]
    got = approximate_thresholds(frame(spark, numbers), "x", accuracy=1000)
    assert got == pytest.approx(tuple(np.quantile(numbers, [k / 6 for k in range(1, 6)])), abs=0.5)
    assert approximate_thresholds(frame(spark, numbers).where("x < 0"), "x") == ()
