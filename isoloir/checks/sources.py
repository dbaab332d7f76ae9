"""Election sources derived from the customer, supplier and nation tables.

Every row of the tables takes part. All numbers that become text are built
from integers, so that any engine writes the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoloir.functions import col, pad_once
from isoloir.schema import (
    ABSTENTIONS,
    CODE,
    COMMUNE,
    CONSTITUENCY,
    DEPARTMENT,
    RAW_RATE,
    REGISTERED,
    STATION,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (col(c) if isinstance(c, str) else c).cast("string")


def turnout_of(key: str) -> tuple[Column, Column, Column]:
    """Registered, abstentions and rate (``'12,34'``) derived from an id."""
    registered = col(key) % 5000 + 1
    abstentions = (col(key) * 7) % registered
    hundredths = F.expr(f"(({key} * 7) % ({key} % 5000 + 1)) * 10000 div ({key} % 5000 + 1)")
    rate = F.concat(
        F.floor(hundredths / 100).cast("string"),
        F.lit(","),
        F.lpad((hundredths % 100).cast("string"), 2, "0"),
    )
    return registered, abstentions, rate


def export_2017(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an export with packed coordinates; one segment has none."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    registered, abstentions, rate = turnout_of("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(
            F.col("c_mktsegment") != "HOUSEHOLD",
            F.concat(text("c_acctbal"), F.lit(", "), text("c_nationkey")),
        ).alias("Coordonnées"),
        pad_once(text("c_nationkey"), 2).alias(CODE),
        F.col("n_name").alias("Département"),
        F.col("c_mktsegment").alias("Commune"),
        text(registered).alias(REGISTERED),
        text(abstentions).alias(ABSTENTIONS),
        rate.alias(RAW_RATE),
        F.col("c_name").alias("Adresse"),
        F.concat(F.lit("0"), text(F.col("c_custkey") % 9000 + 1000)).alias("Code Postal"),
    )


def export_2022(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_2017(spark, sf_dir).select(
        col("Coordonnées").alias("location"),
        col(CODE),
        col("Département").alias(DEPARTMENT),
        col("Commune").alias(COMMUNE),
        col(REGISTERED),
        col(ABSTENTIONS),
        col(RAW_RATE),
        col("Adresse").alias("lib_du_b_vote"),
    )


def official(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as official results; those in debt lie outside Paris.

    The three codes together name one supplier, so the join grows with the
    table and not with its square.
    """
    registered, abstentions, rate = turnout_of("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.expr("CAST(s_suppkey div 10000 AS STRING)").alias(CODE),
        F.when(F.col("s_acctbal") >= 0, "Paris").otherwise("Ailleurs").alias(DEPARTMENT),
        text("s_nationkey").alias(CONSTITUENCY),
        F.when(F.col("s_acctbal") >= 0, "Paris").otherwise("Ailleurs").alias(COMMUNE),
        text(F.col("s_suppkey") % 10000).alias(STATION),
        text(registered).alias(REGISTERED),
        text(abstentions).alias(ABSTENTIONS),
        rate.alias(RAW_RATE),
    )


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the geo table; one nation has no postal code."""
    station = F.lpad(text(F.col("s_suppkey") % 10000), 4, "0")
    return table(spark, sf_dir, "supplier").select(
        F.concat(
            F.expr("CAST(s_suppkey div 10000 AS STRING)"),
            F.lit("-"),
            F.lpad(text("s_nationkey"), 2, "0"),
        ).alias("circonscription_code"),
        F.when(F.col("s_nationkey") != 3, F.concat(F.lit("750"), F.substring(station, 1, 2))).alias(
            "code_postal"
        ),
        F.substring(station, 3, 2).alias("code"),
        F.when(F.col("s_nationkey") != 4, F.col("s_name")).alias("geo_adresse"),
        text("s_nationkey").alias("longitude"),
        text("s_acctbal").alias("latitude"),
    )
