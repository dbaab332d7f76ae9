"""One query per operator over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoloir import functions as fn
from isoloir.checks import sources
from isoloir.checks.sources import table, text
from isoloir.operators import (
    apply_scales,
    attach_by_key,
    conform,
    drop_incomplete,
    extent,
    fit_scales,
    quantile_thresholds,
    size_domain,
    where_any_pair,
    where_equals,
    where_member,
    where_prefix,
)
from isoloir.operators.losses import Losses
from isoloir.plans.build import build_stations, read_election
from isoloir.plans.layers import (
    SHOWN_RATE,
    layer_with_scales,
    map_layer,
    national_layer,
    points,
    publish_national_layer,
    published_national_layer,
)
from isoloir.plans.questions import (
    commune_pairs,
    communes_by_department,
    communes_in_chunks,
    departments,
    in_department,
    metropolitan,
    stations_in,
)
from isoloir.schema import ELECTION, FRANCE_2017, FRANCE_2022, NA_TOKENS, SourceSpec
from isoloir.session import scan_block, scratch_folder, stored
from isoloir.sinks import ensure_database, replace_stations, replace_table, save_layer
from isoloir.sources import clean_copy, read_delimited, read_stations, splits_of
from isoloir.versions import publish_stations, read_published

Query = Callable[[SparkSession, str], DataFrame]


LONG, INT, DOUBLE, TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# Cleaning and typing


def complete_rows(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", fn.null_tokens("c_mktsegment", ("HOUSEHOLD",)).alias("c_mktsegment")
    )
    return drop_incomplete(customer, ["c_custkey", "c_mktsegment"])


def null_tokens(spark, sf):
    segment = F.col("c_mktsegment")
    raw = (
        F.when(segment == "HOUSEHOLD", "NA")
        .when(segment == "FURNITURE", "n/a")
        .when(segment == "BUILDING", "na")
        .otherwise(segment)
    )
    return table(spark, sf, "customer").select("c_custkey", fn.null_tokens(raw).alias("segment"))


def ordered_projection(spark, sf):
    customer = table(spark, sf, "customer").drop("c_mktsegment")
    renamed = customer.withColumnsRenamed({"c_name": "name", "c_custkey": "code"})
    return renamed.select("name", "code", "c_acctbal")


def _with_comma(c: str):
    return F.replace(text(c), F.lit("."), F.lit(","))


def decimal_comma(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.decimal_comma(_with_comma("l_extendedprice")).alias("price"),
    )


def _packed(segment_without_comma: str | None = None):
    lone = text("c_acctbal")
    packed = F.concat(lone, F.lit(", "), text("c_nationkey"))
    if segment_without_comma is None:
        return packed
    return F.when(F.col("c_mktsegment") == segment_without_comma, lone).otherwise(packed)


def split_coordinates(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.latitude_of(_packed()).alias("lat"),
        fn.longitude_of(_packed()).alias("lon"),
    )


def split_coordinates_lenient(spark, sf):
    packed = _packed("BUILDING")
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.latitude_of(packed, "null").alias("lat"),
        fn.longitude_of(packed, "null").alias("lon"),
    )


def pad_once(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", fn.pad_once(text("s_suppkey"), 4).alias("padded")
    )


def last_chars(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.last_chars(text("o_orderkey"), 2).alias("suffix")
    )


def first_char_dropped(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", fn.drop_first_char("p_brand").alias("brand_tail")
    )


def int_text(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        fn.int_text(F.concat(F.lit("0"), text("p_size"))).alias("size_text"),
        fn.int_text(text("p_retailprice")).alias("price_text"),
    )


def null_default(spark, sf):
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#12"))
    return table(spark, sf, "part").select("p_partkey", fn.default_null(brand, "00").alias("brand"))


def label_with_code(spark, sf):
    label = F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))
    return table(spark, sf, "customer").select(
        "c_custkey", fn.label_with_code(label, text("c_nationkey")).alias("label")
    )


def address_text(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        fn.joined_text("p_name", "p_brand", fn.int_text(text("p_retailprice"))).alias("address"),
    )


def address_short(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", fn.joined_text("p_name", "p_brand").alias("address")
    )


# Keys and joins


def results_key(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", fn.results_key("s_nationkey", "s_nationkey", "s_suppkey").alias("station_key")
    )


def suffix_key(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        fn.geo_key(
            F.concat(F.lit("75-"), text("s_nationkey")), text("s_nationkey"), text("s_suppkey")
        ).alias("station_key"),
    )


def _lineitem_key():
    return fn.results_key(
        F.expr("l_orderkey div 1000000"),
        F.expr("l_orderkey div 10000 % 100"),
        F.col("l_orderkey") % 10000,
    )


def _orders_key():
    station = F.lpad(text(F.col("o_orderkey") % 10000), 4, "0")
    constituency = F.concat(
        F.expr("CAST(o_orderkey div 1000000 AS STRING)"),
        F.lit("-"),
        F.lpad(F.expr("CAST(o_orderkey div 10000 % 100 AS STRING)"), 2, "0"),
    )
    return fn.geo_key(
        constituency,
        F.concat(F.lit("750"), F.substring(station, 1, 2)),
        F.concat(F.lit("0"), F.substring(station, 3, 2)),
    )


def composite_key_join(spark, sf):
    return attach_by_key(
        table(spark, sf, "orders"),
        table(spark, sf, "lineitem"),
        _orders_key(),
        _lineitem_key(),
        ("o_orderkey", "o_totalprice"),
        ("l_linenumber", "l_quantity", "l_extendedprice"),
    )


def attach_coordinates(spark, sf):
    results = where_equals(table(spark, sf, "lineitem"), "l_returnflag", "R")
    places = where_prefix(table(spark, sf, "orders"), "o_orderpriority", "1")
    return attach_by_key(
        places,
        results,
        _orders_key(),
        _lineitem_key(),
        ("o_orderkey", "o_orderpriority"),
        ("l_linenumber", "l_quantity"),
    )


# Selection


def equality_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return where_equals(orders, "o_orderstatus", "F")


def prefix_filter(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", F.nullif(F.col("p_brand"), F.lit("Brand#12")).alias("brand")
    )
    return where_prefix(part, "brand", "Brand#1")


def metropolitan_default(spark, sf):
    """Codes from 0 to 98, some with letters, and the prefixes that are left out by default."""
    number = F.lpad(text(F.col("c_custkey") % 99), 2, "0")
    code = F.when(F.col("c_nationkey") == 3, F.concat(F.lit("Z"), number)).otherwise(
        F.concat(number, text(F.col("c_nationkey") % 3))
    )
    return metropolitan(table(spark, sf, "customer").select("c_custkey", code.alias("code")), "code")


def exclude_prefixes(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return metropolitan(part, "p_brand", ("Brand#1", "Brand#2"))


def stations_in_communes(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return stations_in(customer, [" BUILDING ", "", "MACHINERY", "BUILDING"], "c_mktsegment")


def stations_in_pairs(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey", text("c_nationkey").alias("nation"), "c_mktsegment"
    )
    pairs = [("3", "BUILDING"), ("3", "MACHINERY"), ("7", "FURNITURE"), ("8", " ")]
    return stations_in(customer, pairs, "c_mktsegment", "nation")


def stations_in_pair_table(spark, sf):
    """Each nation is chosen with one segment of its own, by a table of pairs."""
    segment = F.when(F.col("n_regionkey") < 2, "BUILDING").otherwise("FURNITURE")
    chosen = table(spark, sf, "nation").select(text("n_nationkey").alias("n"), segment.alias("s"))
    customer = table(spark, sf, "customer").select(
        "c_custkey", text("c_nationkey").alias("nation"), "c_mktsegment"
    )
    return stations_in(customer, chosen, "c_mktsegment", "nation")


def stations_in_table(spark, sf):
    """The chosen nations come as a table: a semi-join that ignores repeats."""
    chosen = table(spark, sf, "nation").where("n_regionkey = 2").select("n_name")
    customer = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), text("c_nationkey")).alias("nation")
    )
    return where_member(customer, "nation", chosen.union(chosen))


def stations_in_long_list(spark, sf):
    """Every third customer by name, of a stored table that scans skip through; stray blanks."""
    path = scratch_folder(spark, "bloom")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    replace_stations(customer, path, "c_nationkey", bloom_on=("c_name",))
    customer = spark.read.schema(customer.schema).parquet(path)
    names = [f"\tCustomer#{k:09d}\n " for k in range(0, 60_000, 3)]
    return where_member(customer, "c_name", names)


def stations_in_many_pairs(spark, sf):
    """Ten thousand pairs, all of different first values."""
    orders = table(spark, sf, "orders").select(
        "o_totalprice", text("o_orderkey").alias("key"), text(F.col("o_orderkey") % 7).alias("rest")
    )
    return where_any_pair(orders, "key", "rest", [(f"{k}", f" {k % 5}") for k in range(10_000)])


def in_one_department(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey", text("c_nationkey").alias("nation"), "c_acctbal"
    )
    return in_department(customer, "7", "nation")


# Distinct values and unions


def department_labels(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf, "customer").select("c_nationkey")
    labelled = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        fn.label_with_code("n_name", text("c_nationkey")).alias("label")
    )
    return departments(labelled, "label")


def communes_in_departments(spark, sf):
    part = table(spark, sf, "part")
    lists = communes_by_department(part, ["ECONOMY", "PROMO", " "], "p_type", "p_brand")
    return lists.select("p_type", F.array_join("communes", "|").alias("communes"))


def communes_in_rows(spark, sf):
    """The customers of each chosen nation, forty in a row."""
    customer = table(spark, sf, "customer").select(text("c_nationkey").alias("nation"), "c_name")
    chosen = [str(k) for k in range(0, 25, 2)]
    return communes_in_chunks(customer, chosen, 40, "nation", "c_name")


def commune_pair_rows(spark, sf):
    return commune_pairs(
        table(spark, sf, "part"), ["ECONOMY", "SMALL", "LARGE"], "p_type", "p_brand"
    )


def union_by_name(spark, sf):
    schema = struct(code=LONG, name=TEXT, balance=DOUBLE)
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("code"),
        F.col("c_name").alias("name"),
        text("c_acctbal").alias("balance"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("code"),
    )
    return conform(customer, schema).unionByName(conform(supplier, schema))


# Scales


def _classified(df: DataFrame, c: str, **options) -> DataFrame:
    chosen = fn.quantile_class(c, quantile_thresholds(df, c, **options))
    return df.select(
        "*", chosen.alias("colour_class"), fn.class_colour(chosen).alias("colour")
    )


def quantile_cuts(spark, sf):
    cuts = quantile_thresholds(table(spark, sf, "lineitem"), "l_extendedprice")
    lineitem = table(spark, sf, "lineitem")
    # The values at or below each cut are counted on the whole table.
    counts = lineitem.agg(
        *[F.count_if(F.col("l_extendedprice") <= c).alias(f"upto_{i}") for i, c in enumerate(cuts)]
    )
    return counts.select(
        "*", *[F.lit(round(c, 6)).alias(f"cut_{i}") for i, c in enumerate(cuts)]
    )


def quantile_class(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return _classified(orders, "o_totalprice")


def quantile_class_ties(spark, sf):
    lineitem = table(spark, sf, "lineitem").select("l_discount")
    classified = _classified(lineitem, "l_discount")
    counted = classified.groupBy("l_discount", "colour_class", "colour")
    return counted.agg(F.count("*").alias("stations"))


def quantile_class_many_rounds(spark, sf):
    """The same result with coarse histograms, as many rounds as it takes."""
    lineitem = table(spark, sf, "lineitem").select("l_extendedprice")
    counted = _classified(lineitem, "l_extendedprice", steps=64, few_rows=0).groupBy("colour_class")
    return counted.agg(
        F.count("*").alias("stations"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )


def quantile_class_heavy_tail(spark, sf):
    """Values spread over two hundred decades: powers of two and of a price's last digits."""
    exponent = F.col("l_orderkey") * 7 % 640 - 320
    value = F.pow(F.lit(2.0), exponent.cast("double")) * (F.col("l_partkey") % 64 + 1)
    lineitem = table(spark, sf, "lineitem").select(value.alias("value"))
    counted = _classified(lineitem, "value", steps=100, few_rows=100).groupBy("colour_class")
    return counted.agg(F.count("*").alias("stations"), F.min("value").alias("low"), F.max("value").alias("high"))


def size_bounds(spark, sf):
    return size_domain(table(spark, sf, "orders"), "o_totalprice")


def linear_size(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    low, high = size_domain(orders, "o_totalprice").first()
    return orders.select(
        "o_orderkey", fn.linear_size("o_totalprice", low, high).alias("size")
    )


def layer_extent(spark, sf):
    return extent(table(spark, sf, "customer"), "c_acctbal", "c_nationkey")


def scaled_points(spark, sf):
    """All channels at once over the events."""
    events = table(spark, sf, "events").select("event_id", "value", "user_id")
    scales = fit_scales(events, "value", "user_id", "value", "user_id")
    return apply_scales(events, scales, "value", "user_id")


def scaled_points_not_finite(spark, sf):
    """Rates, sizes and places that are NaN or infinite shape no scale and have no size."""
    kind = F.col("event_id") % 11
    value = F.when(kind == 1, float("nan")).when(kind == 2, float("inf")).when(kind == 3, float("-inf"))
    strange = value.when(kind == 4, F.lit(None)).otherwise(F.col("value"))
    events = table(spark, sf, "events").select("event_id", strange.alias("strange"))
    scales = fit_scales(events, "strange", "strange", "strange", "strange")
    shown = apply_scales(events, scales, "strange", "strange")
    latitude, longitude = scales.centre
    return shown.select(
        "event_id",
        "colour_class",
        "size",
        F.lit(latitude).alias("latitude"),
        F.lit(longitude).alias("longitude"),
    )


# Whole questions


def _stations(spark, sf, year):
    export, spec = {
        2017: (sources.export_2017, FRANCE_2017),
        2022: (sources.export_2022, FRANCE_2022),
    }[year]
    return build_stations(
        export(spark, sf), sources.official(spark, sf), sources.geo(spark, sf), spec
    )


# The accented names are not given to every engine alike; plain ones are.
PLAIN = {
    "Code du département": "code",
    "Libellé du département": "department",
    "Libellé de la commune": "commune",
    "Inscrits": "registered",
    "Abstentions": "abstentions",
    "Pourcentage_Abstentions": "rate",
    SHOWN_RATE: "rate",
    "dénomination complète": "label",
    "Adresse complète": "address",
}


def _stored(spark, sf, *years):
    """The elections' stations, built, written and read back as one table."""
    path = scratch_folder(spark, "stations")
    for year in years:
        replace_stations(_stations(spark, sf, year), path)
    return path


def build_2017(spark, sf):
    return _stations(spark, sf, 2017).withColumnsRenamed(PLAIN)


def build_2022(spark, sf):
    return _stations(spark, sf, 2022).withColumnsRenamed(PLAIN)


def _from_files(spark, sf, spec, export):
    """The election's sources written as files, an address with line breaks in between."""
    place = scratch_folder(spark, "files")
    export.write.options(header=True, sep=";", lineSep="\r\n").csv(f"{place}/export")
    sources.official(spark, sf).write.options(header=True, sep=";").csv(f"{place}/official")
    geo = sources.geo(spark, sf)
    note = F.concat(F.lit('4 "place"\ndu Louvre, '), F.coalesce("geo_adresse", F.lit("")))
    geo.select("circonscription_code", note.alias("note"), *geo.columns[1:]).write.options(
        header=True, compression="gzip", escape='"', quoteAll=True
    ).csv(f"{place}/geo")
    built = read_election(spark, spec, f"{place}/export", f"{place}/official", f"{place}/geo")
    return built.withColumnsRenamed(PLAIN)


def built_from_files_2017(spark, sf):
    return _from_files(spark, sf, FRANCE_2017, sources.export_2017(spark, sf))


def built_from_files_2022(spark, sf):
    return _from_files(spark, sf, FRANCE_2022, sources.export_2022(spark, sf))


def flagship(spark, sf):
    """Build and store 2017, choose communes, colour and size what is chosen."""
    stations = read_stations(spark, _stored(spark, sf, 2017), 2017)
    chosen = stations_in(stations, ["BUILDING", "MACHINERY", "Paris", ""])
    return map_layer(chosen).withColumnsRenamed(PLAIN)


def department_layer(spark, sf):
    stations = read_stations(spark, _stored(spark, sf, 2017), 2017)
    return map_layer(in_department(stations, "07")).withColumnsRenamed(PLAIN)


def metropolitan_layer(spark, sf):
    """One of two stored elections; nations coded 1x and 2x lie outside."""
    stations = read_stations(spark, _stored(spark, sf, 2017, 2022), 2022)
    return map_layer(metropolitan(stations, outside=("1", "2"))).withColumnsRenamed(PLAIN)


def tooltip_points(spark, sf):
    return points(_stations(spark, sf, 2022)).withColumnsRenamed(PLAIN)


# Sources and sinks


def typed_roundtrip(spark, sf):
    path = scratch_folder(spark, "typed")
    orders = conform(
        table(spark, sf, "orders").withColumn(ELECTION, F.year("o_orderdate")),
        struct(o_orderkey=LONG, o_custkey=TEXT, o_totalprice=DOUBLE, election=INT),
    )
    replace_stations(orders, path)
    return spark.read.parquet(path)


def clustered_roundtrip(spark, sf):
    path = scratch_folder(spark, "clustered")
    part = table(spark, sf, "part").select(
        "p_partkey", "p_brand", "p_type", F.length("p_type").alias(ELECTION)
    )
    replace_stations(part, path, cluster_by=("p_type", "p_brand"))
    return spark.read.parquet(path)


def replace_one_election(spark, sf):
    """A second write replaces one status and leaves the others alone."""
    path = scratch_folder(spark, "replaced")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    replace_stations(orders, path, partition="o_orderstatus")
    changed = where_equals(orders, "o_orderstatus", "F").withColumn(
        "o_totalprice", F.lit(0).cast("double")
    )
    replace_stations(changed, path, partition="o_orderstatus")
    return spark.read.parquet(path).select(
        "o_orderkey", "o_totalprice", text("o_orderstatus").alias("o_orderstatus")
    )


def replace_with_nothing(spark, sf):
    """Two statuses are replaced in one call; one of them has no rows any more."""
    path = scratch_folder(spark, "emptied")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    replace_stations(orders, path, partition="o_orderstatus")
    changed = where_equals(orders, "o_orderstatus", "P").withColumn(
        "o_totalprice", F.lit(0).cast("double")
    )
    replace_stations(changed, path, partition="o_orderstatus", elections=["F", "P"])
    return spark.read.parquet(path).select(
        "o_orderkey", "o_totalprice", text("o_orderstatus").alias("o_orderstatus")
    )


def table_in_database(spark, sf):
    """A nation's balances are replaced, another's rows taken away, in a catalogue table."""
    # Dropping a database removes its own folder, so the rows lie in another.
    place = scratch_folder(spark, "supplier")
    database = "isoloir_checks_" + place.rsplit("-", 1)[1]
    ensure_database(spark, database, scratch_folder(spark, "database"))
    ensure_database(spark, database.upper())
    name = f"{database}.supplier"
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    replace_table(supplier, name, "s_nationkey", place)
    changed = where_equals(supplier, "s_nationkey", 5).withColumn("s_acctbal", F.lit(0).cast("double"))
    replace_table(changed, name, "s_nationkey")
    replace_table(changed, name, "s_nationkey", elections=[6])
    # The rows are files of their own; the names go with the check.
    rows = spark.table(name).schema
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(rows).parquet(place)


def saved_layer(spark, sf):
    """The layer as stored, with its legend and view, which are not fitted again."""
    path = scratch_folder(spark, "layer")
    stations = read_stations(spark, _stored(spark, sf, 2017), 2017)
    layer, scales = layer_with_scales(metropolitan(stations, outside=("2",)))
    save_layer(layer, path, scales)
    layer, scales = national_layer(spark, saved=path)
    view = {
        **{f"threshold_{k}": round(t, 6) for k, t in enumerate(scales.thresholds)},
        "size_low": scales.size_low,
        "size_high": scales.size_high,
        "centre_latitude": scales.centre[0],
        "centre_longitude": scales.centre[1],
    }
    shown = [F.lit(value).alias(name) for name, value in view.items()]
    return layer.withColumnsRenamed(PLAIN).select("*", *shown)


CUSTOMER = struct(c_custkey=LONG, c_name=TEXT, c_nationkey=INT, c_acctbal=DOUBLE)


def _customer_text(spark, sf):
    return table(spark, sf, "customer").select(
        "c_mktsegment",
        "c_name",
        text("c_custkey").alias("c_custkey"),
        text("c_nationkey").alias("c_nationkey"),
        _with_comma("c_acctbal").alias("c_acctbal"),
    )


def _typed_customer(rows):
    return conform(rows.withColumn("c_acctbal", fn.decimal_comma("c_acctbal")), CUSTOMER)


def delimited_roundtrip(spark, sf):
    """CRLF records, ';', decimal commas; columns found by name, one not read."""
    path = scratch_folder(spark, "delimited")
    _customer_text(spark, sf).write.options(header=True, sep=";", lineSep="\r\n").csv(path)
    spec = SourceSpec(columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal"))
    return _typed_customer(read_delimited(spark, path, spec))


def cr_split_records(spark, sf):
    """CRLF records split at CR: the line feed left in front is taken off."""
    path = scratch_folder(spark, "cr")
    parts = table(spark, sf, "part").select(text("p_partkey").alias("code"), "p_name")
    parts.write.options(header=True, sep=";", lineSep="\r\n").csv(path)
    spec = SourceSpec(columns=("code", "p_name"), line_sep="\r")
    rows = drop_incomplete(read_delimited(spark, path, spec))
    return rows.select(fn.drop_first_char("code").cast("bigint").alias("p_partkey"), "p_name")


def compressed_roundtrip(spark, sf):
    path = scratch_folder(spark, "compressed")
    _customer_text(spark, sf).write.options(header=True, compression="gzip", escape='"').csv(path)
    spec = SourceSpec(
        separator=",",
        columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
        partitions=8,
    )
    return _typed_customer(read_delimited(spark, path, spec))


def latin1_roundtrip(spark, sf):
    path = scratch_folder(spark, "latin1")
    parts = table(spark, sf, "part").select(
        text("p_partkey").alias("numéro"), F.concat(F.lit("pièce "), "p_name").alias("libellé")
    )
    parts.write.options(header=True, sep=";", encoding="ISO-8859-1").csv(path)
    spec = SourceSpec(columns=("libellé", "numéro"), encoding="ISO-8859-1")
    rows = read_delimited(spark, path, spec)
    return rows.select(
        fn.col("numéro").cast("bigint").alias("p_partkey"), fn.col("libellé").alias("name")
    )


def ragged_rows(spark, sf):
    """Rows of one return flag carry more fields than the header."""
    path = scratch_folder(spark, "ragged")
    extra = F.when(F.col("l_returnflag") == "R", ";x;y").otherwise("")
    line = F.concat(
        F.concat_ws(";", text("l_orderkey"), text("l_linenumber"), "l_returnflag"), extra
    )
    lines = table(spark, sf, "lineitem").select(line.alias("order;line;flag"))
    lines.write.options(header=True, sep="|").csv(path)
    spec = SourceSpec(columns=("order", "line", "flag"))
    return conform(read_delimited(spark, path, spec), struct(order=LONG, line=INT, flag=TEXT))


def copied_without_gaps(spark, sf):
    """Rows without a segment are gone from the copy."""
    raw, copy = scratch_folder(spark, "raw"), scratch_folder(spark, "copy")
    segment = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "NA").otherwise(F.col("c_mktsegment"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", segment.alias("segment"))
    customer.write.options(header=True, sep=";").csv(raw)
    clean_copy(spark, raw, SourceSpec(na_tokens=NA_TOKENS), copy)
    rows = read_delimited(spark, copy, SourceSpec(separator=","))
    return conform(rows, struct(c_custkey=LONG, c_name=TEXT, segment=TEXT))


def geo_split_scan(spark, sf):
    """The geo table in files of quoted fields with line breaks, cut into records by many tasks."""
    path = scratch_folder(spark, "geo")
    supplier = table(spark, sf, "supplier")
    breaks = F.array_join(F.array_repeat(F.lit('rue "A",\n'), (F.col("s_suppkey") % 9).cast("int")), "")
    places = supplier.select(
        text("s_suppkey").alias("code"),
        F.concat(breaks, F.col("s_name")).alias("geo_adresse"),
        text("s_nationkey").alias("longitude"),
    )
    places.write.options(header=True, escape='"', quoteAll=True).csv(path)
    spec = SourceSpec(separator=",", columns=("geo_adresse", "code"), multiline=True, split_above=0)
    rows = read_delimited(spark, path, spec)
    lines = F.size(F.split("geo_adresse", "\n"))
    return rows.select(
        F.col("code").cast("bigint").alias("s_suppkey"),
        "geo_adresse",
        lines.cast("bigint").alias("n_lines"),
    )


def headers_of_two_orders(spark, sf):
    """One folder, two orders of columns, one of them with a column more."""
    path = scratch_folder(spark, "orders")
    customer = _customer_text(spark, sf)
    even = where_equals(customer.withColumn("odd", F.col("c_custkey").cast("bigint") % 2), "odd", 0)
    odd = where_equals(customer.withColumn("odd", F.col("c_custkey").cast("bigint") % 2), "odd", 1)
    even = even.select("c_acctbal", "c_name", "c_nationkey", "c_custkey")
    odd = odd.select("c_custkey", "c_mktsegment", "c_nationkey", "c_name", "c_acctbal")
    for part in (even, odd):
        part.write.mode("append").options(header=True, sep=";").csv(path)
    spec = SourceSpec(columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal"))
    return _typed_customer(read_delimited(spark, path, spec))


def losses_of_build(spark, sf):
    """What a build from files leaves out, counted while its stations are stored."""
    place, losses = scratch_folder(spark, "files"), Losses()
    sources.export_2017(spark, sf).write.options(header=True, sep=";").csv(f"{place}/export")
    official = sources.official(spark, sf)
    fields = F.concat_ws(";", *[F.coalesce(fn.col(n), F.lit("")) for n in official.columns])
    # Every seventh station has two fields more than the header.
    more = F.when(fn.col("Code du b.vote").cast("int") % 7 == 0, ";x;y").otherwise("")
    lines = official.select(F.concat(fields, more).alias(";".join(official.columns)))
    lines.write.options(header=True, sep="|").csv(f"{place}/official")
    sources.geo(spark, sf).write.options(header=True).csv(f"{place}/geo")
    paths = [f"{place}/{name}" for name in ("export", "official", "geo")]
    built = read_election(spark, FRANCE_2017, *paths, losses=losses)
    kept = stored(built, "built").count()
    counts = {**losses.counts, "stations": kept}
    row = [F.lit(n).cast("bigint").alias(name) for name, n in sorted(counts.items())]
    return spark.range(1).select(*row)


def mixed_encodings(spark, sf):
    """One folder whose files are in two encodings; every third part has no accent."""
    path = scratch_folder(spark, "mixed")
    accent = F.when(F.col("p_partkey") % 3 == 0, "piece ").otherwise("pièce ")
    parts = table(spark, sf, "part").select(
        text("p_partkey").alias("numéro"), F.concat(accent, "p_name").alias("libellé"), "p_size"
    )
    for encoding, odd in (("UTF-8", 0), ("ISO-8859-1", 1)):
        some = where_equals(parts.withColumn("odd", F.col("p_size") % 2), "odd", odd).drop("odd", "p_size")
        some.write.mode("append").options(header=True, sep=";", encoding=encoding).csv(path)
    spec = SourceSpec(columns=("libellé", "numéro"), otherwise="ISO-8859-1")
    rows = read_delimited(spark, path, spec)
    return rows.select(
        fn.col("numéro").cast("bigint").alias("p_partkey"), fn.col("libellé").alias("name")
    )


def scan_splits(spark, sf):
    """The byte ranges of a scan: none beyond the limit, and all rows of every file in them."""
    path = scratch_folder(spark, "splits")
    orders = table(spark, sf, "orders").select(text("o_orderkey").alias("key"), "o_orderpriority")
    orders.write.options(header=True, sep=";", maxRecordsPerFile=4_000).csv(path)
    with scan_block(spark, "32KB"):
        found = stored(splits_of(read_delimited(spark, path, SourceSpec(columns=("key",)))), "found")
    starts = Window.partitionBy("split_file").orderBy("split_start")
    before = F.lag(F.col("split_start") + F.col("split_length"), 1, 0).over(starts)
    gaps = found.withColumn("follows", before == F.col("split_start"))
    return gaps.agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.col("split_length") <= 32 << 10).alias("within"),
        F.bool_and("follows").alias("whole"),
        (F.count("*") > F.count_distinct("split_file")).alias("split"),
    )


def replaced_together(spark, sf):
    """Two statuses change in one version, one of them to nothing; both versions are read."""
    path = scratch_folder(spark, "versions")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    publish_stations(orders, path, partition="o_orderstatus")
    changed = where_equals(orders, "o_orderstatus", "F").withColumn("o_totalprice", -F.col("o_totalprice"))
    publish_stations(changed, path, ["F", "P"], "o_orderstatus", cluster_by=("o_orderkey",))
    both = [read_published(spark, path, orders.schema, version=v).withColumn("version", F.lit(v)) for v in (1, 2)]
    return both[0].unionByName(both[1])


def layer_follows_stations(spark, sf):
    """A published layer is made anew once a commune is gone from its stations."""
    path = scratch_folder(spark, "published")
    built = _stations(spark, sf, 2017)
    publish_stations(built, path)
    publish_national_layer(spark, path, outside=("2",))
    publish_stations(built.where(fn.col("Libellé de la commune") != "BUILDING"), path)
    layer, scales = published_national_layer(spark, path, outside=("2",))
    shown = [F.lit(round(t, 6)).alias(f"threshold_{k}") for k, t in enumerate(scales.thresholds)]
    return layer.withColumnsRenamed(PLAIN).select("*", *shown)


QUERIES: dict[str, Query] = {
    "flagship": flagship,
    "build_2017": build_2017,
    "build_2022": build_2022,
    "built_from_files_2017": built_from_files_2017,
    "built_from_files_2022": built_from_files_2022,
    "metropolitan_layer": metropolitan_layer,
    "department_layer": department_layer,
    "tooltip_points": tooltip_points,
    "complete_rows": complete_rows,
    "null_tokens": null_tokens,
    "ordered_projection": ordered_projection,
    "decimal_comma": decimal_comma,
    "split_coordinates": split_coordinates,
    "split_coordinates_lenient": split_coordinates_lenient,
    "pad_once": pad_once,
    "last_chars": last_chars,
    "first_char_dropped": first_char_dropped,
    "int_text": int_text,
    "null_default": null_default,
    "label_with_code": label_with_code,
    "address_text": address_text,
    "address_short": address_short,
    "results_key": results_key,
    "suffix_key": suffix_key,
    "composite_key_join": composite_key_join,
    "attach_coordinates": attach_coordinates,
    "equality_filter": equality_filter,
    "prefix_filter": prefix_filter,
    "exclude_prefixes": exclude_prefixes,
    "metropolitan_default": metropolitan_default,
    "stations_in": stations_in_communes,
    "stations_in_pairs": stations_in_pairs,
    "stations_in_table": stations_in_table,
    "stations_in_pair_table": stations_in_pair_table,
    "stations_in_long_list": stations_in_long_list,
    "stations_in_many_pairs": stations_in_many_pairs,
    "in_department": in_one_department,
    "departments": department_labels,
    "communes_by_department": communes_in_departments,
    "commune_pairs": commune_pair_rows,
    "communes_in_chunks": communes_in_rows,
    "union_by_name": union_by_name,
    "quantile_cuts": quantile_cuts,
    "quantile_class": quantile_class,
    "quantile_class_ties": quantile_class_ties,
    "quantile_class_many_rounds": quantile_class_many_rounds,
    "quantile_class_heavy_tail": quantile_class_heavy_tail,
    "size_domain": size_bounds,
    "linear_size": linear_size,
    "extent": layer_extent,
    "scaled_points": scaled_points,
    "scaled_points_not_finite": scaled_points_not_finite,
    "typed_roundtrip": typed_roundtrip,
    "clustered_roundtrip": clustered_roundtrip,
    "replace_one_election": replace_one_election,
    "replace_with_nothing": replace_with_nothing,
    "table_in_database": table_in_database,
    "saved_layer": saved_layer,
    "delimited_roundtrip": delimited_roundtrip,
    "cr_split_records": cr_split_records,
    "compressed_roundtrip": compressed_roundtrip,
    "latin1_roundtrip": latin1_roundtrip,
    "ragged_rows": ragged_rows,
    "clean_copy": copied_without_gaps,
    "geo_split_scan": geo_split_scan,
    "headers_of_two_orders": headers_of_two_orders,
    "losses_of_build": losses_of_build,
    "mixed_encodings": mixed_encodings,
    "scan_splits": scan_splits,
    "replaced_together": replaced_together,
    "layer_follows_stations": layer_follows_stations,
}
