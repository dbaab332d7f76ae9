"""The answers of ``queries`` in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

# Shared pieces.

TURNOUT = """
    {k} % 5000 + 1 AS registered,
    ({k} * 7) % ({k} % 5000 + 1) AS abstentions,
    CAST(
      CAST((({k} * 7) % ({k} % 5000 + 1)) * 10000 // ({k} % 5000 + 1) // 100 AS VARCHAR) || '.'
      || lpad(CAST((({k} * 7) % ({k} % 5000 + 1)) * 10000 // ({k} % 5000 + 1) % 100 AS VARCHAR),
              2, '0')
      AS DOUBLE) AS rate
"""

# The key is padded by one zero at most on the results' side and cut to two and
# two characters on the places' side, so short station numbers find no place.
REBUILT = f"""
  SELECT code, 'Paris' AS department, 'Paris' AS commune, registered, abstentions, rate,
         latitude, longitude, 'Paris (' || code || ')' AS label, address
  FROM (
    SELECT CAST(s_suppkey // 10000 AS VARCHAR) AS code, {TURNOUT.format(k='s_suppkey')},
           CAST(s_suppkey // 10000 AS VARCHAR) || '-'
           || CASE WHEN s_nationkey < 10 THEN '0' ELSE '' END || CAST(s_nationkey AS VARCHAR) || '_'
           || CASE WHEN length(CAST(s_suppkey % 10000 AS VARCHAR)) < 4 THEN '0' ELSE '' END
           || CAST(s_suppkey % 10000 AS VARCHAR) AS station_key
    FROM supplier WHERE s_acctbal >= 0) AS results
  JOIN (
    SELECT s_acctbal AS latitude, CAST(s_nationkey AS DOUBLE) AS longitude,
           CASE WHEN s_nationkey <> 4 THEN s_name END AS address,
           CAST(s_suppkey // 10000 AS VARCHAR) || '-'
           || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '_'
           || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') AS station_key
    FROM supplier WHERE s_nationkey <> 3) AS places USING (station_key)
"""

EXPORTED = f"""
  SELECT CASE WHEN c_nationkey < 10 THEN '0' ELSE '' END || CAST(c_nationkey AS VARCHAR) AS code,
         n_name AS department, c_mktsegment AS commune,
         {TURNOUT.format(k='c_custkey')},
         c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude,
         n_name || ' (' || CASE WHEN c_nationkey < 10 THEN '0' ELSE '' END
                || CAST(c_nationkey AS VARCHAR) || ')' AS label,
         c_name || ' ' || c_mktsegment{{postal}} AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_mktsegment <> 'HOUSEHOLD'
"""

STATIONS_2017 = (
    EXPORTED.format(postal=" || ' ' || CAST(c_custkey % 9000 + 1000 AS VARCHAR)")
    + " UNION ALL "
    + REBUILT
)
STATIONS_2022 = EXPORTED.format(postal="") + " UNION ALL " + REBUILT

BUILT = """
  SELECT code, department, commune, CAST(registered AS INTEGER) AS registered,
         CAST(abstentions AS INTEGER) AS abstentions, rate, latitude, longitude, label, address,
         CAST({year} AS INTEGER) AS election
  FROM ({stations})
"""

SIXTHS = "[1.0/6, 2.0/6, 3.0/6, 4.0/6, 5.0/6]"
CLASS = (
    "(" + " + ".join(f"CAST({{value}} >= {{cuts}}[{i}] AS INTEGER)" for i in range(1, 6)) + ")"
)
COLOUR = f"['#FFFF00', '#FFCC00', '#FF9900', '#FF6600', '#FF3300', '#FF0000'][{CLASS} + 1]"

LAYER = f"""
  WITH shown AS (SELECT * FROM ({{stations}}) WHERE {{where}}),
  scales AS (
    SELECT quantile_cont(rate, {SIXTHS}) AS cuts, min(registered) AS mn, max(registered) AS mx
    FROM shown)
  SELECT latitude, longitude, rate, CAST(abstentions AS INTEGER) AS abstentions,
         CAST(registered AS INTEGER) AS registered, department, commune, address,
         {CLASS.format(cuts='cuts', value='rate')} AS colour_class,
         {COLOUR.format(cuts='cuts', value='rate')} AS colour,
         {COLOUR.format(cuts='cuts', value='rate')} AS stroke_colour,
         CASE WHEN mx = mn THEN 25.0 ELSE (registered - mn) / (mx - mn) * 50 END AS size
  FROM shown, scales
"""

# The same station key from either side, as text.
LINEITEM_KEY = """
  CAST(l_orderkey // 1000000 AS VARCHAR) || '-'
  || CASE WHEN l_orderkey // 10000 % 100 < 10 THEN '0' ELSE '' END
  || CAST(l_orderkey // 10000 % 100 AS VARCHAR) || '_'
  || CASE WHEN l_orderkey % 10000 < 1000 THEN '0' ELSE '' END
  || CAST(l_orderkey % 10000 AS VARCHAR)
"""
ORDERS_KEY = """
  CAST(o_orderkey // 1000000 AS VARCHAR) || '-'
  || lpad(CAST(o_orderkey // 10000 % 100 AS VARCHAR), 2, '0') || '_'
  || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')
"""

PACKED = "CAST(c_acctbal AS VARCHAR) || ', ' || CAST(c_nationkey AS VARCHAR)"
CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"

ORACLE: dict[str, str] = {
    "flagship": LAYER.format(
        stations=STATIONS_2017, where="commune IN ('BUILDING', 'MACHINERY', 'Paris')"
    ),
    "build_2017": BUILT.format(stations=STATIONS_2017, year=2017),
    "build_2022": BUILT.format(stations=STATIONS_2022, year=2022),
    "built_from_files_2017": BUILT.format(stations=STATIONS_2017, year=2017),
    "built_from_files_2022": BUILT.format(stations=STATIONS_2022, year=2022),
    "metropolitan_layer": LAYER.format(
        stations=STATIONS_2022, where="NOT regexp_matches(code, '^(1|2)')"
    ),
    "department_layer": LAYER.format(stations=STATIONS_2017, where="code = '07'"),
    "tooltip_points": f"""
        SELECT latitude, longitude, rate, CAST(abstentions AS INTEGER) AS abstentions,
               CAST(registered AS INTEGER) AS registered, department, commune, address
        FROM ({STATIONS_2022})""",
    "complete_rows": """
        SELECT c_custkey, c_name, c_mktsegment FROM customer
        WHERE nullif(c_mktsegment, 'HOUSEHOLD') IS NOT NULL""",
    "null_tokens": """
        SELECT c_custkey,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL WHEN 'FURNITURE' THEN NULL
                    WHEN 'BUILDING' THEN 'na' ELSE c_mktsegment END AS segment
        FROM customer""",
    "ordered_projection": "SELECT c_name AS name, c_custkey AS code, c_acctbal FROM customer",
    "decimal_comma": """
        SELECT l_orderkey, l_linenumber,
               CAST(replace(replace(CAST(l_extendedprice AS VARCHAR), '.', ','), ',', '.')
                    AS DOUBLE) AS price
        FROM lineitem""",
    "split_coordinates": f"""
        SELECT c_custkey, CAST(string_split({PACKED}, ',')[1] AS DOUBLE) AS lat,
               CAST(string_split({PACKED}, ',')[2] AS DOUBLE) AS lon
        FROM customer""",
    "split_coordinates_lenient": """
        SELECT c_custkey, c_acctbal AS lat,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS DOUBLE) END AS lon
        FROM customer""",
    "pad_once": """
        SELECT s_suppkey,
               CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 4 THEN '0' ELSE '' END
                 || CAST(s_suppkey AS VARCHAR) AS padded
        FROM supplier""",
    "last_chars": "SELECT o_orderkey, right(CAST(o_orderkey AS VARCHAR), 2) AS suffix FROM orders",
    "first_char_dropped": "SELECT p_partkey, substr(p_brand, 2) AS brand_tail FROM part",
    "int_text": """
        SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text,
               CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR) AS price_text
        FROM part""",
    "null_default": """
        SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#12'), '00') AS brand FROM part""",
    "label_with_code": """
        SELECT c_custkey,
               nullif(c_mktsegment, 'HOUSEHOLD') || ' (' || CAST(c_nationkey AS VARCHAR) || ')'
                 AS label
        FROM customer""",
    "address_text": """
        SELECT p_partkey, p_name || ' ' || p_brand || ' '
               || CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR) AS address
        FROM part""",
    "address_short": "SELECT p_partkey, p_name || ' ' || p_brand AS address FROM part",
    "results_key": """
        SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) || '-'
               || CASE WHEN length(CAST(s_nationkey AS VARCHAR)) < 2 THEN '0' ELSE '' END
               || CAST(s_nationkey AS VARCHAR) || '_'
               || CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 4 THEN '0' ELSE '' END
               || CAST(s_suppkey AS VARCHAR) AS station_key
        FROM supplier""",
    "suffix_key": """
        SELECT s_suppkey, '75-' || CAST(s_nationkey AS VARCHAR) || '_'
               || right(CAST(s_nationkey AS VARCHAR), 2) || right(CAST(s_suppkey AS VARCHAR), 2)
               AS station_key
        FROM supplier""",
    "composite_key_join": f"""
        SELECT o_orderkey, o_totalprice, l_linenumber, l_quantity, l_extendedprice
        FROM (SELECT *, {ORDERS_KEY} AS k FROM orders)
        JOIN (SELECT *, {LINEITEM_KEY} AS k FROM lineitem) USING (k)""",
    "attach_coordinates": f"""
        SELECT o_orderkey, o_orderpriority, l_linenumber, l_quantity
        FROM (SELECT *, {ORDERS_KEY} AS k FROM orders WHERE o_orderpriority LIKE '1%')
        JOIN (SELECT *, {LINEITEM_KEY} AS k FROM lineitem WHERE l_returnflag = 'R') USING (k)""",
    "equality_filter": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "prefix_filter": """
        SELECT p_partkey, nullif(p_brand, 'Brand#12') AS brand FROM part
        WHERE coalesce(nullif(p_brand, 'Brand#12'), '00') LIKE 'Brand#1%'""",
    "exclude_prefixes": """
        SELECT p_partkey, p_brand FROM part
        WHERE NOT regexp_matches(p_brand, '^(Brand#1|Brand#2)')""",
    "stations_in": """
        SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "stations_in_pairs": """
        SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment FROM customer
        WHERE (c_nationkey, c_mktsegment)
              IN ((3, 'BUILDING'), (3, 'MACHINERY'), (7, 'FURNITURE'))""",
    "stations_in_table": """
        SELECT c_custkey, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS nation FROM customer
        WHERE 'NATION_' || CAST(c_nationkey AS VARCHAR)
              IN (SELECT n_name FROM nation WHERE n_regionkey = 2)""",
    "stations_in_pair_table": """
        SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_mktsegment = CASE WHEN n_regionkey < 2 THEN 'BUILDING' ELSE 'FURNITURE' END""",
    "stations_in_long_list": """
        SELECT c_custkey, c_name, c_nationkey FROM customer
        WHERE CAST(substr(c_name, 10) AS BIGINT) % 3 = 0
              AND CAST(substr(c_name, 10) AS BIGINT) < 60000""",
    "stations_in_many_pairs": """
        SELECT o_totalprice, CAST(o_orderkey AS VARCHAR) AS key,
               CAST(o_orderkey % 7 AS VARCHAR) AS rest
        FROM orders WHERE o_orderkey < 10000 AND o_orderkey % 7 = o_orderkey % 5""",
    "metropolitan_default": """
        SELECT c_custkey, code FROM (
            SELECT c_custkey, CASE
                WHEN c_nationkey = 3 THEN 'Z' || lpad(CAST(c_custkey % 99 AS VARCHAR), 2, '0')
                ELSE lpad(CAST(c_custkey % 99 AS VARCHAR), 2, '0')
                     || CAST(c_nationkey % 3 AS VARCHAR) END AS code
            FROM customer)
        WHERE NOT regexp_matches(code, '^(Z|97|98)')""",
    "in_department": """
        SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, c_acctbal FROM customer
        WHERE c_nationkey = 7""",
    "departments": """
        SELECT DISTINCT n_name || ' (' || CAST(c_nationkey AS VARCHAR) || ')' AS label
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "communes_by_department": """
        SELECT p_type, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS communes
        FROM part WHERE p_type IN ('ECONOMY', 'PROMO') GROUP BY p_type""",
    "commune_pairs": """
        SELECT DISTINCT p_type, p_brand FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'LARGE')""",
    "union_by_name": """
        SELECT c_custkey AS code, c_name AS name, c_acctbal AS balance FROM customer
        UNION ALL BY NAME
        SELECT s_acctbal AS balance, s_name AS name, s_suppkey AS code FROM supplier""",
    "quantile_cuts": f"""
        WITH s AS (SELECT quantile_cont(l_extendedprice, {SIXTHS}) AS cuts FROM lineitem)
        SELECT """
    + ", ".join(
        f"count(*) FILTER (WHERE l_extendedprice <= cuts[{i + 1}]) AS upto_{i}, "
        f"round(any_value(cuts[{i + 1}]), 6) AS cut_{i}"
        for i in range(5)
    )
    + " FROM lineitem, s",
    "quantile_class": f"""
        WITH s AS (SELECT quantile_cont(o_totalprice, {SIXTHS}) AS cuts FROM orders)
        SELECT o_orderkey, o_totalprice,
               {CLASS.format(cuts='cuts', value='o_totalprice')} AS colour_class,
               {COLOUR.format(cuts='cuts', value='o_totalprice')} AS colour
        FROM orders, s""",
    "quantile_class_ties": f"""
        WITH s AS (SELECT quantile_cont(l_discount, {SIXTHS}) AS cuts FROM lineitem),
        c AS (SELECT l_discount, {CLASS.format(cuts='cuts', value='l_discount')} AS colour_class,
                     {COLOUR.format(cuts='cuts', value='l_discount')} AS colour
              FROM lineitem, s)
        SELECT l_discount, colour_class, colour, count(*) AS stations FROM c GROUP BY ALL""",
    "quantile_class_many_rounds": f"""
        WITH s AS (SELECT quantile_cont(l_extendedprice, {SIXTHS}) AS cuts FROM lineitem),
        c AS (SELECT l_extendedprice,
                     {CLASS.format(cuts='cuts', value='l_extendedprice')} AS colour_class
              FROM lineitem, s)
        SELECT colour_class, count(*) AS stations, min(l_extendedprice) AS low,
               max(l_extendedprice) AS high
        FROM c GROUP BY colour_class""",
    "quantile_class_heavy_tail": f"""
        WITH v AS (
            SELECT CAST(2 AS DOUBLE) ** CAST(l_orderkey * 7 % 640 - 320 AS DOUBLE)
                   * (l_partkey % 64 + 1) AS value FROM lineitem),
        s AS (SELECT quantile_cont(value, {SIXTHS}) AS cuts FROM v)
        SELECT {CLASS.format(cuts='cuts', value='value')} AS colour_class, count(*) AS stations,
               min(value) AS low, max(value) AS high
        FROM v, s GROUP BY 1""",
    "size_domain": """
        SELECT min(o_totalprice) AS size_min, max(o_totalprice) AS size_max FROM orders""",
    "linear_size": """
        WITH d AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders)
        SELECT o_orderkey,
               CASE WHEN mx = mn THEN 25.0 ELSE (o_totalprice - mn) / (mx - mn) * 50 END AS size
        FROM orders, d""",
    "extent": """
        SELECT min(c_acctbal) AS south, max(c_acctbal) AS north, min(c_nationkey) AS west,
               max(c_nationkey) AS east, (min(c_acctbal) + max(c_acctbal)) / 2 AS centre_latitude,
               (min(c_nationkey) + max(c_nationkey)) / 2 AS centre_longitude
        FROM customer""",
    "scaled_points": f"""
        WITH s AS (SELECT quantile_cont(value, {SIXTHS}) AS cuts, min(user_id) AS mn,
                          max(user_id) AS mx FROM events)
        SELECT event_id, value, user_id, {CLASS.format(cuts='cuts', value='value')} AS colour_class,
               {COLOUR.format(cuts='cuts', value='value')} AS colour,
               {COLOUR.format(cuts='cuts', value='value')} AS stroke_colour,
               CASE WHEN mx = mn THEN 25.0 ELSE (user_id - mn) / (mx - mn) * 50 END AS size
        FROM events, s""",
    "scaled_points_not_finite": f"""
        WITH e AS (
            SELECT event_id, CASE event_id % 11 WHEN 1 THEN CAST('NaN' AS DOUBLE)
                WHEN 2 THEN CAST('Infinity' AS DOUBLE) WHEN 3 THEN CAST('-Infinity' AS DOUBLE)
                WHEN 4 THEN NULL ELSE value END AS strange
            FROM events
        ), s AS (
            SELECT quantile_cont(strange, {SIXTHS}) AS cuts, min(strange) AS mn, max(strange) AS mx
            FROM e WHERE isfinite(strange))
        SELECT event_id,
               CASE WHEN NOT isnan(strange)
                    THEN {CLASS.format(cuts='cuts', value='strange')} END AS colour_class,
               CASE WHEN isfinite(strange) THEN (strange - mn) / (mx - mn) * 50 END AS size,
               (mn + mx) / 2 AS latitude, (mn + mx) / 2 AS longitude
        FROM e, s""",
    "typed_roundtrip": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
               CAST(year(o_orderdate) AS INTEGER) AS election
        FROM orders""",
    "clustered_roundtrip": """
        SELECT p_partkey, p_brand, p_type, CAST(length(p_type) AS INTEGER) AS election
        FROM part""",
    "replace_one_election": """
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice
        FROM orders""",
    "replace_with_nothing": """
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_orderstatus <> 'F'""",
    "table_in_database": """
        SELECT s_suppkey, CASE WHEN s_nationkey = 5 THEN 0 ELSE s_acctbal END AS s_acctbal,
               s_nationkey
        FROM supplier WHERE s_nationkey <> 6""",
    "saved_layer": f"""
        WITH layer AS ({LAYER.format(
            stations=STATIONS_2017, where="NOT regexp_matches(code, '^2')")}),
        view AS (
            SELECT quantile_cont(rate, {SIXTHS}) AS cuts,
                   CAST(min(registered) AS DOUBLE) AS size_low,
                   CAST(max(registered) AS DOUBLE) AS size_high,
                   (min(latitude) + max(latitude)) / 2 AS centre_latitude,
                   (min(longitude) + max(longitude)) / 2 AS centre_longitude
            FROM layer)
        SELECT layer.*, {', '.join(f'round(cuts[{k + 1}], 6) AS threshold_{k}' for k in range(5))},
               size_low, size_high, centre_latitude, centre_longitude
        FROM layer, view""",
    "delimited_roundtrip": CUSTOMER,
    "cr_split_records": "SELECT p_partkey, p_name FROM part",
    "compressed_roundtrip": CUSTOMER,
    "latin1_roundtrip": "SELECT p_partkey, 'pièce ' || p_name AS name FROM part",
    "ragged_rows": """
        SELECT l_orderkey AS "order", l_linenumber AS line, l_returnflag AS flag FROM lineitem""",
    "clean_copy": """
        SELECT c_custkey, c_name, c_mktsegment AS segment FROM customer
        WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "geo_split_scan": """
        SELECT s_suppkey, repeat('rue "A",' || chr(10), CAST(s_suppkey % 9 AS INTEGER)) || s_name
                   AS geo_adresse,
               CAST(s_suppkey % 9 + 1 AS BIGINT) AS n_lines
        FROM supplier""",
    "headers_of_two_orders": CUSTOMER,
    "communes_in_chunks": """
        SELECT nation, chunk, list_sort(list(c_name)) AS communes
        FROM (SELECT nation, c_name,
                     (row_number() OVER (PARTITION BY nation ORDER BY c_name) - 1) // 40 AS chunk
              FROM (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS nation, c_name FROM customer
                    WHERE c_nationkey % 2 = 0))
        GROUP BY 1, 2""",
    "losses_of_build": f"""
        WITH places AS (SELECT * FROM supplier WHERE s_nationkey <> 3),
        matched AS (SELECT count(*) AS n FROM ({REBUILT}))
        SELECT (SELECT count(*) FROM customer) AS export_read,
               CAST(0 AS BIGINT) AS export_ragged,
               (SELECT count(*) FROM customer WHERE c_mktsegment = 'HOUSEHOLD') AS export_incomplete,
               (SELECT count(*) FROM supplier) AS official_read,
               (SELECT count(*) FROM supplier WHERE s_suppkey % 10000 % 7 = 0) AS official_ragged,
               (SELECT count(*) FROM supplier) AS places_read,
               CAST(0 AS BIGINT) AS places_ragged,
               (SELECT count(*) FROM places) - (SELECT n FROM matched) AS geo_left_alone,
               (SELECT count(*) FROM supplier WHERE s_acctbal >= 0) - (SELECT n FROM matched)
                   AS geo_right_alone,
               (SELECT count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')
                   + (SELECT n FROM matched) AS stations""",
    "mixed_encodings": """
        SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'piece ' ELSE 'pièce ' END || p_name AS name
        FROM part""",
    "scan_splits": """
        SELECT CAST(count(*) AS BIGINT) AS rows, true AS within, true AS whole, true AS split
        FROM orders""",
    "replaced_together": """
        SELECT o_orderkey, o_totalprice, o_orderstatus, 1 AS version FROM orders
        UNION ALL
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN -o_totalprice ELSE o_totalprice END,
               o_orderstatus, 2 FROM orders WHERE o_orderstatus <> 'P'""",
    "layer_follows_stations": f"""
        WITH layer AS ({LAYER.format(
            stations=STATIONS_2017, where="NOT regexp_matches(code, '^2') AND commune <> 'BUILDING'")}),
        view AS (SELECT quantile_cont(rate, {SIXTHS}) AS cuts FROM layer)
        SELECT layer.*, {', '.join(f'round(cuts[{k + 1}], 6) AS threshold_{k}' for k in range(5))}
        FROM layer, view""",
}
