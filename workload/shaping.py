"""Projections, filters, versions, set operations and column helpers (P, W8, U, X, S13, S15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrotide import functions as M
from macrotide.functions.time import DAY_FIRST
from macrotide.operators import clean
from macrotide.sources.bronze import parse_props
from macrotide.sources.tables import series_catalog
from workload import standins as st
from workload.registry import query, table
from workload.standins import BLOCKS, CATALOG, PRICES, SERIES_ROWS, with_


@query("s13_series_catalog", with_(SERIES_ROWS, CATALOG) + """
SELECT series_key, series_id, category, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
FROM catalog LEFT JOIN (SELECT series_key, sum(n_rows) AS n FROM series GROUP BY 1) USING (series_key)""")
def s13(spark, sf):
    collected = st.series(spark, sf).groupBy("series_key").agg(F.sum("n_rows").alias("n"))
    catalog = series_catalog(spark).drop("category_label")
    return catalog.join(collected, "series_key", "left").select(
        "series_key", "series_id", "category", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


@query("s15_parse_props", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def s15(spark, sf):
    return parse_props(table(spark, sf, "events").select("event_id", "event_type", "props"), "props", "k int")


@query("p3_safe_double", """
SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand, TRY_CAST(p_type AS DOUBLE) AS type_number FROM part""")
def p3(spark, sf):
    brand = F.split_part("p_brand", F.lit("#"), F.lit(2))
    return table(spark, sf, "part").select(
        "p_partkey", M.safe_double(brand).alias("brand"), M.safe_double("p_type").alias("type_number")
    )


@query("p5_filter_dates", """
SELECT event_id, ts, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def p5(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    return clean.filter_dates(events, "2024-01-05", "2024-01-20", "ts")


@query("p6_trailing_days", """
SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-06-30' - 365 AND DATE '2000-06-30'""")
def p6(spark, sf):
    return clean.trailing_days(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "2000-06-30", col="o_orderdate")


@query("p7_quality_flags", """
SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'balance_negative' END,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment_barred' END) AS flags,
  NOT (c_acctbal < 0) AND NOT (c_mktsegment = 'BUILDING') AS is_valid FROM customer""")
def p7(spark, sf):
    rules = {"balance_negative": clean.negative("c_acctbal"), "segment_barred": F.col("c_mktsegment") == "BUILDING"}
    flagged = clean.quality_flags(table(spark, sf, "customer"), rules)
    return flagged.select("c_custkey", M.comma_list("quality_flags").alias("flags"), "is_valid")


@query("p9_snapshot_sizes", """
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS list_size, len(string_split(text, ' ')) >= 1000 AS over_limit
FROM documents""")
def p9(spark, sf):
    """Documents split into words stand for the transaction lists of snapshots."""
    lists = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return clean.snapshot_sizes(lists, "words", 1000).select("doc_id", "list_size", "over_limit")


@query("p10_scatter", with_(PRICES) + """
SELECT price_usd AS x, before AS y FROM (
  SELECT price_usd, lag(volume_usd) OVER (PARTITION BY asset_id ORDER BY date) AS before FROM prices) WHERE before IS NOT NULL""")
def p10(spark, sf):
    from macrotide.operators.series import previous

    lagged = st.prices(spark, sf).withColumn("before", previous("volume_usd", "asset_id", "date"))
    return clean.scatter(lagged, "price_usd", "before")


@query("p11_with_series_meta", with_(st.OPEN_SERIES, CATALOG) + """
SELECT series_key, date, numeric_value, series_id, category FROM open_series LEFT JOIN catalog USING (series_key)""")
def p11(spark, sf):
    return clean.with_series_meta(st.open_series(spark, sf), series_catalog(spark))


@query("p12_sample_interval", with_(PRICES) + """
SELECT asset_id, date, price_usd FROM prices
WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND (date - DATE '1996-01-01') % 7 = 0""")
def p12(spark, sf):
    rows = st.prices(spark, sf).select("asset_id", "date", "price_usd")
    return clean.sample_interval(rows, "1996-01-01", 7, "2000-12-31")


@query("p13_blocks_from", with_(BLOCKS) + "SELECT height, id, size FROM blocks WHERE height <= 9000")
def p13(spark, sf):
    return clean.blocks_from(st.blocks(spark, sf).select("height", "id", "size"), 9000)


_NEWEST = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@query("w8_latest_version", f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} DESC' for c in _NEWEST)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def w8(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    return clean.latest_version(table(spark, sf, "lineitem").select(*keys, *_NEWEST), keys, _NEWEST)


@query("u2_merge_versions", with_(SERIES_ROWS) + """
, versions AS (SELECT series_key, date, numeric_value, 1 AS collected FROM series
  UNION ALL SELECT series_key, date, numeric_value * 2, 2 FROM series WHERE date >= DATE '1999-01-01'
  UNION ALL SELECT series_key, date + 3650, numeric_value, 2 FROM series)
SELECT series_key, date, arg_max(numeric_value, collected) AS numeric_value, max(collected) AS collected
FROM versions GROUP BY 1, 2""")
def u2(spark, sf):
    """The second collection revises the last years and adds days after them."""
    old = st.series(spark, sf).drop("n_rows").withColumn("collected", F.lit(1))
    again = old.withColumn("collected", F.lit(2))
    revised = again.filter(F.col("date") >= "1999-01-01").withColumn("numeric_value", F.col("numeric_value") * 2)
    added = again.withColumn("date", F.date_add("date", 3650))
    return clean.merge_versions(old, revised.unionByName(added), ["series_key", "date"], "collected")


# Column helpers --------------------------------------------------------------------

@query("x_time", """
SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS day_first, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS iso, CAST(o_orderdate AS DATE) AS parsed_day, o_orderdate AS parsed_stamp,
  o_orderdate AS parsed_iso, CAST(o_orderdate AS DATE) - 1 AS day_before, CAST(NULL AS DATE) AS bad_day
FROM orders""")
def x_time(spark, sf):
    text = table(spark, sf, "orders").select(
        "o_orderkey", M.format_day("o_orderdate", DAY_FIRST).alias("day_first"), M.format_snapshot("o_orderdate").alias("stamp"),
        M.format_iso("o_orderdate").alias("iso"), F.date_sub("o_orderdate", 1).alias("day_before"), "o_orderpriority",
    )
    return text.select(
        "o_orderkey", "day_first", "stamp", "iso", M.parse_day("day_first", DAY_FIRST).alias("parsed_day"),
        M.parse_snapshot("stamp").alias("parsed_stamp"), M.parse_iso("iso").alias("parsed_iso"), "day_before",
        M.parse_day("o_orderpriority").alias("bad_day"),
    )


@query("x_text", """
SELECT doc_id, replace(lower(source), ' ', '_') AS slug, octet_length(encode(text)) AS n_bytes, ltrim(trim(source), 'w') AS stripped,
  ends_with(text, '.') AS ends_dot, CASE WHEN n_chars > 1000 THEN 'true' ELSE 'false' END AS is_long,
  lang || ',' || source AS listed FROM documents""")
def x_text(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", M.slug("source").alias("slug"), M.byte_length("text").cast("bigint").alias("n_bytes"),
        F.ltrim(F.trim("source"), F.lit("w")).alias("stripped"), F.endswith("text", F.lit(".")).alias("ends_dot"),
        M.bool_text(F.col("n_chars") > 1000).alias("is_long"), M.comma_list(F.array("lang", "source")).alias("listed"),
    )


@query("x_maps", """
SELECT event_id, json_extract_string(props, '$.k') AS k, 'N/A' AS missing_key, CAST(1 AS INTEGER) AS n_keys,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k_number, true AS has_k, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS encoded
FROM events""")
def x_maps(spark, sf):
    parsed = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return parsed.select(
        "event_id", M.map_get("m", "k").alias("k"), M.map_get("m", "absent", "N/A").alias("missing_key"),
        F.size(F.map_keys("m")).alias("n_keys"), M.safe_long(M.map_get("m", "k")).alias("k_number"),
        F.map_contains_key("m", "k").alias("has_k"), F.to_json("m").alias("encoded"),
    )


@query("x_arithmetic", """
SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS ratio, l_tax / NULLIF(l_quantity, 0) * 1e2 AS share
FROM lineitem""")
def x_arithmetic(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", M.safe_div("l_extendedprice", "l_discount").alias("ratio"),
        M.percent("l_tax", "l_quantity").alias("share"),
    )


@query("x_arrays", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[1] AS DOUBLE) AS first_value,
  CAST(embedding[-1] AS DOUBLE) AS last_value, len(embedding) > 0 AS filled FROM embeddings""")
def x_arrays(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.size("embedding").alias("n"), F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.element_at("embedding", -1).cast("double").alias("last_value"), (F.size("embedding") > 0).alias("filled"),
    )
