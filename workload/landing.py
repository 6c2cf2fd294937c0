"""Readers and writers (S, K) and the filters that follow them (P, U1).

Spark derives the landing files from the test tables, in the collectors' document
form, and the queries read them back. Each kind is landed once per session.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide import functions as M
from macrotide.functions.time import DAY_FIRST, EPOCH
from macrotide.operators import clean, network, quality
from macrotide.plans import layers
from macrotide.session import scratch_dir
from macrotide.sources import bronze, sinks, tables
from workload import standins as st
from workload.registry import query, table
from workload.standins import BLOCKS, CATALOG, MOVED_DAYS, PRICES, SERIES_ROWS, with_

WRONG_YEAR = 1996
FIRST_RUN, SECOND_RUN = "2024-01-01T00:00:00", "2024-02-01T00:00:00"


def landed(build: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """The folder that ``build`` fills, built once for each session and data folder."""

    @cache
    def once(spark: SparkSession, sf_dir: str) -> str:
        path = scratch_dir(spark, build.__name__)
        build(spark, sf_dir, path)
        return path

    once.build = build
    return once


def _amounts(c: F.Column) -> F.Column:
    return F.create_map(F.lit("usd"), c, F.lit("eur"), F.lit("0"))


@landed
def price_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Two overlapping collections. The second revises days with one order. Days with
    three orders have no price ('N/A'), days with five have no market data."""
    bars = st.prices(spark, sf_dir)
    price = F.when(F.col("n_rows") == 3, "N/A").otherwise(F.col("price_usd").cast("string"))
    first = bars.withColumns({"price": price, "collection_timestamp": F.lit(FIRST_RUN)})
    second = first.filter("n_rows = 1").withColumns(
        {"price": (F.col("price_usd") * 2).cast("string"), "collection_timestamp": F.lit(SECOND_RUN)}
    )
    for run in (first, second):
        batches = sinks.with_batch_info(run, "asset_id", source="prices")
        record = F.transform("records", lambda r: F.struct(
            F.date_format(r["date"], DAY_FIRST).alias("date"), F.col("asset_id").alias("coin_id"),
            r["collection_timestamp"].alias("collection_timestamp"),
            F.struct(F.when(r["n_rows"] != 5, F.struct(
                _amounts(r["price"]).alias("current_price"), _amounts(r["n_rows"].cast("string")).alias("market_cap"),
                _amounts(r["volume_usd"].cast("string")).alias("total_volume"),
            )).alias("market_data")).alias("raw_data"),
        ))
        sinks.write_documents(batches, path, F.struct("batch_info", record.alias("records")))


@landed
def series_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One document per category and year, as ``category=<slug>/``. Days with two
    orders have no value ('.'); ``treasury_2y`` always fails."""
    catalog = tables.series_catalog(spark)
    points = st.series(spark, sf_dir).join(catalog, "series_key")
    value = F.when(F.col("n_rows") == 2, ".").otherwise(F.col("numeric_value").cast("string"))
    # A series has one point per day, so the list of a series and year is bounded.
    payloads = points.groupBy("category_label", F.year("date").alias("year"), "series_key", "series_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), value.alias("value")))).alias("data_points"),
        F.min("date").cast("string").alias("start_date"), F.max("date").cast("string").alias("end_date"),
    )
    # Two batches declare one point too many.
    wrong = F.col("series_key").isin("treasury_10y", "sp500_index") & (F.col("year") == WRONG_YEAR)
    declared = (F.size("data_points") + wrong.cast("int")).cast("bigint").alias("count")
    payload = F.struct("series_id", "data_points", declared, "start_date", "end_date")
    documents = payloads.groupBy("category_label", "year").agg(
        F.map_from_entries(F.collect_list(F.struct("series_key", payload))).alias("series_data"),
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
    )
    kind = documents.schema["series_data"].dataType.valueType
    failed = F.create_map(F.lit("treasury_2y"), F.lit(None).cast(kind))
    data = F.when(F.col("category_label") == "Interest Rates", F.map_concat("series_data", failed)).otherwise(F.col("series_data"))
    info = F.struct(
        F.lit(FIRST_RUN).alias("collection_timestamp"), M.slug("category_label").alias("category"), "start_date", "end_date",
        F.size(data).cast("bigint").alias("series_count"), F.lit("series").alias("api_source"),
    )
    out = documents.select(M.slug("category_label").alias("category"), F.struct(info.alias("batch_info"), data.alias("series_data")).alias("doc"))
    sinks.write_documents(out, path, "doc", "category")


def _snapshots(docs: DataFrame, path: str, prefix: str, at: str | F.Column, doc: F.Column) -> None:
    """One document per snapshot below a folder named as the collector names the file."""
    at = F.col(at) if isinstance(at, str) else at
    named = docs.withColumn("snapshot", F.concat(F.lit(prefix + "_"), M.format_snapshot(at)))
    sinks.write_documents(named, path, doc, "snapshot")


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type: the last value, counts and ids."""
    return table(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").alias("day")).agg(
        F.count(F.lit(1)).alias("count"), F.sum("user_id").alias("vsize"), F.sum(st.whole_cents("value")).alias("total_fee"),
        F.max("event_id").alias("height"),
        *[F.max_by("value", F.when(F.col("event_type") == t, F.col("ts"))).alias(t) for t in st.TARGET_OF],
    )


@landed
def fee_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    pairs = [x for event, target in st.TARGET_OF.items() for x in (F.lit(str(target)), F.col(event))]
    _snapshots(_days(spark, sf_dir), path, "fee_estimates", "day", F.create_map(*pairs))


@landed
def mempool_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    histogram = F.array(*[F.array(F.col(t), F.col("count").cast("double")) for t in sorted(st.TARGET_OF)]).alias("fee_histogram")
    _snapshots(_days(spark, sf_dir), path, "mempool", "day", F.struct("count", "vsize", "total_fee", histogram))


@landed
def tip_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    days = _days(spark, sf_dir)
    stamp = M.format_snapshot("day").alias("timestamp")
    _snapshots(days, path, "current_height", "day", F.struct("height", stamp))
    _snapshots(days, path, "current_hash", "day", F.struct(F.md5(F.col("height").cast("string")).alias("hash"), stamp))


def _chunks(rows: DataFrame, number: str) -> DataFrame:
    """Unique ascending ids in lists of a thousand, with a made-up time per list."""
    chunk = F.floor(F.col(number) / 1000)
    return rows.withColumns({"chunk": chunk, "at": M.from_epoch(F.lit(1704067200) + chunk * 60)})


@landed
def block_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    blocks = st.blocks(spark, sf_dir).withColumn("timestamp", M.seconds_between(F.expr(EPOCH), "block_ts").cast("bigint"))
    block = F.struct("id", "height", "timestamp", "tx_count", "size", "difficulty")
    lists = _chunks(blocks, "height").groupBy("at").agg(F.collect_list(block).alias("blocks"))
    _snapshots(lists, path, "recent_blocks", "at", F.col("blocks"))


def _event_lists(spark: SparkSession, sf_dir: str, element: F.Column) -> DataFrame:
    return _chunks(table(spark, sf_dir, "events"), "event_id").groupBy("chunk", "at").agg(
        F.sort_array(F.collect_list(element)).alias("items"), F.max("event_id").alias("height")
    )


def _tx() -> F.Column:
    return F.struct(
        F.col("event_id").cast("string").alias("txid"), st.whole_cents("value").alias("fee"), F.col("user_id").alias("vsize"),
        (F.col("event_id") * 2).alias("value"), F.col("user_id").alias("size"), (F.col("user_id") * 4).alias("weight"),
    )


@landed
def tx_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    _snapshots(_event_lists(spark, sf_dir, _tx()), path, "recent_transactions", "at", F.col("items"))


@landed
def txid_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    _snapshots(_event_lists(spark, sf_dir, F.col("event_id").cast("string")), path, "txids", "at", F.col("items"))


@landed
def detail_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Header, status and transactions of one block per list, in three folders."""
    lists = _event_lists(spark, sf_dir, _tx()).withColumn("block", F.md5(F.col("chunk").cast("string")))
    documents = {
        "header": F.struct(F.md5("block").alias("header"), F.col("block").alias("block_id")),
        "status": F.struct(F.lit(True).alias("in_best_chain"), "height"),
        "transactions": F.col("items"),
    }
    for kind, doc in documents.items():
        named = lists.withColumn("snapshot", F.concat(F.lit(f"block_{kind}_"), "block", F.lit("_"), M.format_snapshot("at")))
        sinks.write_documents(named, f"{path}/{kind}", doc, "snapshot")


TYPES = sorted(st.TARGET_OF)


def _run_rows(spark: SparkSession, sf_dir: str, grain: str, above: float) -> DataFrame:
    """A run is an hour or a day; a type landed if it has a value above the bound."""
    run = M.format_snapshot(F.date_trunc(grain, "ts")).alias("collection_timestamp")
    rows = F.count_if(F.col("value") > above).alias("n_rows")
    return table(spark, sf_dir, "events").groupBy(run, F.col("event_type").alias("data_type")).agg(rows)


# Prices ------------------------------------------------------------------------------

_LANDED_PRICES = f"""landed AS (
  SELECT asset_id, date, n_rows, volume_usd, CASE WHEN n_rows <> 3 THEN price_usd END AS price_usd, '{FIRST_RUN}' AS run FROM prices
  UNION ALL SELECT asset_id, date, n_rows, volume_usd, price_usd * 2, '{SECOND_RUN}' FROM prices WHERE n_rows = 1)"""


@query("s1_read_price_batches", with_(PRICES, _LANDED_PRICES) + """
SELECT asset_id, strftime(date, '%d-%m-%Y') AS date, run AS collection_timestamp, n_rows <> 5 AS has_market_data FROM landed""")
def s1(spark, sf):
    return bronze.read_price_batches(spark, price_files(spark, sf)).select(
        "asset_id", "date", "collection_timestamp", F.col("market_data").isNotNull().alias("has_market_data")
    )


@query("p1_normalize_prices", with_(PRICES, _LANDED_PRICES) + """
SELECT asset_id, date, price_usd, CAST(n_rows AS DOUBLE) AS market_cap_usd, volume_usd, CAST(run AS TIMESTAMP) AS collection_timestamp
FROM landed WHERE n_rows <> 5""")
def p1(spark, sf):
    return clean.normalize_prices(bronze.read_price_batches(spark, price_files(spark, sf)))


@query("p2_drop_without_market_data", with_(PRICES, _LANDED_PRICES) + """
SELECT asset_id, count(*) AS n_kept, count(price_usd) AS n_priced FROM landed WHERE n_rows <> 5 GROUP BY 1""")
def p2(spark, sf):
    typed = clean.normalize_prices(bronze.read_price_batches(spark, price_files(spark, sf)))
    return typed.groupBy("asset_id").agg(F.count(F.lit(1)).alias("n_kept"), F.count("price_usd").alias("n_priced"))


SILVER_PRICES_SQL = with_(PRICES) + """
SELECT asset_id, date, CASE n_rows WHEN 1 THEN price_usd * 2 WHEN 3 THEN NULL ELSE price_usd END AS price_usd, volume_usd,
  CASE WHEN n_rows = 3 THEN 'price_missing' ELSE '' END AS flags FROM prices WHERE n_rows <> 5"""


@query("silver_prices", SILVER_PRICES_SQL)
def silver_prices(spark, sf):
    silver = layers.silver_prices(spark, price_files(spark, sf))
    return silver.select("asset_id", "date", "price_usd", "volume_usd", M.comma_list("quality_flags").alias("flags"))


# Economic series ---------------------------------------------------------------------

@query("s2_read_series_batches", with_(SERIES_ROWS, CATALOG) + """
SELECT series_key, series_id, CASE category WHEN 'sp500' THEN 's&p_500' ELSE category END AS category, CAST(date AS VARCHAR) AS date,
  CASE WHEN n_rows <> 2 THEN numeric_value END AS value FROM series JOIN catalog USING (series_key)""")
def s2(spark, sf):
    points = bronze.read_series_batches(spark, series_files(spark, sf))
    return points.select("series_key", "series_id", "category", "date", M.safe_double("value").alias("value"))


_SILVER_SERIES = """
SELECT series_key, date, CASE WHEN n_rows <> 2 THEN numeric_value END AS numeric_value, series_id, category
FROM series JOIN catalog USING (series_key)"""


@query("p4_normalize_series", with_(SERIES_ROWS, CATALOG) + _SILVER_SERIES)
def p4(spark, sf):
    typed = clean.normalize_series(bronze.read_series_batches(spark, series_files(spark, sf)), tables.series_catalog(spark))
    return typed.drop("collection_timestamp")


SILVER_SERIES_SQL = with_(SERIES_ROWS, CATALOG) + _SILVER_SERIES


@query("silver_series", SILVER_SERIES_SQL)
def silver_series(spark, sf):
    silver = layers.silver_series(spark, series_files(spark, sf))
    return silver.select("series_key", "date", "numeric_value", "series_id", "category")


@query("p8_available_series", with_(SERIES_ROWS) + """
SELECT series_key, count(*) + CAST(series_key IN ('treasury_10y', 'sp500_index') AS BIGINT) AS n_points FROM series GROUP BY 1""")
def p8(spark, sf):
    payloads = clean.available_series(bronze.read_series_payloads(spark, series_files(spark, sf)))
    return payloads.groupBy("series_key").agg(F.sum("payload.count").alias("n_points"))


@query("p11_category_of_slug", with_(SERIES_ROWS, CATALOG) + """
SELECT category, count(*) AS n_points FROM series JOIN catalog USING (series_key) GROUP BY 1""")
def p11_slug(spark, sf):
    points = clean.category_of_slug(bronze.read_series_batches(spark, series_files(spark, sf)), tables.series_catalog(spark))
    return points.groupBy("category").agg(F.count(F.lit(1)).alias("n_points"))


@query("u1_union_categories", with_(SERIES_ROWS, CATALOG) + """
SELECT series_key, CAST(date AS VARCHAR) AS date, series_id FROM series JOIN catalog USING (series_key)""")
def u1(spark, sf):
    root = series_files(spark, sf)
    slugs = ["interest_rates", "sofr", "s&p_500", "jobless_claims"]
    parts = [bronze.read_series_batches(spark, f"{root}/category={slug}") for slug in slugs]
    return clean.union_categories(*parts).select("series_key", "date", "series_id")


@query("q9_reconcile_landed", with_(SERIES_ROWS) + f"""
SELECT series_key, CAST({WRONG_YEAR} AS INTEGER) AS year, count(*) + 1 AS declared_count, count(*) AS actual_count FROM series
WHERE series_key IN ('treasury_10y', 'sp500_index') AND year(date) = {WRONG_YEAR} GROUP BY ALL""")
def q9_landed(spark, sf):
    """Series whose landed file declares another number of points than it holds."""
    bad = quality.reconcile_counts(bronze.read_series_counts(spark, series_files(spark, sf)))
    years = bronze.read_series_payloads(spark, series_files(spark, sf)).select(
        "batch_file", "series_key", F.substring("payload.start_date", 1, 4).cast("int").alias("year")
    )
    return bad.join(years, ["batch_file", "series_key"]).select("series_key", "year", "declared_count", "actual_count")


# Network -----------------------------------------------------------------------------

@query("s3_read_fee_snapshots", with_(st.FEES) + """
SELECT date_trunc('day', snapshot_ts) AS snapshot_ts, target, arg_max(fee_rate, fees.snapshot_ts) AS fee_rate FROM fees GROUP BY 1, 2""")
def s3(spark, sf):
    return bronze.read_fee_snapshots(spark, fee_files(spark, sf))


_MEMPOOL_DAYS = """SELECT date_trunc('day', ts) AS snapshot_ts, count(*) AS count, CAST(sum(user_id) AS BIGINT) AS vsize,
  CAST(sum(CAST(floor(value * 1e2 + 5e-1) AS BIGINT)) AS BIGINT) AS total_fee FROM events GROUP BY 1"""


@query("s4_read_mempool_snapshots", _MEMPOOL_DAYS.replace(" FROM events", "".join(
    f", arg_max(value, CASE WHEN event_type = '{t}' THEN ts END) AS fee_{t}" for t in sorted(st.TARGET_OF)) + " FROM events"))
def s4(spark, sf):
    """The pairs of the histogram as columns: fee rates by event type, each with the day's count."""
    states = bronze.read_mempool_snapshots(spark, mempool_files(spark, sf))
    rates = {f"fee_{t}": F.when(F.col("fee_histogram")[i][1] == F.col("count"), F.col("fee_histogram")[i][0]) for i, t in enumerate(sorted(st.TARGET_OF))}
    return states.withColumns(rates).drop("fee_histogram")


@query("s5_read_blocks", with_(BLOCKS) + "SELECT id, height, block_ts, tx_count, size, difficulty FROM blocks")
def s5(spark, sf):
    blocks = bronze.read_blocks(spark, block_files(spark, sf))
    return blocks.select("id", "height", "block_ts", "tx_count", "size", "difficulty")


@query("s6_read_mempool_txs", """
SELECT CAST(event_id AS VARCHAR) AS txid, CAST(floor(value * 1e2 + 5e-1) AS BIGINT) AS fee, user_id AS vsize, event_id * 2 AS value,
  TIMESTAMP '2024-01-01' + to_minutes(event_id // 1000) AS snapshot_ts FROM events""")
def s6(spark, sf):
    return bronze.read_mempool_txs(spark, tx_files(spark, sf))


@query("s7_read_mempool_txids", """
SELECT TIMESTAMP '2024-01-01' + to_minutes(event_id // 1000) AS snapshot_ts, CAST(event_id AS VARCHAR) AS txid FROM events""")
def s7(spark, sf):
    return bronze.read_mempool_txids(spark, txid_files(spark, sf))


@query("s8_read_chain_tip", """
SELECT date_trunc('day', ts) AS snapshot_ts, max(event_id) AS height, md5(CAST(max(event_id) AS VARCHAR)) AS hash FROM events GROUP BY 1""")
def s8(spark, sf):
    return bronze.read_chain_tip(spark, tip_files(spark, sf))


@query("s9_read_block_details", """
WITH lists AS (SELECT md5(CAST(event_id // 1000 AS VARCHAR)) AS block_id, max(event_id) AS height, count(*) AS n_tx,
  CAST(sum(CAST(floor(value * 1e2 + 5e-1) AS BIGINT)) AS BIGINT) AS fees FROM events GROUP BY 1)
SELECT block_id, md5(block_id) AS header, height, n_tx, fees FROM lists""")
def s9(spark, sf):
    root = detail_files(spark, sf)
    header = bronze.read_block_details(spark, f"{root}/header", "header").select("block_id", "header")
    status = bronze.read_block_details(spark, f"{root}/status", "status").select("block_id", "height")
    txs = bronze.read_block_details(spark, f"{root}/transactions", "transactions")
    totals = txs.groupBy("block_id").agg(F.count(F.lit(1)).alias("n_tx"), F.sum("fee").alias("fees"))
    return header.join(status, "block_id").join(totals, "block_id")


def _runs_sql(grain: str, above: int) -> str:
    run = f"date_trunc('{grain}', ts)"
    return f"""runs AS (SELECT strftime({run}, '%Y%m%d_%H%M%S') AS collection_timestamp, {run} AS run_ts,
  coalesce(list_sort(list(DISTINCT event_type) FILTER (value > {above})), []) AS seen FROM events GROUP BY 1, 2)"""


_ALL_TYPES = "[" + ", ".join(f"'{t}'" for t in TYPES) + "]"


@query("s10_read_collection_log", with_(_runs_sql("day", 150)) + f"""
SELECT collection_timestamp, run_ts, array_to_string(seen, ',') AS types,
  CASE WHEN len(seen) = 5 THEN 'success' ELSE 'failed' END AS collection_status,
  CASE WHEN len(seen) < 5 THEN 'missing: ' || array_to_string(list_filter({_ALL_TYPES}, lambda t: NOT list_contains(seen, t)), ',') END AS error
FROM runs""")
def s10(spark, sf):
    path = scratch_dir(spark, "ledger")
    _snapshots(
        sinks.collection_log(_run_rows(spark, sf, "day", 150), TYPES), path, "collection_summary", M.parse_snapshot("collection_timestamp"),
        F.struct("collection_timestamp", "data_types_collected", "collection_status", "error"),
    )
    log = bronze.read_collection_log(spark, path)
    return log.select(
        "collection_timestamp", "run_ts", M.comma_list("data_types_collected").alias("types"), "collection_status", "error"
    )


@query("s12_read_table", with_(PRICES) + "SELECT asset_id, date, price_usd FROM prices")
def s12(spark, sf):
    path = scratch_dir(spark, "table")
    sinks.write_table(st.prices(spark, sf), path)
    return tables.read_table(spark, path).select("asset_id", "date", "price_usd")


@query("s14_with_snapshot_ts", _MEMPOOL_DAYS.replace("date_trunc('day', ts) AS snapshot_ts, count(*) AS count", "date_trunc('day', ts) AS at, count(*) AS n").split(", CAST")[0] + " FROM events GROUP BY 1")
def s14(spark, sf):
    files = bronze.read_text(spark, mempool_files(spark, sf))
    return bronze.with_snapshot_ts(files, into="at").select("at", F.get_json_object("value", "$.count").cast("bigint").alias("n"))


@query("fact_network_landed", with_(BLOCKS) + """
SELECT CAST(block_ts AS DATE) AS date, count(*) AS n_blocks, CAST(sum(size) AS BIGINT) AS size FROM blocks GROUP BY 1""")
def network_landed(spark, sf):
    daily = network.daily_blocks(bronze.read_blocks(spark, block_files(spark, sf)))
    return daily.select("date", "n_blocks", "size")


_TYPES = sorted(st.TARGET_OF)
LOADS = {"low": 0, "medium": 330, "high": 350}


GOLD_NETWORK_SQL = with_(BLOCKS, MOVED_DAYS) + f"""
, days AS (SELECT CAST(ts AS DATE) AS date, count(*) AS load, {', '.join(
    f"arg_max(value, CASE WHEN event_type = '{t}' THEN ts END) AS fee_{t}" for t in _TYPES)} FROM events GROUP BY 1)
SELECT date, n_blocks, tx_count, size, {', '.join(f'fee_{t}' for t in _TYPES)}, CAST(load AS DOUBLE) AS mempool_avg,
  CASE WHEN load >= 350 THEN 'high' WHEN load >= 330 THEN 'medium' WHEN load >= 0 THEN 'low' END AS congestion
FROM network_days LEFT JOIN days USING (date)"""


@query("gold_network", GOLD_NETWORK_SQL)
def gold_network(spark, sf):
    """From landed blocks, fee estimates and mempool states to one row per day."""
    blocks = bronze.read_blocks(spark, block_files(spark, sf))
    blocks = blocks.withColumn("block_ts", F.date_add(F.to_date("block_ts"), st.days_to_events(spark, sf)))
    gold = layers.gold_network(
        blocks, bronze.read_fee_snapshots(spark, fee_files(spark, sf)), bronze.read_mempool_snapshots(spark, mempool_files(spark, sf)), LOADS
    )
    return network_days(gold)


def network_days(gold: DataFrame) -> DataFrame:
    fees = {f"fee_{t}": F.col("fee_rates")[target] for t, target in st.TARGET_OF.items()}
    return gold.withColumns(fees).select("date", "n_blocks", "tx_count", "size", *fees, "mempool_avg", "congestion")


@query("gold_refresh", with_(BLOCKS, MOVED_DAYS) + """
SELECT date, n_blocks, tx_count, size FROM network_days WHERE date >= DATE '2024-01-01'""")
def gold_refresh(spark, sf):
    """Days written once, then half of them again: each day stands once."""
    blocks = st.blocks(spark, sf).withColumn("block_ts", F.date_add(F.to_date("block_ts"), st.days_to_events(spark, sf)))
    days, path = network.daily_blocks(blocks).select("date", "n_blocks", "tx_count", "size"), scratch_dir(spark, "gold-days")
    layers.refresh(days, path, "2024-01-01", "2024-12-31")
    layers.refresh(days, path, "2024-01-10", "2024-01-12")
    return tables.read_table(spark, path).select("date", "n_blocks", "tx_count", "size")


# Writers -----------------------------------------------------------------------------

@query("k1_write_bronze", """
SELECT o_orderstatus AS source, o_orderpriority AS category, o_orderkey, o_totalprice FROM orders""")
def k1(spark, sf):
    path = scratch_dir(spark, "bronze")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("source"), F.col("o_orderpriority").alias("category"), "o_orderkey", "o_totalprice"
    )
    sinks.write_bronze(rows, path)
    back = spark.read.schema("o_orderkey bigint, o_totalprice double, source string, category string").json(path)
    return back.select("source", "category", "o_orderkey", "o_totalprice")


@query("k2_cap_records_per_file", with_(PRICES) + """
SELECT count(*) AS n_rows, count(*) FILTER (asset_id = 'F') AS n_f, count(*) FILTER (asset_id = 'O') AS n_o, true AS within_cap FROM prices""")
def k2(spark, sf):
    path = scratch_dir(spark, "capped")
    sinks.write_bronze(st.prices(spark, sf), path, partition_cols=(), max_records=sinks.BATCH_RECORDS)
    rows = spark.read.schema("asset_id string, date date, price_usd double").json(path)
    files = rows.groupBy(bronze.file_path().alias("file")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("asset_id") == "F").alias("n_f"),
                                                              F.count_if(F.col("asset_id") == "O").alias("n_o"))
    return files.agg(
        F.sum("n").alias("n_rows"), F.sum("n_f").alias("n_f"), F.sum("n_o").alias("n_o"), (F.max("n") <= sinks.BATCH_RECORDS).alias("within_cap")
    )


@query("k3_write_table", with_(PRICES) + """
SELECT asset_id, date, price_usd, CAST(year(date) AS INTEGER) AS year FROM prices""")
def k3(spark, sf):
    """Written whole, then the years from 1999 again: the table stays the same."""
    path = scratch_dir(spark, "gold")
    rows = st.prices(spark, sf).select("asset_id", "date", "price_usd", F.year("date").alias("year"))
    sinks.write_table(rows, path, "year", ["asset_id", "date"])
    sinks.write_table(rows.filter(F.col("year") >= 1999), path, "year")
    return tables.read_table(spark, path).select("asset_id", "date", "price_usd", "year")


@query("k4_write_collection_log", with_(_runs_sql("hour", 0)) + """
SELECT CASE WHEN len(seen) = 5 THEN 'success' ELSE 'failed' END AS collection_status, count(*) AS n_runs FROM runs GROUP BY 1""")
def k4(spark, sf):
    path = scratch_dir(spark, "ledger")
    sinks.write_collection_log(_run_rows(spark, sf, "hour", 0), path, TYPES)
    log = bronze.read_json(spark, path, "collection_status string", lines=True)
    return log.groupBy("collection_status").agg(F.count(F.lit(1)).alias("n_runs"))


@query("k5_with_batch_info", with_(PRICES) + """
, placed AS (SELECT *, (row_number() OVER (PARTITION BY asset_id ORDER BY date) - 1) // 50 AS batch_no FROM prices)
SELECT asset_id, CAST(batch_no AS BIGINT) AS batch_no, strftime(min(date), '%d-%m-%Y') AS first_date, strftime(max(date), '%d-%m-%Y') AS last_date,
  count(*) AS record_count, CAST(count(*) AS INTEGER) AS n_records FROM placed GROUP BY 1, 2""")
def k5(spark, sf):
    rows = st.prices(spark, sf).withColumn("collection_timestamp", F.lit(FIRST_RUN))
    batches = sinks.with_batch_info(rows, "asset_id", source="prices")
    return batches.select(
        "asset_id", "batch_no", "batch_info.first_date", "batch_info.last_date", "batch_info.record_count",
        F.size("records").alias("n_records"),
    )


# Unreadable documents ----------------------------------------------------------------

@landed
def broken_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Price and fee documents of an asset or type and a month. Those of even months are cut off in the middle; price
    documents of month 3 declare a count that is no number; fee documents of month 5 have no time in their path."""
    months = st.prices(spark, sf_dir).groupBy("asset_id", F.date_format("date", "yyyyMM").alias("month")).agg(
        F.sort_array(F.collect_list(F.struct("date", "price_usd"))).alias("days")  # a month has 31 at most
    )
    record = F.transform("days", lambda d: F.struct(
        F.date_format(d["date"], DAY_FIRST).alias("date"), F.col("asset_id").alias("coin_id"), F.lit(FIRST_RUN).alias("collection_timestamp"),
        F.struct(F.struct(_amounts(d["price_usd"].cast("string")).alias("current_price")).alias("market_data")).alias("raw_data"),
    ))
    number = F.substring("month", 5, 2).cast("int")
    body = F.to_json(F.struct(F.struct(F.lit(1).alias("record_count")).alias("batch_info"), record.alias("records")), {"pretty": "true"})
    wrong = F.regexp_replace(body, r'("record_count"\s*:\s*)1', '$1"many"')
    prices = months.select(
        number.alias("number"), F.concat_ws("_", F.lit("prices"), "asset_id", "month").alias("snapshot"), F.lit("prices").alias("kind"),
        F.when(number == 3, wrong).otherwise(body).alias("value"),
    )
    day = F.to_date("o_orderdate")
    fee_days = table(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.max("o_totalprice").alias("fee"))
    stamp = F.when(F.month("day") == 5, F.date_format("day", "yyyyMM_dd")).otherwise(M.format_snapshot(F.col("day").cast("timestamp_ntz")))
    fees = fee_days.select(
        F.month("day").alias("number"), F.concat(F.lit("fee_estimates_"), stamp).alias("snapshot"), F.lit("fees").alias("kind"),
        F.to_json(F.create_map(F.lit("1"), F.col("fee").cast("string")), {"pretty": "true"}).alias("value"),
    )
    cut = F.when(F.col("number") % 2 == 0, F.substring("value", F.lit(1), F.floor(F.length("value") * 0.6).cast("int"))).otherwise(F.col("value"))
    texts = prices.unionByName(fees).select("kind", "snapshot", cut.alias("value"))
    texts.write.option("maxRecordsPerFile", 1).partitionBy("kind", "snapshot").text(path)


_MONTHS = "months AS (SELECT DISTINCT asset_id, date_trunc('month', date) AS m FROM prices)"
_FEE_DAYS = "fee_days AS (SELECT CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS fee FROM orders GROUP BY 1)"


@query("s1_prices_beside_broken_files", with_(PRICES) + "SELECT asset_id, date, price_usd FROM prices WHERE month(date) % 2 = 1")
def s1_beside_broken(spark, sf):
    silver, _ = layers.silver_with_rejects(spark, "prices", f"{broken_files(spark, sf)}/kind=prices")
    return silver.select("asset_id", "date", "price_usd")


@query("s3_fees_beside_broken_files", "WITH " + _FEE_DAYS + """
SELECT CASE WHEN month(day) <> 5 THEN CAST(day AS TIMESTAMP) END AS snapshot_ts, 1 AS target, fee AS fee_rate FROM fee_days WHERE month(day) % 2 = 1""")
def s3_beside_broken(spark, sf):
    return bronze.read_with_rejects(spark, "fees", f"{broken_files(spark, sf)}/kind=fees")[0]


@query("s1_rejected_documents", with_(PRICES, _MONTHS, _FEE_DAYS) + """
SELECT 'prices' AS kind, CASE WHEN month(m) = 3 THEN 'partly' ELSE 'unreadable' END AS reason, count(*) AS n_documents
FROM months WHERE month(m) = 3 OR month(m) % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'fees', CASE WHEN month(day) = 5 THEN 'untimed' ELSE 'unreadable' END, count(*)
FROM fee_days WHERE month(day) = 5 OR month(day) % 2 = 0 GROUP BY ALL""")
def s1_rejected(spark, sf):
    """One reject for each document that is cut off, does not fit its schema, or has no time."""
    root = broken_files(spark, sf)
    return bronze.reject_counts({kind: bronze.read_with_rejects(spark, kind, f"{root}/kind={kind}")[1] for kind in ("prices", "fees")})
