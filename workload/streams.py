"""Streaming queries (T): whole tables through file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from macrotide.session import scratch_dir
from macrotide.sources.sinks import write_bronze
from macrotide.functions import comma_list
from macrotide.sources import schemas
from macrotide.sources.bronze import price_records
from macrotide.plans import layers
from macrotide.streaming import run_available, run_merged, run_routed, routed_table, stream_bronze, stream_dedupe, stream_documents
from macrotide.streaming import stream_silver_prices, stream_windows
from workload import landing, standins as st
from workload.landing import SILVER_PRICES_SQL, price_files
from workload.registry import query, table

EVENTS = "event_id bigint, ts timestamp_ntz, event_type string, value double"


def _events_stream(spark, sf):
    return stream_bronze(spark, sf, EVENTS, "parquet", glob="events.parquet")


def _collected(spark, stream, label):
    out = scratch_dir(spark, label)
    run_available(stream, out, scratch_dir(spark, f"{label}-state"))
    return spark.read.parquet(out)


@query("t1_stream_silver", SILVER_PRICES_SQL)
def t1_silver(spark, sf):
    """Price documents through the stream: cleaned, flagged, and the newest version of each day."""
    batches = stream_bronze(spark, price_files(spark, sf), schemas.PRICE_BATCH, lines=False)
    rows = stream_silver_prices(price_records(batches))
    out, year = scratch_dir(spark, "stream-silver"), F.coalesce(F.year("date").cast("string"), F.lit("none"))
    run_merged(
        rows.withColumn("year", year), out, scratch_dir(spark, "stream-silver-state"), ["asset_id", "date"],
        "collection_timestamp", "year", apart="date",
    )
    return spark.read.parquet(out).select("asset_id", "date", "price_usd", "volume_usd", comma_list("quality_flags").alias("flags"))


@query("t1_stream_bronze", "SELECT event_id, ts, event_type, value FROM events")
def t1(spark, sf):
    landing = scratch_dir(spark, "stream-landing")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    write_bronze(events, landing, partition_cols=())
    return _collected(spark, stream_bronze(spark, landing, EVENTS), "silver")


@query("t2_stream_dedupe", "SELECT event_id, ts, event_type, value FROM events")
def t2(spark, sf):
    """Every event lands twice, as overlapping collections would."""
    twice = _events_stream(spark, sf).unionByName(_events_stream(spark, sf))
    once = _collected(spark, stream_dedupe(twice, "event_id", "ts", "1 day"), "deduplicated")
    return once.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("t3_stream_windows", """
WITH windows AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
  CAST(sum(CAST(floor(value * 1e2 + 5e-1) AS BIGINT)) AS BIGINT) AS fee_cents, max(value) AS fee_max FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n, fee_cents, fee_max FROM windows
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def t3(spark, sf):
    """The windows that the watermark closes, two hours behind the newest event."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(st.whole_cents("value")).alias("fee_cents"), F.max("value").alias("fee_max")]
    windows = stream_windows(_events_stream(spark, sf), "ts", "1 hour", "2 hours", aggs, "event_type")
    closed = _collected(spark, windows, "windows")
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("t3_stream_windows_open", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS n, max(value) AS fee_max FROM events GROUP BY ALL""")
def t3_open(spark, sf):
    """All windows, those still open included, each in its newest state."""
    aggs = [F.count(F.lit(1)).alias("n"), F.max("value").alias("fee_max")]
    windows = stream_windows(_events_stream(spark, sf), "ts", "1 hour", "2 hours", aggs, "event_type")
    out = scratch_dir(spark, "open-windows")
    run_merged(
        windows.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")), out, scratch_dir(spark, "open-windows-state"),
        ["window_start", "window_end", "event_type"], "n", "day", mode="update",
    )
    found = spark.read.parquet(out).drop("day")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


# Mixed documents, routed ------------------------------------------------------------------

@landing.landed
def mixed_files(spark, sf_dir, path):
    """All kinds below one root, and a note that is of no kind."""
    for build, folder in (
        (landing.price_files, "prices"), (landing.series_files, "series"), (landing.fee_files, "network/fees"),
        (landing.mempool_files, "network/mempool"), (landing.block_files, "network/blocks"),
    ):
        build.build(spark, sf_dir, f"{path}/{folder}")
    table(spark, sf_dir, "region").select(F.col("r_name").alias("value")).coalesce(1).write.text(f"{path}/notes")


@landing.landed
def routed_tables(spark, sf_dir, path):
    """The silver tables of the stream, in two or more micro-batches."""
    documents = stream_documents(spark, mixed_files(spark, sf_dir), files_per_trigger=1000)
    run_routed(documents, path, scratch_dir(spark, "routes-state"))


@query("t1_routed_prices", SILVER_PRICES_SQL)
def t1_routed_prices(spark, sf):
    silver = routed_table(spark, routed_tables(spark, sf), "prices")
    return silver.select("asset_id", "date", "price_usd", "volume_usd", comma_list("quality_flags").alias("flags"))


@query("t1_routed_series", landing.SILVER_SERIES_SQL)
def t1_routed_series(spark, sf):
    silver = routed_table(spark, routed_tables(spark, sf), "series")
    return silver.select("series_key", "date", "numeric_value", "series_id", "category")


@query("t1_routed_network", landing.GOLD_NETWORK_SQL)
def t1_routed_network(spark, sf):
    root = routed_tables(spark, sf)
    blocks = routed_table(spark, root, "blocks").withColumn("block_ts", F.date_add(F.to_date("block_ts"), st.days_to_events(spark, sf)))
    return landing.network_days(layers.gold_network(blocks, *(routed_table(spark, root, k) for k in ("fees", "mempool")), landing.LOADS))


@query("t1_routed_rejects", "SELECT 'unknown' AS reason, CAST(1 AS BIGINT) AS n_documents")
def t1_routed_rejects(spark, sf):
    rejects = spark.read.parquet(f"{routed_tables(spark, sf)}/rejects")
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_documents"))
