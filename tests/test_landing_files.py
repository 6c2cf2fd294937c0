"""Readers on hand-made files, pretty-printed as collectors write them."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from macrotide.operators import clean, joins, quality, stats
from macrotide.plans import layers
from macrotide.sources import bronze, sinks, tables
from tests.conftest import rows


def land(folder, name, document):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(document, indent=2), encoding="utf-8")


def price(day, usd, stamp, **more):
    market = {"current_price": {"usd": usd, "eur": 1}, "market_cap": {"usd": 10.5}, "total_volume": {"usd": 7}}
    return {"date": day, "coin_id": "coin", "collection_timestamp": stamp, "raw_data": {"id": "coin", "market_data": market, **more}}


def batch(records, count=None, stamp="2024-03-01T10:00:00.123456"):
    info = {"collection_timestamp": stamp, "first_date": "01-01-2024", "last_date": "05-01-2024",
            "record_count": len(records) if count is None else count, "api_source": "x"}
    return {"batch_info": info, "records": records}


@pytest.fixture
def price_folder(tmp_path):
    early, late = "2024-03-01T10:00:00.000001", "2024-04-01T10:00:00"
    bare = price("04-01-2024", 5, early)
    del bare["raw_data"]["market_data"]
    land(tmp_path, "historical_20240101_to_20240105.json", batch([
        price("01-01-2024", 100.5, early, added_upstream={"a": [1]}), price("02-01-2024", "N/A", early), bare,
        price("05-01-2024", 104, early),
    ]))
    land(tmp_path, "historical_20240105_to_20240106.json", batch(
        [price("05-01-2024", 204, late), price("06-01-2024", -3, late)], count=3, stamp=late))
    return tmp_path


def test_price_batches(spark, price_folder):
    raw = bronze.read_price_batches(spark, str(price_folder))
    assert raw.count() == 6
    typed = clean.normalize_prices(raw)
    found = rows(typed.select("asset_id", "date", "price_usd", "market_cap_usd", "volume_usd"))
    assert found == [
        ("coin", date(2024, 1, 1), 100.5, 10.5, 7.0), ("coin", date(2024, 1, 2), None, 10.5, 7.0),
        ("coin", date(2024, 1, 5), 104.0, 10.5, 7.0), ("coin", date(2024, 1, 5), 204.0, 10.5, 7.0),
        ("coin", date(2024, 1, 6), -3.0, 10.5, 7.0),
    ]
    assert typed.agg(F.min("collection_timestamp")).first()[0] == datetime(2024, 3, 1, 10, 0, 0, 1)


def test_silver_prices_keep_the_newest_and_flag(spark, price_folder):
    silver = layers.silver_prices(spark, str(price_folder)).select("date", "price_usd", "quality_flags", "is_valid")
    assert rows(silver) == [
        (date(2024, 1, 1), 100.5, [], True), (date(2024, 1, 2), None, ["price_missing"], False),
        (date(2024, 1, 5), 204.0, [], True), (date(2024, 1, 6), -3.0, ["price_negative"], False),
    ]
    missing = joins.missing_dates(layers.silver_prices(spark, str(price_folder)), "asset_id", "2024-01-01", "2024-01-07")
    assert rows(missing) == [("coin", date(2024, 1, 3)), ("coin", date(2024, 1, 4)), ("coin", date(2024, 1, 7))]


def test_declared_counts(spark, price_folder):
    bad = quality.reconcile_counts(bronze.read_price_batch_info(spark, str(price_folder)))
    assert rows(bad.select("declared_count", "actual_count")) == [(3, 2)]


def payload(series_id, points):
    return {"series_id": series_id, "data_points": [{"realtime_start": "x", "date": d, "value": v} for d, v in points],
            "count": len(points), "start_date": "2024-01-01", "end_date": "2024-12-31", "raw_response": {"observations": []}}


@pytest.fixture
def series_folder(tmp_path):
    info = {"collection_timestamp": "2024-03-01T10:00:00", "category": "interest_rates", "start_date": "2024-01-01",
            "end_date": "2024-12-31", "series_count": 2, "api_source": "x"}
    rates = {"federal_funds_rate": payload("FEDFUNDS", [("2024-01-01", "5.33"), ("2024-02-01", ".")]), "treasury_2y": None}
    index = {"sp500_index": payload("SP500", [("2024-01-02", "4742.83"), ("2024-01-03", ""), ("2024-01-04", "NaN")])}
    land(tmp_path, "interest_rates/historical_a.json", {"batch_info": info, "series_data": rates})
    land(tmp_path, "s&p_500/historical_a.json", {"batch_info": {**info, "category": "s&p_500", "series_count": 1}, "series_data": index})
    land(tmp_path, "summary/complete.json", {"collection_info": {}, "data": {"interest_rates": rates, "sp500": index}})
    return tmp_path


def test_series_batches(spark, series_folder):
    points = bronze.read_series_batches(spark, str(series_folder))
    assert points.count() == 5, "the summary repeats every point and must not be counted"
    typed = clean.normalize_series(points, tables.series_catalog(spark))
    assert rows(typed.select("series_key", "series_id", "category", "date", "numeric_value")) == [
        ("federal_funds_rate", "FEDFUNDS", "interest_rates", date(2024, 1, 1), 5.33),
        ("federal_funds_rate", "FEDFUNDS", "interest_rates", date(2024, 2, 1), None),
        ("sp500_index", "SP500", "sp500", date(2024, 1, 2), 4742.83),
        ("sp500_index", "SP500", "sp500", date(2024, 1, 3), None),
        ("sp500_index", "SP500", "sp500", date(2024, 1, 4), None),
    ]
    flags = layers.silver_series(spark, str(series_folder)).filter("not is_valid").select("quality_flags")
    assert rows(flags) == [(["value_missing"],)] * 3


def test_failed_series_are_declared_but_not_available(spark, series_folder):
    payloads = bronze.read_series_payloads(spark, str(series_folder))
    assert {r.series_key for r in payloads.collect()} == {"federal_funds_rate", "treasury_2y", "sp500_index"}
    assert {r.series_key for r in clean.available_series(payloads).collect()} == {"federal_funds_rate", "sp500_index"}


def test_folder_name_becomes_category(spark, series_folder):
    points = clean.category_of_slug(bronze.read_series_batches(spark, str(series_folder)), tables.series_catalog(spark))
    assert {r.category for r in points.collect()} == {"interest_rates", "sp500"}


STAMP = "20240229_235959"
AT = datetime(2024, 2, 29, 23, 59, 59)


def test_fee_snapshots(spark, tmp_path):
    land(tmp_path, f"fees/fee_estimates_{STAMP}.json", {"1": 87.882, "1008": "N/A", "144": 1.027})
    fees = bronze.read_fee_snapshots(spark, str(tmp_path / "fees"))
    assert rows(fees) == [(AT, 1, 87.882), (AT, 1008, None), (AT, 144, 1.027)]


def test_mempool_files(spark, tmp_path):
    land(tmp_path, f"mempool/mempool_{STAMP}.json", {"count": 5, "vsize": 9, "total_fee": 11, "fee_histogram": [[53.01, 102131]]})
    land(tmp_path, f"recent/recent_transactions_{STAMP}.json", [{"txid": "a", "fee": 1, "vsize": 2, "value": 3}, {"txid": "b"}])
    states = bronze.read_mempool_snapshots(spark, str(tmp_path / "mempool"))
    assert rows(states) == [(5, 9, 11, [[53.01, 102131.0]], AT)]
    assert rows(bronze.read_mempool_txs(spark, str(tmp_path / "recent"))) == [("a", 1, 2, 3, AT), ("b", None, None, None, AT)]


def test_network_rows_round_trip_as_lines(spark, tmp_path):
    """What a reader gives is written as JSON lines and read back by the same reader."""
    land(tmp_path, f"fees/fee_estimates_{STAMP}.json", {"1": 87.882, "1008": 1.027})
    land(tmp_path, f"mempool/mempool_{STAMP}.json", {"count": 5, "vsize": 9, "total_fee": 11, "fee_histogram": [[53.01, 102131]]})
    land(tmp_path, f"blocks/recent_blocks_{STAMP}.json", [{"id": "x", "height": 7, "timestamp": 1704067200, "tx_count": 3, "size": 10}])
    land(tmp_path, f"recent/recent_transactions_{STAMP}.json", [{"txid": "a", "fee": 1, "vsize": 2, "value": 3}])
    land(tmp_path, f"txids/txids_{STAMP}.json", ["t1", "t2"])
    readers = {
        "fees": bronze.read_fee_snapshots, "mempool": bronze.read_mempool_snapshots, "blocks": bronze.read_blocks,
        "recent": bronze.read_mempool_txs, "txids": bronze.read_txid_lists,
    }
    for name, read in readers.items():
        first = read(spark, str(tmp_path / name))
        sinks.write_bronze(first, str(tmp_path / "lines" / name), ())
        again = read(spark, str(tmp_path / "lines" / name), lines=True)
        assert set(again.columns) == set(first.columns)
        assert rows(again.select(first.columns)) == rows(first) != []
    ids = bronze.read_mempool_txids(spark, str(tmp_path / "txids"))
    sinks.write_bronze(ids, str(tmp_path / "lines" / "ids"), ())
    assert rows(bronze.read_mempool_txids(spark, str(tmp_path / "lines" / "ids"), lines=True)) == rows(ids)


def test_txid_lists_and_their_sizes(spark, tmp_path):
    land(tmp_path, "txids_20240101_000000.json", [f"t{i}" for i in range(9_999)])
    land(tmp_path, "txids_20240102_000000.json", [f"t{i}" for i in range(10_000)])
    lists = bronze.read_txid_lists(spark, str(tmp_path))
    sized = clean.snapshot_sizes(lists, "txids", 10_000)
    assert rows(sized.select("snapshot_ts", "list_size", "over_limit")) == [
        (datetime(2024, 1, 1), 9_999, False), (datetime(2024, 1, 2), 10_000, True)]
    assert bronze.read_mempool_txids(spark, str(tmp_path)).count() == 19_999


def test_blocks_and_chain_tip(spark, tmp_path):
    land(tmp_path, f"list/recent_blocks_{STAMP}.json", [
        {"id": "x", "height": 7, "timestamp": 1704067200, "tx_count": 3, "size": 10, "weight": 40, "difficulty": 1.5, "extra": {}},
        {"id": "y", "height": 6, "timestamp": 1704067100, "tx_count": 2, "size": 11, "weight": 44, "difficulty": 1.5},
    ])
    blocks = bronze.read_blocks(spark, str(tmp_path / "list"))
    assert rows(blocks.select("id", "height", "block_ts")) == [
        ("x", 7, datetime(2024, 1, 1)), ("y", 6, datetime(2023, 12, 31, 23, 58, 20))]
    land(tmp_path, f"tip/current_height_{STAMP}.json", {"height": 832000, "timestamp": STAMP})
    land(tmp_path, f"tip/current_hash_{STAMP}.json", {"hash": "00ab", "timestamp": STAMP})
    land(tmp_path, "tip/current_height_20240301_000000.json", {"height": "<html>", "timestamp": "20240301_000000"})
    assert rows(bronze.read_chain_tip(spark, str(tmp_path / "tip"))) == [
        (AT, 832000, "00ab"), (datetime(2024, 3, 1), None, None)]


def test_block_details(spark, tmp_path):
    land(tmp_path, f"header/block_header_00ab_{STAMP}.json", {"header": "ff", "block_id": "00ab"})
    land(tmp_path, f"status/block_status_00ab_{STAMP}.json", {"in_best_chain": True, "height": 7, "next_best": None})
    land(tmp_path, f"txs/block_transactions_00ab_{STAMP}.json", [{"txid": "a", "fee": 1, "size": 2, "weight": 8}] * 2)
    assert rows(bronze.read_block_details(spark, str(tmp_path / "header"), "header")) == [("00ab", "ff", AT)]
    assert rows(bronze.read_block_details(spark, str(tmp_path / "status"), "status")) == [("00ab", True, 7, None, AT)]
    assert rows(bronze.read_block_details(spark, str(tmp_path / "txs"), "transactions")) == [("00ab", "a", 1, 2, 8, AT)] * 2


def test_ledger_and_what_really_landed(spark, tmp_path):
    types = ["mempool", "fee_estimates", "block_header"]
    land(tmp_path, f"collection_summary_{STAMP}.json", {
        "collection_timestamp": STAMP, "data_types_collected": types, "collection_status": "success"})
    land(tmp_path, "collection_error_20240301_000000.json", {
        "collection_timestamp": "20240301_000000", "collection_status": "failed", "error": "timeout"})
    log = bronze.read_collection_log(spark, str(tmp_path))
    assert rows(log.select("run_ts", "collection_status", "error")) == [
        (AT, "success", None), (datetime(2024, 3, 1), "failed", "timeout")]
    files = spark.createDataFrame([(STAMP, "mempool"), (STAMP, "fee_estimates")], "collection_timestamp string, data_type string")
    assert rows(quality.run_completeness(log, files)) == [(STAMP, "block_header")]
    landed = files.withColumn("n_rows", F.when(F.col("data_type") == "mempool", 4).otherwise(0))
    assert rows(sinks.collection_log(landed, types)) == [
        (STAMP, ["mempool"], "failed", "missing: fee_estimates,block_header")]


def test_broken_documents_do_not_stop_a_read(spark, tmp_path):
    land(tmp_path, "good.json", batch([price("01-01-2024", 1, "2024-03-01T10:00:00")]))
    (tmp_path / "bad.json").write_text("{ not json")
    assert bronze.read_price_batches(spark, str(tmp_path)).count() == 1


def test_batches_round_trip(spark, tmp_path):
    """Batches written here are read back by the same reader, 50 records at most."""
    days = spark.range(120).select(
        F.lit("coin").alias("coin_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("2024-06-01T00:00:00").alias("collection_timestamp"),
    )
    batches = sinks.with_batch_info(days, "coin_id", source="x")
    assert sorted(r.n for r in batches.select(F.size("records").alias("n")).collect()) == [20, 50, 50]
    document = F.struct("batch_info", F.transform("records", lambda r: F.struct(
        F.date_format(r["date"], "dd-MM-yyyy").alias("date"), F.col("coin_id"), r["collection_timestamp"].alias("collection_timestamp"))).alias("records"))
    sinks.write_documents(batches, str(tmp_path / "out"), document)
    assert bronze.read_price_batches(spark, str(tmp_path / "out")).select("date").distinct().count() == 120
    info = bronze.read_price_batch_info(spark, str(tmp_path / "out"))
    assert quality.reconcile_counts(info).count() == 0 and info.count() == 3


def test_bronze_keeps_microseconds_and_caps_files(spark, tmp_path):
    stamp = datetime(2024, 1, 1, 1, 2, 3, 456789)
    df = spark.createDataFrame([(i, stamp) for i in range(101)], "id bigint, ts timestamp_ntz").coalesce(1)
    sinks.write_bronze(df, str(tmp_path / "b"), (), max_records=50)
    back = bronze.read_json(spark, str(tmp_path / "b"), "id bigint, ts timestamp_ntz", lines=True)
    assert back.filter(F.col("ts") == F.lit(stamp).cast("timestamp_ntz")).count() == 101
    per_file = back.groupBy(bronze.file_path().alias("f")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 50


def test_table_rewrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, p string, v double")
    sinks.write_table(df, path, "p")
    sinks.write_table(df.filter("p = 'b'").withColumn("v", F.lit(9.0)), path, "p")
    assert rows(tables.read_table(spark, path).select("id", "v")) == [(1, 1.0), (2, 9.0)]


def test_success_rate_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "ok boolean")
    assert rows(stats.success_rate(empty)) == [(0, 0, None)]


GOOD = {
    "prices": batch([price("01-01-2024", 1, "2024-03-01T10:00:00")]),
    "series": {"batch_info": {"series_count": 1}, "series_data": {"sofr_rate": {"series_id": "SOFR", "data_points": [{"date": "2024-01-01", "value": "5"}]}}},
    "fees": {"1": 2.5}, "mempool": {"count": 3, "vsize": 5}, "blocks": [{"id": "a", "height": 1}, {"id": "b", "height": 2}],
    "transactions": [{"txid": "t", "fee": 1}], "txids": ["x", "y"], "tip": {"height": 7, "timestamp": "20240101_000000"},
    "header": {"header": "h", "block_id": "b"}, "status": {"in_best_chain": True}, "block_transactions": [{"txid": "t"}],
    "log": {"collection_timestamp": "20240101_000000", "collection_status": "success"},
}


@pytest.mark.parametrize("kind", sorted(GOOD))
def test_every_broken_file_is_a_reject_and_every_good_one_stays(spark, tmp_path, kind):
    land(tmp_path, "x_20240101_000000.json", GOOD[kind])
    whole, none = bronze.read_with_rejects(spark, kind, str(tmp_path))
    expected = rows(whole)
    assert expected and none.count() == 0
    text = json.dumps(GOOD[kind], indent=2)
    (tmp_path / "cut_20240102_000000.json").write_text(text[: len(text) * 2 // 3], encoding="utf-8")
    (tmp_path / "junk_20240103_000000.json").write_text("<html>not json</html>", encoding="utf-8")
    good, rejects = bronze.read_with_rejects(spark, kind, str(tmp_path))
    assert [r for r in rows(good) if r in expected] == expected
    found = {r.batch_file.rsplit("/", 1)[1].split("_")[0]: (r.reason, bool(r.document)) for r in rejects.collect()}
    assert set(found) == {"cut", "junk"} and found["junk"] == ("unreadable", True)


@pytest.mark.parametrize("kind", ["prices", "series", "tip", "log"])
def test_broken_lines_are_rejected(spark, tmp_path, kind):
    line = json.dumps(GOOD[kind])
    (tmp_path / "a_20240101_000000.json").write_text("\n".join([line, line[: len(line) // 2], "", line]), encoding="utf-8")
    good, rejects = bronze.read_with_rejects(spark, kind, str(tmp_path), lines=True)
    assert [r.reason for r in rejects.collect()] == ["unreadable"] and good.count() >= 1


def test_few_bytes_are_written_by_many_tasks(spark, tmp_path):
    """Documents that one task holds are dealt over all before each becomes a file."""
    docs = spark.range(200).coalesce(1).select(F.struct("id").alias("doc"), F.concat(F.lit("s"), "id").alias("snapshot"))
    sinks.write_documents(docs, str(tmp_path / "out"), "doc", "snapshot")
    names = [p.name for p in (tmp_path / "out").rglob("part-*")]
    assert len(names) == 200 and len({n.split("-")[1] for n in names}) > 4
