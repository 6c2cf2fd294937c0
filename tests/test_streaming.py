"""Streams: late rows, duplicates, restarts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from macrotide.sources.sinks import write_bronze
from macrotide.streaming import run_available, stream_bronze, stream_dedupe, stream_windows
from tests.conftest import rows

SCHEMA = "id bigint, ts timestamp_ntz, v double"
T0 = datetime(2024, 1, 1)


def land(spark, path, *points):
    df = spark.createDataFrame([(i, T0 + timedelta(minutes=m), float(i)) for i, m in points], SCHEMA).coalesce(1)
    write_bronze(df, path, ())


def test_new_files_are_picked_up_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land(spark, src, (1, 0), (2, 1))
    for more in ((3, 2), None):
        run_available(stream_bronze(spark, src, SCHEMA), out, state)
        if more:
            land(spark, src, more)
    assert [r[0] for r in rows(spark.read.parquet(out))] == [1, 2, 3]


def test_duplicates_across_runs_are_dropped(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land(spark, src, (1, 0), (2, 1))
    run_available(stream_dedupe(stream_bronze(spark, src, SCHEMA), "id", "ts", "1 day"), out, state)
    land(spark, src, (2, 1), (3, 2))
    run_available(stream_dedupe(stream_bronze(spark, src, SCHEMA), "id", "ts", "1 day"), out, state)
    assert [r[0] for r in rows(spark.read.parquet(out).select("id"))] == [1, 2, 3]


def test_windows_close_behind_the_watermark_and_drop_late_rows(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))

    def run():
        stream = stream_bronze(spark, src, SCHEMA)
        aggs = [F.count(F.lit(1)).alias("n")]
        run_available(stream_windows(stream, "ts", "1 hour", "30 minutes", aggs), out, state)
        found = spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz"), "n")
        return rows(found)

    land(spark, src, (1, 5), (2, 10), (3, 65))
    assert run() == []
    land(spark, src, (4, 95))
    assert run() == [(T0, 2)]
    land(spark, src, (5, 20), (6, 70), (7, 200))
    closed = [(T0, 2), (T0 + timedelta(hours=1), 3)]
    assert run() == closed, "the row at minute 20 came after its window had closed"


def test_stream_windows_equal_batch(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    points = [(i, (i * 37) % 600) for i in range(200)]
    land(spark, src, *points)
    stream = stream_windows(stream_bronze(spark, src, SCHEMA), "ts", "1 hour", "1 hour", [F.sum("v").alias("s")])
    run_available(stream, out, state)
    newest = max(m for _, m in points)
    batch = {}
    for i, m in points:
        batch[m // 60] = batch.get(m // 60, 0.0) + i
    expected = [(T0 + timedelta(hours=h), s) for h, s in batch.items() if (h + 1) * 60 <= newest - 60]
    found = spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz"), "s")
    assert rows(found) == sorted(expected)
