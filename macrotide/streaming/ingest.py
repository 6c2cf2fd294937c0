"""Streams over landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.operators.clean import latest_version, normalize_prices, quality_flags
from macrotide.operators.common import Names, as_list, written
from macrotide.plans.layers import price_rules
from macrotide.sources.bronze import JSON_TIME
from macrotide.sources.sinks import write_table


def stream_bronze(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", *,
    lines: bool = True, glob: str | None = None, files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows of files as they land below ``path``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("multiLine", not lines).option("timestampNTZFormat", JSON_TIME)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_event_time(df: DataFrame, ts: str) -> DataFrame:
    """A watermark needs a zoned time; zoneless times are read in the session zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedupe(df: DataFrame, keys: Names, ts: str, delay: str) -> DataFrame:
    """Drop rows landed again within ``delay`` of event time; state older than that
    is released, so it does not grow with the stream."""
    return with_event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(as_list(keys))


def stream_windows(
    df: DataFrame, ts: str, width: str, delay: str, aggs: Sequence[Column], by: Names = ()
) -> DataFrame:
    """``aggs`` per tumbling window. In append mode a window is emitted once the watermark closes
    it; in update mode its newest state comes with each micro-batch, so that ``run_merged`` has
    the open windows too. Rows later than ``delay`` are dropped."""
    timed = with_event_time(df, ts).withWatermark(ts, delay)
    grouped = timed.groupBy(F.window(ts, width).alias("_w"), *as_list(by)).agg(*aggs)
    rest = [c for c in grouped.columns if c != "_w"]
    return grouped.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest)


def stream_silver_prices(records: DataFrame) -> DataFrame:
    """Landed price records to typed, flagged rows as they land. No state and no watermark, so a
    late collection is not lost: ``run_merged`` lets the newest one stand."""
    return quality_flags(normalize_prices(records), price_rules())


def merge_versions_into(batch: DataFrame, path: str, keys: Names, order: Names, part: str, apart: Names = ()) -> None:
    """Bring rows into the Parquet table at ``path``: the folders (by the text column ``part``) that they touch are written
    anew with the newest version of each key, the others stay."""
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        touched = [r[0] for r in batch.select(part).distinct().collect()]  # folders of one micro-batch
        if not touched:
            return
        every = batch
        try:
            old = spark.read.schema(batch.schema).parquet(path)
            every = old.where(F.col(part).isin(touched)).select(batch.columns).unionByName(batch)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # of a new table there is nothing yet
                raise
        # Written aside first, as its input lies in the folders that are replaced.
        merged, _ = written(latest_version(every.distinct(), keys, order, apart))
        write_table(merged, path, part)
    finally:
        batch.unpersist()


def run_merged(
    df: DataFrame, path: str, checkpoint: str, keys: Names, order: Names, part: str, *, apart: Names = (), mode: str = "append"
) -> None:
    """Process what has landed so far into the Parquet table at ``path``, in folders by the text
    column ``part``, keeping the newest version of each key (rows with a null ``apart`` key each
    stay). A micro-batch rewrites the folders it touches and no others, so the work follows what
    has landed; a batch that is run again changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_versions_into(batch, path, keys, order, part, apart)

    query = (
        df.writeStream.foreachBatch(merge).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has landed so far into Parquet at ``out``, then stop. Files and
    state are tracked at ``checkpoint``, so the next run takes up where this one ended,
    also after a failure."""
    query = (
        df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
