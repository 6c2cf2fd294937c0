"""One stream over folders of mixed documents, routed to a silver table for each kind.

A file is one document, which arrives as text with its path. Each micro-batch is read once and sorted out by route: a route
takes the documents whose path names its kind. After the last micro-batch each route types what it took and merges it
into its table once. Micro-batches and merges that are run again change nothing. Documents that no route takes, or that
cannot be read, go to a table of rejects.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.operators.clean import normalize_prices, quality_flags, typed_points, with_series_meta
from macrotide.operators.common import Names
from macrotide.plans.layers import gold_network, price_rules, series_rules
from macrotide.sources import bronze, schemas
from macrotide.sources.tables import series_catalog
from macrotide.streaming.ingest import merge_versions_into

PART = "part"


@dataclass(frozen=True)
class Route:
    """How documents of one kind become rows of its table: ``pattern`` of their paths, their JSON type, their rows, the key of
    a row and the order of its versions, and the text column of its folders."""

    pattern: str
    document: str
    rows: Callable[[DataFrame], DataFrame]
    keys: Names
    order: Names
    part: Callable[[], Column]
    apart: Names = ()


def _year(col: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.year(col).cast("string"), F.lit("none"))


def _day(col: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.date_format(col, "yyyy-MM-dd"), F.lit("none"))


def _month(col: str) -> Callable[[], Column]:
    return lambda: F.coalesce(F.date_format(col, "yyyy-MM"), F.lit("none"))


def _elements(rows: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """For documents that are one object or a list of them."""
    return lambda docs: rows(docs.select(F.inline("document"), bronze.BATCH_FILE))


def _prices(docs: DataFrame) -> DataFrame:
    return quality_flags(normalize_prices(bronze.price_records(docs)), price_rules())


def _series(docs: DataFrame) -> DataFrame:
    points = typed_points(bronze.series_points(bronze.series_payloads(docs)))
    return quality_flags(with_series_meta(points, series_catalog(docs.sparkSession)), series_rules())


def _value(rows: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """For documents that are read as text further on."""
    return lambda docs: rows(docs.select("value", bronze.BATCH_FILE))


# A snapshot that lands twice is the same snapshot; of two that differ the larger one stands.
ROUTES: dict[str, Route] = {
    "prices": Route(r"/prices/", f"array<struct<{schemas.PRICE_BATCH}>>", _elements(_prices), ["asset_id", "date"], "collection_timestamp", _year("date"), "date"),
    "series": Route(r"/series/", f"array<struct<{schemas.SERIES_BATCH}>>", _elements(_series), ["series_key", "date"], "collection_timestamp", _year("date"), "date"),
    "fees": Route(r"fee_estimates_", "map<string,string>", _value(bronze.fee_rates), ["snapshot_ts", "target"], "fee_rate", _day("snapshot_ts"), "snapshot_ts"),
    "mempool": Route(r"[/=]mempool_\d", f"array<struct<{schemas.MEMPOOL}>>", _elements(bronze.snapshot_rows), "snapshot_ts", ["count", "vsize", "total_fee"], _day("snapshot_ts"), "snapshot_ts"),
    "blocks": Route(r"recent_blocks_", f"array<struct<{schemas.BLOCK}>>", _elements(bronze.block_rows), "id", "snapshot_ts", _month("block_ts")),
}


def stream_documents(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Whole files below ``path`` as they land: (value, batch_file)."""
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("value", bronze.file_path().alias(bronze.BATCH_FILE))


def table_path(root: str, kind: str) -> str:
    return f"{root}/{kind}"


_LANDED = f"value string, {bronze.BATCH_FILE} string, reason string, kind string"
_REJECTED = "rejected"


def _sorted_out(documents: DataFrame, routes: Mapping[str, Route]) -> DataFrame:
    """A row for each document and route that takes it: ``kind`` is the route's, or ``rejected`` with a ``reason``."""
    taken = F.array_compact(F.array(*[
        F.when(F.col(bronze.BATCH_FILE).rlike(r.pattern), F.struct(F.lit(kind).alias("kind"), F.from_json("value", r.document).isNull().alias("bad")))
        for kind, r in routes.items()
    ]))
    found = documents.filter(F.col("value").rlike(r"\S")).select("value", bronze.BATCH_FILE, F.explode_outer(taken).alias("_r"))
    reason = F.when(F.col("_r").isNull(), "unknown").when(F.col("_r.bad"), "unreadable")
    return found.withColumn("reason", reason).select(
        "value", bronze.BATCH_FILE, "reason", F.when(F.col("reason").isNull(), F.col("_r.kind")).otherwise(_REJECTED).alias("kind")
    )


def _merge_landed(spark: SparkSession, root: str, checkpoint: str, routes: Mapping[str, Route]) -> None:
    """Bring the landed micro-batches that are in no table yet into the tables, all at once."""
    done = f"{checkpoint}/merged"
    try:
        last = spark.read.schema("batch bigint").parquet(done).agg(F.max("batch")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    try:
        landed = spark.read.schema(f"{_LANDED}, batch bigint").parquet(f"{checkpoint}/landed")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # nothing has landed yet
            raise
        return
    new = landed.filter(F.col("batch") > (-1 if last is None else last))
    newest = new.agg(F.max("batch")).first()[0]
    if newest is None:
        return
    for kind, route in routes.items():
        read = new.filter(F.col("kind") == kind).withColumn("document", F.from_json("value", route.document))
        rows = route.rows(read).withColumn(PART, route.part())
        merge_versions_into(rows, table_path(root, kind), route.keys, route.order, PART, route.apart)
    # Merged again after a failure before this, they change nothing.
    spark.range(newest, newest + 1).toDF("batch").write.mode("append").parquet(done)


def run_routed(
    documents: DataFrame, root: str, checkpoint: str, routes: Mapping[str, Route] = ROUTES
) -> None:
    """Bring what has landed so far into the silver tables below ``root``, one for each route, and the rejects (batch_file,
    reason, document: ``unknown`` path or ``unreadable``) into ``root``/rejects. Blank files are no documents.

    A micro-batch only sorts its documents out by route, into a folder of its own below the checkpoint; they stay there.
    The tables are merged once, after the last of them: a table's folders are written once a run, not once for each
    micro-batch. What a failed run has landed is merged by the next one."""
    spark = documents.sparkSession

    def bring(batch: DataFrame, number: int) -> None:
        # A folder for each micro-batch: run again, it is written again.
        folder = f"{checkpoint}/landed/batch={number}"
        _sorted_out(batch, routes).write.mode("overwrite").partitionBy("kind").parquet(folder)
        rejects = batch.sparkSession.read.schema(_LANDED).parquet(folder).filter(F.col("kind") == _REJECTED)
        rejects.select(bronze.BATCH_FILE, "reason", F.col("value").alias("document")).write.mode("overwrite").parquet(
            f"{table_path(root, 'rejects')}/batch={number}"
        )

    query = (
        documents.writeStream.foreachBatch(bring).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    _merge_landed(spark, root, checkpoint, routes)


def routed_table(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.parquet(table_path(root, kind)).drop(PART)


def routed_network(spark: SparkSession, root: str, **settings) -> DataFrame:
    """``gold_network`` over the routed silver tables."""
    return gold_network(*(routed_table(spark, root, kind) for kind in ("blocks", "fees", "mempool")), **settings)
