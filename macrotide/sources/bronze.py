"""Readers of landed JSON.

Files hold one pretty-printed document each, so a file is the unit of parallel work.
``lines=True`` reads the one-document-per-line form that ``write_bronze`` produces,
which Spark can split inside a file. Times of network snapshots come from file or
folder names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions import from_epoch, parse_snapshot, safe_double, safe_long
from macrotide.session import scratch_dir
from macrotide.sources import schemas

Paths = str | list[str]
Rows = Callable[[DataFrame], DataFrame]

# Spark's own default keeps milliseconds only.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_json(spark: SparkSession, path: Paths, schema: str, lines: bool = False) -> DataFrame:
    """Documents (or the elements of a top-level array) as rows of ``schema``."""
    reader = spark.read.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True)
    return reader.option("timestampNTZFormat", JSON_TIME).json(path)


def read_text(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """Whole documents (or lines) as text, for JSON whose top level is a map or a list of values."""
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=not lines)


def file_path() -> Column:
    return F.col("_metadata.file_path")


# Documents that cannot be read ------------------------------------------------------
#
# A plain read gives nothing for a file that is cut off. ``read_checked`` keeps each document's text
# where it does not parse, so that one read gives the rows and the rejects.

CORRUPT, BATCH_FILE = "_corrupt", "batch_file"
_STATUS = "_status"


def read_checked(
    spark: SparkSession, path: Paths, schema: str | None, parse: str | None = None, lines: bool = False, kept: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(documents with their ``batch_file``, rejects) of one read.

    A reject is a row (batch_file, reason, document): ``unreadable`` if it is no JSON or nothing of
    it could be read, ``partly`` if it is JSON (of 16 MB at most) with a field that does not fit its type; the fields
    that do fit are among the documents too. With ``parse``, documents
    are read as text into the column ``value`` and are rejected where it does not parse as that type. Both frames come from
    a table at ``kept`` (by default in the shared folder) that is written here, so the files are parsed
    once. A file without any text is no document."""
    fields = spark.createDataFrame([], schema).columns if schema else []
    if schema:
        reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("multiLine", not lines).option("recursiveFileLookup", True)
        read = reader.option("columnNameOfCorruptRecord", CORRUPT).option("timestampNTZFormat", JSON_TIME).json(path)
        nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in fields])
        # Of a document that is cut off the parser may have some fields already, depending on where it ends.
        no_json = F.try_parse_json(CORRUPT).isNull()
        bad = F.when(F.col(CORRUPT).isNotNull(), F.when(nothing | no_json, "unreadable").otherwise("partly"))
    else:
        read = read_text(spark, path, lines).filter(F.col("value").rlike(r"\S")).withColumn(CORRUPT, F.col("value"))
        bad, fields = F.when(F.from_json("value", parse).isNull(), "unreadable"), ["value"]
    checked = read.select(*fields, CORRUPT, file_path().alias(BATCH_FILE), F.coalesce(bad, F.lit("good")).alias(_STATUS))
    kept = kept or scratch_dir(spark, "checked")
    checked.withColumn(CORRUPT, F.when(F.col(_STATUS) != "good", F.col(CORRUPT))).write.mode("append").partitionBy(_STATUS).parquet(kept)
    stored = spark.read.schema(checked.schema).parquet(kept)
    good = stored.filter(F.col(_STATUS) != "unreadable").select(*fields, BATCH_FILE)
    rejects = stored.filter(F.col(_STATUS) != "good").select(BATCH_FILE, F.col(_STATUS).alias("reason"), F.col(CORRUPT).alias("document"))
    return good, rejects


def with_snapshot_ts(df: DataFrame, path: Column | str | None = None, into: str = "snapshot_ts") -> DataFrame:
    """Snapshot time from the last ``yyyyMMdd_HHmmss`` in the file's path; null if none."""
    where = file_path() if path is None else F.col(path) if isinstance(path, str) else path
    stamp = F.regexp_extract(where, r"(\d{8}_\d{6})(?!.*\d{8}_\d{6})", 1)
    return df.withColumn(into, parse_snapshot(stamp))


def parse_props(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Typed fields of a JSON text column, in place of the column."""
    parsed = df.withColumn("_parsed", F.from_json(col, schema))
    return parsed.select(*[c for c in df.columns if c != col], "_parsed.*")


# Prices ----------------------------------------------------------------------

def read_price_batches(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per (asset, day, collection)."""
    return price_records(read_json(spark, path, schemas.PRICE_BATCH, lines))


def price_records(batches: DataFrame) -> DataFrame:
    """The records of price documents, of a batch or a stream."""
    return batches.select(F.inline("records")).select(
        F.col("coin_id").alias("asset_id"), "date", "collection_timestamp",
        F.col("raw_data.market_data").alias("market_data"),
    )


def read_price_batch_info(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per batch: what it declares and how many records it holds."""
    raw = read_json(spark, path, schemas.PRICE_BATCH, lines)
    return price_batch_info(raw.withColumn(BATCH_FILE, file_path()))


def price_batch_info(batches: DataFrame) -> DataFrame:
    return batches.select(
        BATCH_FILE,
        F.col("batch_info.first_date").alias("first_date"), F.col("batch_info.last_date").alias("last_date"),
        F.col("batch_info.record_count").alias("declared_count"),
        F.coalesce(F.size("records"), F.lit(0)).cast("bigint").alias("actual_count"),
    )


# Economic series --------------------------------------------------------------

def read_series_payloads(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per (batch, series); ``payload`` is null for a series that failed. Run
    summaries, which repeat every batch, carry no ``series_data`` and give no rows."""
    return series_payloads(read_json(spark, path, schemas.SERIES_BATCH, lines).withColumn(BATCH_FILE, file_path()))


def series_payloads(batches: DataFrame) -> DataFrame:
    """The payloads of series documents, of a batch or a stream."""
    return batches.select(
        BATCH_FILE,
        F.col("batch_info.collection_timestamp").alias("collection_timestamp"),
        F.col("batch_info.category").alias("category"),
        F.col("batch_info.series_count").alias("series_count"),
        F.explode("series_data").alias("series_key", "payload"),
    )


def read_series_batches(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per (series, date, collection); failed series give none."""
    return series_points(read_series_payloads(spark, path, lines))


def series_points(payloads: DataFrame) -> DataFrame:
    payloads = payloads.filter(F.col("payload").isNotNull())
    points = payloads.select(
        "series_key", F.col("payload.series_id").alias("series_id"), "category", "collection_timestamp",
        F.explode("payload.data_points").alias("_point"),
    )
    return points.select("series_key", "series_id", "category", "_point.date", "_point.value", "collection_timestamp")


def read_series_counts(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """Declared and actual points of each landed series."""
    payloads = read_series_payloads(spark, path, lines).filter(F.col("payload").isNotNull())
    return payloads.select(
        "batch_file", "series_key", F.col("payload.count").alias("declared_count"),
        F.coalesce(F.size("payload.data_points"), F.lit(0)).cast("bigint").alias("actual_count"),
    )


# Network snapshots -------------------------------------------------------------
#
# A landed snapshot is one document, which is one task and has its time in its path. With
# ``lines=True`` the same readers take what ``write_bronze`` makes of their rows: one row for each
# line, with the time as the column ``snapshot_ts``, which Spark can split inside a file.

_AT = "snapshot_ts timestamp_ntz"


def read_fee_snapshots(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per (snapshot, confirmation target). Amounts are read as text, because
    one bad number would otherwise void the whole map."""
    if lines:
        return read_json(spark, path, f"{_AT}, target int, fee_rate double", True)
    return fee_rates(read_text(spark, path).withColumn(BATCH_FILE, file_path()))


def fee_rates(texts: DataFrame) -> DataFrame:
    raw = with_snapshot_ts(texts, BATCH_FILE)
    rates = raw.select("snapshot_ts", F.explode(F.from_json("value", "map<string,string>")).alias("_target", "_rate"))
    return rates.select(
        "snapshot_ts", F.col("_target").try_cast("int").alias("target"), safe_double("_rate").alias("fee_rate")
    )


def read_mempool_snapshots(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    if lines:
        return read_json(spark, path, f"{schemas.MEMPOOL}, {_AT}", True)
    return snapshot_rows(read_json(spark, path, schemas.MEMPOOL).withColumn(BATCH_FILE, file_path()))


def snapshot_rows(documents: DataFrame) -> DataFrame:
    """Documents that are rows themselves, with the time in their path."""
    return with_snapshot_ts(documents, BATCH_FILE).drop(BATCH_FILE)


def read_blocks(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per listed block, with its time as ``block_ts``."""
    if lines:
        columns = schemas.BLOCK.replace(" timestamp bigint,", "")
        return read_json(spark, path, f"{columns}, {_AT}, block_ts timestamp_ntz", True)
    return block_rows(read_json(spark, path, schemas.BLOCK).withColumn(BATCH_FILE, file_path()))


def block_rows(documents: DataFrame) -> DataFrame:
    blocks = snapshot_rows(documents)
    return blocks.withColumn("block_ts", from_epoch("timestamp")).drop("timestamp")


def read_mempool_txs(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    if lines:
        return read_json(spark, path, f"{schemas.MEMPOOL_TX}, {_AT}", True)
    return snapshot_rows(read_json(spark, path, schemas.MEMPOOL_TX).withColumn(BATCH_FILE, file_path()))


def read_txid_lists(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per snapshot with its whole list."""
    if lines:
        return read_json(spark, path, f"{_AT}, txids array<string>", True)
    return txid_rows(read_text(spark, path).withColumn(BATCH_FILE, file_path()))


def txid_rows(texts: DataFrame) -> DataFrame:
    raw = with_snapshot_ts(texts, BATCH_FILE)
    return raw.select("snapshot_ts", F.from_json("value", "array<string>").alias("txids"))


def read_mempool_txids(spark: SparkSession, path: Paths, lines: bool = False) -> DataFrame:
    """One row per (snapshot, transaction id)."""
    if lines:
        return read_json(spark, path, f"{_AT}, txid string", True)
    return read_txid_lists(spark, path).select("snapshot_ts", F.explode("txids").alias("txid"))


def read_chain_tip(spark: SparkSession, path: Paths) -> DataFrame:
    """Height and hash of each snapshot. They land in two files with one time stamp;
    one grouped scan brings them together and keeps a snapshot that has only one."""
    return chain_tips(read_json(spark, path, schemas.CHAIN_TIP))


def chain_tips(documents: DataFrame) -> DataFrame:
    raw = documents.filter(F.col("timestamp").isNotNull())
    tips = raw.groupBy("timestamp").agg(F.max(safe_long("height")).alias("height"), F.max("hash").alias("hash"))
    return tips.select(parse_snapshot("timestamp").alias("snapshot_ts"), "height", "hash")


_DETAILS = {
    "header": schemas.BLOCK_HEADER,
    "status": schemas.BLOCK_STATUS,
    "transactions": schemas.BLOCK_TX,
}


def read_block_details(spark: SparkSession, path: Paths, kind: str) -> DataFrame:
    """Header, status or transactions of blocks. A header names its block; for the
    others the id is in the file or folder name."""
    return block_details(read_json(spark, path, _DETAILS[kind]).withColumn(BATCH_FILE, file_path()), kind)


def block_details(documents: DataFrame, kind: str) -> DataFrame:
    details = with_snapshot_ts(documents, BATCH_FILE)
    if kind == "header":
        return details.select("block_id", "header", "snapshot_ts")
    named = F.regexp_extract(BATCH_FILE, rf"block_{kind}_(.+)_\d{{8}}_\d{{6}}", 1)
    return details.select(named.alias("block_id"), *[c for c in details.columns if c != BATCH_FILE])


def read_collection_log(spark: SparkSession, path: Paths) -> DataFrame:
    """Run ledger; success and failure files share one schema."""
    return ledger_rows(read_json(spark, path, schemas.COLLECTION_LOG))


def ledger_rows(log: DataFrame) -> DataFrame:
    return log.withColumn("run_ts", parse_snapshot("collection_timestamp"))


# All kinds, checked ---------------------------------------------------------------

# Each kind's document schema (None: its top level is a map or a list, read as the second text type) and its rows.
KINDS: dict[str, tuple[str | None, str | None, Rows]] = {
    "prices": (schemas.PRICE_BATCH, None, price_records),
    "series": (schemas.SERIES_BATCH, None, lambda d: series_points(series_payloads(d))),
    "fees": (None, "map<string,string>", fee_rates),
    "mempool": (schemas.MEMPOOL, None, snapshot_rows),
    "blocks": (schemas.BLOCK, None, block_rows),
    "transactions": (schemas.MEMPOOL_TX, None, snapshot_rows),
    "txids": (None, "array<string>", txid_rows),
    "tip": (schemas.CHAIN_TIP, None, chain_tips),
    "header": (schemas.BLOCK_HEADER, None, lambda d: block_details(d, "header")),
    "status": (schemas.BLOCK_STATUS, None, lambda d: block_details(d, "status")),
    "block_transactions": (schemas.BLOCK_TX, None, lambda d: block_details(d, "transactions")),
    "log": (schemas.COLLECTION_LOG, None, ledger_rows),
}
# Kinds whose rows need a time: in the document, or in the path.
_TIMED = {"fees", "mempool", "blocks", "transactions", "txids", "header", "status", "block_transactions"}


def read_with_rejects(spark: SparkSession, kind: str, path: Paths, lines: bool = False, kept: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of one kind of documents, rejects), as ``read_checked``; a document without a readable time is rejected as
    ``untimed``, and its rows, if the kind keeps them, have none. ``lines`` reads one document a line."""
    schema, parse, rows = KINDS[kind]
    good, rejects = read_checked(spark, path, schema, parse, lines, kept)
    if kind in _TIMED or kind == "tip":
        at = with_snapshot_ts(good, BATCH_FILE, "_at") if kind in _TIMED else good.withColumn("_at", parse_snapshot("timestamp"))
        body = F.col("value") if schema is None else F.to_json(F.struct(*[c for c in good.columns if c != BATCH_FILE]))
        untimed = at.filter(F.col("_at").isNull()).select(BATCH_FILE, F.lit("untimed").alias("reason"), body.alias("document"))
        rejects = rejects.unionByName(untimed)
    return rows(good), rejects


def reject_counts(rejects: dict[str, DataFrame]) -> DataFrame:
    """Rejected documents of each kind by reason: rows (kind, reason, n_documents)."""
    parts = [df.select(F.lit(kind).alias("kind"), "reason") for kind, df in rejects.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n_documents"))
