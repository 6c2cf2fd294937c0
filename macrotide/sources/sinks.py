"""Writers: raw landing files, batch envelopes, typed tables, run ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions import format_day
from macrotide.functions.time import DAY_FIRST
from macrotide.operators.common import Names, as_list, by_key

# Fixed value: records per landed price batch.
BATCH_RECORDS = 50
# Spark's own default drops microseconds.
JSON_TIME_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_bronze(
    df: DataFrame, path: str, partition_cols: Names = ("source", "category"), max_records: int | None = None, mode: str = "append"
) -> None:
    """Land rows as JSON lines in ``source=/category=`` folders.

    ``rebalance`` gives each folder few files of even size and splits a folder that
    holds much more than the others over several tasks.
    """
    cols = as_list(partition_cols)
    writer = (df.hint("rebalance", *cols) if cols else df).write.mode(mode).option("timestampNTZFormat", JSON_TIME_OUT)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    (writer.partitionBy(*cols) if cols else writer).json(path)


def write_documents(df: DataFrame, path: str, document: Column | str, folder: Names = (), mode: str = "append") -> None:
    """Land one pretty-printed JSON document per file, as collectors do. ``document`` is
    a struct, map or array column; ``folder`` columns become ``name=value`` folders.

    The work is in the files, not in their bytes, so documents are dealt evenly over the shuffle partitions: a given number,
    which adaptive execution does not merge into the few tasks that would do for the bytes."""
    cols = as_list(folder)
    body = F.col(document) if isinstance(document, str) else document
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*cols, body.alias("_document")).repartition(tasks)
    texts = dealt.select(*cols, F.to_json("_document", {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
    writer = texts.write.mode(mode).option("maxRecordsPerFile", 1)
    (writer.partitionBy(*cols) if cols else writer).text(path)


def write_table(df: DataFrame, path: str, partition_cols: Names = (), sort_cols: Names = ()) -> None:
    """Write a silver or gold table as Parquet. With partition columns only the
    partitions present in ``df`` are replaced, so a rerun gives the same table. Rows
    sorted by ``sort_cols`` inside each file let later filters skip row groups."""
    cols = as_list(partition_cols)
    even = balanced(df, cols, sort_cols)
    if not cols:
        even.write.mode("overwrite").parquet(path)
        return
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: Names, sort_cols: Names = (), buckets: int = 64, path: str | None = None) -> DataFrame:
    """Write ``df`` as the catalogue's table ``name``, hashed by ``key`` into ``buckets`` files, each sorted by key and ``sort_cols``.
    Windows by the key, aggregates by it and joins with a table of as many buckets need no exchange then. A key
    lies in one file, so this is for day grain or keys of even size. ``path`` is where an external table lies; without it
    the table is in the warehouse. A table of that name is replaced."""
    keys = as_list(key)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS `{name}`")
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, *as_list(sort_cols))
    (writer.option("path", path) if path else writer).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def balanced(df: DataFrame, partition_cols: Names = (), sort_cols: Names = ()) -> DataFrame:
    """``df`` with even tasks for each partition, sorted inside."""
    cols, order = as_list(partition_cols), as_list(sort_cols)
    even = df.hint("rebalance", *cols) if cols else df
    return even.sortWithinPartitions(*cols, *order) if order else even


def with_batch_info(df: DataFrame, key: Names, order: str = "date", max_records: int = BATCH_RECORDS, source: str | None = None) -> DataFrame:
    """Group records into batches of ``max_records`` consecutive days per key: one row
    per batch with ``batch_info`` and ``records``. A batch never holds more, so its list
    is bounded. ``collection_timestamp`` must be a column."""
    keys = as_list(key)
    number = F.row_number().over(by_key(keys, order)) - 1
    placed = df.withColumn("_batch", F.floor(number / max_records))
    record = F.struct(order, *[c for c in df.columns if c != order])
    grouped = placed.groupBy(*keys, "_batch").agg(
        F.max("collection_timestamp").alias("_collected"), F.min(order).alias("_first"), F.max(order).alias("_last"),
        F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(record)).alias("records"),
    )
    info = F.struct(
        F.col("_collected").alias("collection_timestamp"),
        format_day("_first", DAY_FIRST).alias("first_date"), format_day("_last", DAY_FIRST).alias("last_date"),
        F.col("_n").alias("record_count"), F.lit(source).alias("api_source"),
    )
    return grouped.select(*keys, F.col("_batch").alias("batch_no"), info.alias("batch_info"), "records")


def collection_log(landed: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Ledger rows from what landed: (collection_timestamp, data_type, n_rows) in, one
    row per run out. The status is derived: ``success`` only if every expected type has
    rows, else ``failed`` with the missing types as error text."""
    seen = [F.max((F.col("data_type") == t) & (F.col("n_rows") > 0)).alias(f"_has_{i}") for i, t in enumerate(expected)]
    runs = landed.groupBy("collection_timestamp").agg(*seen)

    def names(present: bool) -> Column:
        picked = [
            F.when(F.coalesce(F.col(f"_has_{i}"), F.lit(False)) == present, F.lit(t)) for i, t in enumerate(expected)
        ]
        return F.array_compact(F.array(*picked))

    lacking = names(False)
    return runs.select(
        "collection_timestamp", names(True).alias("data_types_collected"),
        F.when(F.size(lacking) == 0, "success").otherwise("failed").alias("collection_status"),
        F.when(F.size(lacking) > 0, F.concat(F.lit("missing: "), F.array_join(lacking, ","))).alias("error"),
    )


def write_collection_log(landed: DataFrame, path: str, expected: Sequence[str]) -> None:
    collection_log(landed, expected).write.mode("append").json(path)
