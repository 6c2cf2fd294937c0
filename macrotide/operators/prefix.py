"""Running values over series of any length: a prefix scan over range partitions.

A window gathers a key in one task. Here rows are dealt by ranges of (key, time) into pieces of
even size, whatever the keys, and each piece runs its own window. Only a key that crosses from one
piece into the next needs more: the closing values of its pieces, one row for each piece, are summed up
in order and carried into the pieces after them. Without a key the whole table is one series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macrotide.operators.clean import LOWEST
from macrotide.operators.common import Names, as_list
from macrotide.session import scratch_dir

_SPREAD_PIECES = 10_000


@dataclass(frozen=True)
class Running:
    """A running value: ``last`` (of the non-null ones), ``max``, ``min``, ``sum`` or ``count`` of ``value``."""

    kind: str
    value: Column | str

    def over(self, window) -> Column:
        value = F.col(self.value) if isinstance(self.value, str) else self.value
        if self.kind == "last":
            return F.last(value, ignorenulls=True).over(window)
        return {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}[self.kind](value).over(window)


def _joined(kind: str, carried: Column, inside: Column) -> Column:
    """The value carried into a piece with the one inside it."""
    if kind == "last":
        return F.coalesce(inside, carried)
    if kind in ("max", "min"):
        return (F.greatest if kind == "max" else F.least)(inside, carried)
    both = F.coalesce(inside, F.lit(0)) + F.coalesce(carried, F.lit(0))
    return both if kind == "count" else F.when(inside.isNotNull() | carried.isNotNull(), both)


@cache
def _places(spark: SparkSession, pieces: int) -> list[int]:
    """For each of so many pieces a number that a hash exchange of as many partitions takes to a
    partition of its own."""
    numbers = spark.range(40 * pieces).select(F.col("id").cast("int")).groupBy(F.pmod(F.hash("id"), F.lit(pieces)).alias("place")).agg(F.min("id").alias("id"))
    found = dict(numbers.collect())
    return [found.get(k, k) for k in range(pieces)]


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int) -> DataFrame:
    """``df`` as a table whose ``_piece`` numbers are ranges of (key, order)."""
    path = scratch_dir(df.sparkSession, "prefix-scan")
    ranged = df.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id())
    ranged.write.parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def _crossing(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a piece ends with and a later one begins with: fewer than there are pieces."""
    whole = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    ends = table.groupBy("_piece").agg(F.min(whole).alias("_first"), F.max(whole).alias("_last"), F.count_if(whole.isNull()).alias("_nulls"))
    after = Window.orderBy("_piece")  # a row for each piece
    ends = ends.withColumns({"_next": F.lead("_first").over(after), "_next_nulls": F.lead("_nulls").over(after)})
    # min and max pass over a null key; nulls come first, so it crosses if the next piece has some.
    nulls = (F.col("_nulls") > 0) & (F.col("_next_nulls") > 0)
    crossing = F.array_compact(F.array(
        F.when(F.col("_last") == F.col("_next"), F.struct(F.col("_last").alias("key"))),
        F.when(nulls, F.struct(F.lit(None).cast(ends.schema["_last"].dataType).alias("key"))),
    ))
    found = ends.select(F.explode(crossing).alias("_c")).select("_c.key").distinct()
    return found.select(*[F.col("key" if len(keys) == 1 else f"key.{k}").alias(f"_k_{k}") for k in keys])


def _carried(table: DataFrame, keys: list[str], order: list[str], running: Mapping[str, Running]) -> DataFrame:
    """For each piece of a key that crosses pieces, the running values of the pieces before it."""
    rows = table
    if keys:
        crossing = _crossing(table, keys)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        # Broadcast whatever the sizes: a shuffle would gather each crossing key, the largest ones, in one task.
        rows = table.join(F.broadcast(crossing), same, "left_semi")
    kind = table.schema[order[0]].dataType.simpleString()
    # A bare column of fixed width keeps max_by in a hash aggregate; rows without a time are the first.
    at = F.coalesce(F.col(order[0]), F.expr(LOWEST[kind])) if len(order) == 1 and kind in LOWEST else F.struct(*order)
    closing = []
    for name, own in running.items():
        value = F.col(own.value) if isinstance(own.value, str) else own.value
        if own.kind == "last":
            closing.append(F.max_by(value, F.when(value.isNotNull(), at)).alias(f"_end_{name}"))
        else:
            closing.append({"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}[own.kind](value).alias(f"_end_{name}"))
    ends = rows.groupBy(*keys, "_piece").agg(*closing)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    as_sums = {name: "sum" if own.kind == "count" else own.kind for name, own in running.items()}
    return ends.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_piece").alias("_at_piece"),
        *[Running(kind, f"_end_{name}").over(before).alias(f"_carry_{name}") for name, kind in as_sums.items()],
    )


def prefix_scan(
    df: DataFrame, key: Names | None, order: Names, running: Mapping[str, Running], pieces: int | None = None
) -> DataFrame:
    """``df`` with a column for each of ``running``: its value over the rows of the key up to each row, in
    ``order`` (nulls first). Rows of equal order stay together, in one piece and in either order; without
    ``key`` all rows are one series. An empty table stays empty.

    The input is shuffled once by range (Spark samples it for the borders) and written to the shared folder, so all
    passes see the same pieces; then each piece goes to a partition of its own. ``pieces`` is the
    number of shuffle partitions unless given."""
    keys, order = as_list(key or []), as_list(order)
    spark = df.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _dealt(df, keys, order, pieces)
    carried = _carried(table, keys, order, running)
    path = scratch_dir(spark, "prefix-carry")
    carried.write.parquet(path)  # its bytes are known then, so that it is broadcast only while small
    carried = spark.read.schema(carried.schema).parquet(path)

    place = F.lit(_places(spark, pieces))[F.col("_piece")] if pieces <= _SPREAD_PIECES else F.col("_piece")
    placed = table.withColumn("_place", F.coalesce(place, F.col("_piece"))).repartition(pieces, "_place")
    inside = Window.partitionBy(*keys, "_place", "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = placed.withColumns({f"_in_{name}": own.over(inside) for name, own in running.items()})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_piece") == F.col("_at_piece"))
    joined = scanned.join(carried, same, "left")
    found = {name: _joined(own.kind, F.col(f"_carry_{name}"), F.col(f"_in_{name}")) for name, own in running.items()}
    return joined.select(
        *[found[c].alias(c) if c in found else F.col(c) for c in df.columns],
        *[c.alias(name) for name, c in found.items() if name not in df.columns],
    )
