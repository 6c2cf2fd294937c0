"""Checks on the way to a table: one pass counts what breaks the rules, and a gate keeps bad data out.

The rows are written aside first and the row rules are counted on the tasks that write them, by ``observe``, so the
input is read once whatever the number of rules. Rules over several rows (unique keys, parents) then read only
their key columns of what was written. Only if nothing fails are the partitions of the table replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from macrotide.functions import seconds_between
from macrotide.operators.common import Names, as_list
from macrotide.operators.joins import orphans
from macrotide.operators.quality import check_unique
from macrotide.session import scratch_dir
from macrotide.sources.sinks import balanced, write_table


@dataclass(frozen=True)
class Rule:
    """A check that one aggregate decides: ``failing`` is how many rows (or tables) break it."""

    name: str
    failing: Column


@dataclass(frozen=True)
class Unique:
    """No two rows of one key. Fails by keys that are held more than once."""

    name: str
    keys: Names

    def failing_rows(self, table: DataFrame) -> DataFrame:
        return check_unique(table, self.keys)


@dataclass(frozen=True)
class HasParent:
    """Every key that is set has a row of ``parent``. Fails by rows."""

    name: str
    fk: str
    parent: DataFrame
    pk: str

    def failing_rows(self, table: DataFrame) -> DataFrame:
        return orphans(table.select(self.fk), self.parent, self.fk, self.pk)


def breaks(name: str, broken: Column) -> Rule:
    """No row may fulfil ``broken``; null counts as not broken."""
    return Rule(name, F.count_if(F.coalesce(broken, F.lit(False))))


def not_null(*cols: str) -> list[Rule]:
    return [breaks(f"{c} is set", F.col(c).isNull()) for c in cols]


def in_range(col: str, lo: float | None = None, hi: float | None = None) -> Rule:
    """Nulls are left to ``not_null``."""
    below = F.col(col) < lo if lo is not None else F.lit(False)
    above = F.col(col) > hi if hi is not None else F.lit(False)
    return breaks(f"{col} in range", below | above)


def accepted(col: str, values: Sequence) -> Rule:
    return breaks(f"{col} accepted", ~F.col(col).isin(*values))


def fresh(ts: str, asof: datetime | str, max_age_hours: int) -> Rule:
    """The newest row is no older than that at ``asof``; a table without a time fails."""
    age = seconds_between(F.max(ts).cast("timestamp_ntz"), F.lit(str(asof)).cast("timestamp_ntz"))
    return Rule(f"{ts} fresh", F.coalesce(age > max_age_hours * 3600, F.lit(True)).cast("bigint"))


def at_least(n: int) -> Rule:
    """The table has so many rows; fails by those that lack."""
    return Rule(f"at least {n} rows", F.greatest(F.lit(n) - F.count(F.lit(1)), F.lit(0)))


VERDICT = "check string, n_failing bigint, passed boolean"


def verdicts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The verdict table: one row for each rule."""
    return spark.createDataFrame([(name, n, n == 0) for name, n in counts.items()], VERDICT)


def check_all(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The verdicts of all row rules from one scan and one aggregate, without a write."""
    counted = df.agg(*[r.failing.cast("bigint").alias(f"_{i}") for i, r in enumerate(rules)])
    each = F.array(*[F.struct(F.lit(r.name).alias("check"), F.col(f"_{i}").alias("n_failing")) for i, r in enumerate(rules)])
    return counted.select(F.inline(each)).withColumn("passed", F.col("n_failing") == 0)


class ChecksFailed(ValueError):
    """The table was left as it was."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts
        super().__init__(", ".join(f"{name}: {n}" for name, n in counts.items() if n))


def write_checked(
    df: DataFrame, path: str, rules: Sequence[Rule | Unique | HasParent], partition_cols: Names = (), sort_cols: Names = ()
) -> dict[str, int]:
    """``write_table`` behind a gate: failing rows by rule (all 0), or ``ChecksFailed`` with them and the table untouched.

    The rows are staged in the shared folder and, once they pass, written from there, so that they are computed once and what
    is checked is what is written. Rules are counted in the tasks that write, behind the last exchange: tasks of
    an earlier stage may run again when an executor is lost and would count twice."""
    spark, cols, order = df.sparkSession, as_list(partition_cols), as_list(sort_cols)
    by_row = [r for r in rules if isinstance(r, Rule)]
    staged, seen = scratch_dir(spark, "staged"), Observation()
    even = balanced(df, cols, order)
    observed = even.observe(seen, *[r.failing.cast("bigint").alias(f"_{i}") for i, r in enumerate(by_row)]) if by_row else even
    observed.write.parquet(staged)
    table = spark.read.schema(df.schema).parquet(staged)
    counts = {r.name: seen.get[f"_{i}"] for i, r in enumerate(by_row)}
    counts |= {r.name: r.failing_rows(table).count() for r in rules if not isinstance(r, Rule)}
    if any(counts.values()):
        raise ChecksFailed(counts)
    write_table(table, path, cols, order)
    return counts
