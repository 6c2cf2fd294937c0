"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec

from macrotide.session import scratch_dir

Names = str | Sequence[str]


def as_list(names: Names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def quoted(name: str) -> str:
    """A column name for use inside a SQL expression. Wide expressions are built as SQL
    text: one call to the driver's JVM in place of several per part."""
    return "`" + name.replace("`", "``") + "`"


def by_key(key: Names, *order: str) -> WindowSpec:
    """Window of one key in time order. Day-grain input holds at most one row per
    key and calendar day, so no key can outgrow a task."""
    spec = Window.partitionBy(*as_list(key))
    return spec.orderBy(*order) if order else spec


def running(key: Names, order: str) -> WindowSpec:
    return by_key(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing(key: Names, order: str, rows: int) -> WindowSpec:
    return by_key(key, order).rowsBetween(-(rows - 1), Window.currentRow)


def written(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` as a table in the shared folder, whose bytes the planner knows, and its row count."""
    path = scratch_dir(df.sparkSession, "table")
    df.write.parquet(path)
    table = df.sparkSession.read.parquet(path)
    return table, table.count()
