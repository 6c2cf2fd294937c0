"""Correlations of many column pairs from one mergeable buffer.

A pair needs its count, both means, both sums of squares about them and the sum of products. Here a task
holds those of all pairs as matrices, one entry for each x and y: a batch of rows adds to them by matrix products
over values and masks, so nulls count pairwise and no row is multiplied by the number of pairs. A task
sends one row for each group and x; the rows of a group and x are merged after one exchange. Means are kept apart from
sums of squares, so large offsets do not cancel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Moments = tuple[np.ndarray, ...]  # n, mean of x, mean of y, squares of x, squares of y, products
PARTS = ("n", "mean_x", "mean_y", "xx", "yy", "xy")
BUFFER_BYTES = 256 << 20


def batch_moments(x: np.ndarray, y: np.ndarray, has_x: np.ndarray, has_y: np.ndarray) -> Moments:
    """Moments of rows by columns. Values are shifted by a row's own, so a constant column has none about its mean."""

    def shifted(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = values[known.argmax(0), np.arange(values.shape[1])] * known.any(0)
        return np.where(known, values - first, 0.0), first

    (x, at_x), (y, at_y) = shifted(x, has_x), shifted(y, has_y)
    mx, my = has_x.astype(float), has_y.astype(float)
    n, sx, sy = mx.T @ my, x.T @ my, mx.T @ y
    xx, yy, xy = (x * x).T @ my, mx.T @ (y * y), x.T @ y
    some = np.maximum(n, 1)

    def about_mean(squares: np.ndarray, total: np.ndarray) -> np.ndarray:
        rest = squares - total * total / some
        return np.where(rest > 1e-13 * squares, rest, 0.0)

    return n, at_x[:, None] + sx / some, at_y[None, :] + sy / some, about_mean(xx, sx), about_mean(yy, sy), xy - sx * sy / some


def merged(a: Moments, b: Moments) -> Moments:
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    cross = a[0] * share
    dx, dy = np.where(b[0] > 0, b[1] - a[1], 0.0), np.where(b[0] > 0, b[2] - a[2], 0.0)
    return n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * cross, a[4] + b[4] + dy * dy * cross, a[5] + b[5] + dx * dy * cross


def correlations(m: Moments) -> np.ndarray:
    """r of each entry; NaN where either side is constant or there are fewer than two rows."""
    n, mean_x, mean_y, xx, yy, xy = m
    spread = (xx > n * (1e-15 * mean_x) ** 2) & (yy > n * (1e-15 * mean_y) ** 2) & (n > 1)
    return np.where(spread, xy / np.sqrt(np.where(spread, xx * yy, 1.0)), np.nan)


def _columns(batch: pa.RecordBatch, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    columns = [batch.column(i) for i in range(first, last)]
    known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
    return np.column_stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in columns]), known


def comoments(df: DataFrame, xs: Sequence[str], ys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Correlation of each of ``xs`` with each of ``ys`` for each group: rows (by, x, y, r, n), where x and y
    are positions in the lists. Rows that lack either value count for no pair of it; r is null where
    either side is constant. An empty table has no groups and gives no rows, with or without ``by``."""
    by, xs, ys = list(by), list(xs), list(ys)
    group = F.struct(*[F.col(c) for c in by]) if by else F.lit(True)
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate([*xs, *ys])]
    # The group travels as text, which names it within a task; its columns come back from the text's first row.
    chosen = df.select(F.to_json(group).alias("key") if by else F.lit("").alias("key"), *values)
    kind = "key string, x int, " + ", ".join(f"{p} array<double>" for p in PARTS)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Moments] = {}
        most = max(1, BUFFER_BYTES // (48 * len(xs) * len(ys)))

        def send() -> Iterator[pa.RecordBatch]:
            for key, moments in held.items():
                parts = [pa.array(list(m), pa.list_(pa.float64())) for m in moments]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(xs), pa.string()), pa.array(range(len(xs)), pa.int32()), *parts], names=["key", "x", *PARTS]
                )
            held.clear()

        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            (x, has_x), (y, has_y) = _columns(batch, 1, 1 + len(xs)), _columns(batch, 1 + len(xs), 1 + len(xs) + len(ys))
            numbers = codes.indices.to_numpy()
            order = np.argsort(numbers, kind="stable")
            borders = np.searchsorted(numbers[order], np.arange(len(codes.dictionary) + 1))
            for k, key in enumerate(codes.dictionary.to_pylist()):
                at = order[borders[k] : borders[k + 1]]
                new = batch_moments(x[at], y[at], has_x[at], has_y[at])
                held[key] = merged(held[key], new) if key in held else new
            if len(held) > most:
                yield from send()
        yield from send()

    def merge(table: pa.Table) -> pa.Table:
        rows = [np.array(table.column(p).to_pylist(), float) for p in PARTS]
        total = tuple(r[0] for r in rows)
        for i in range(1, table.num_rows):
            total = merged(total, tuple(r[i] for r in rows))
        r = correlations(total)
        n = len(ys)
        return pa.table({
            "key": [table.column("key")[0].as_py()] * n, "x": pa.array([table.column("x")[0].as_py()] * n, pa.int32()),
            "y": pa.array(range(n), pa.int32()), "r": pa.array(r, mask=np.isnan(r)), "n": pa.array(total[0].astype(np.int64)),
        })

    found = chosen.mapInArrow(add_up, kind).groupBy("key", "x").applyInArrow(merge, "key string, x int, y int, r double, n bigint")
    if not by:
        return found.drop("key")
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    return found.withColumn("key", F.from_json("key", fields)).select(*[F.col(f"key.{c}").alias(c) for c in by], "x", "y", "r", "n")
