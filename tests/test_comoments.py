"""Correlations of wide tables against numpy, pair by pair."""

from __future__ import annotations

import numpy as np
import pytest

from macrotide.operators import stats
from macrotide.operators.comoments import comoments
from tools.plans import plan_of


def table(spark, n, c, groups):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(n, 3)) @ rng.normal(size=(3, c)) + rng.normal(size=(n, c)) + 1e7
    base[:, 1] = 5.0
    known = rng.random((n, c)) > 0.2
    known[:, 2] = False
    names = [None, "a", "b\"'"][:groups]
    keys = [names[i % len(names)] for i in range(n)]
    rows = [(k, *[float(v) if ok else None for v, ok in zip(r, m, strict=True)]) for k, r, m in zip(keys, base, known, strict=True)]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"c{i} double" for i in range(c))).repartition(5)
    return df, keys, base, known


def expected(x, y, ok):
    x, y = x[ok], y[ok]
    if len(x) < 2 or len(set(x)) == 1 or len(set(y)) == 1:
        return None
    return float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("groups", [1, 3])
def test_every_pair_equals_numpy(spark, groups):
    df, keys, base, known = table(spark, 500, 12, groups)
    cols = [f"c{i}" for i in range(12)]
    found = stats.correlation_matrix(df, cols, by="g").collect()
    assert len(found) == 144 * groups
    for r in found:
        i, j = int(r.x[1:]), int(r.y[1:])
        rows = np.array([k == r.g for k in keys]) & known[:, i] & known[:, j]
        want = expected(base[:, i], base[:, j], rows)
        assert r.n == rows.sum() and (r.r is None) == (want is None)
        assert want is None or abs(r.r - want) < 1e-7 and abs(r.r2 - want * want) < 1e-7


def test_two_hundred_columns_in_one_exchange_without_more_rows(spark):
    df, _, base, known = table(spark, 300, 200, 1)
    found = stats.correlation_matrix(df.drop("g"), [f"c{i}" for i in range(200)])
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan[plan.index("MapInArrow"):]
    rows = {(r.x, r.y): r.r for r in found.collect()}
    assert len(rows) == 40_000
    for i, j in [(0, 0), (7, 150), (150, 7), (199, 3), (1, 5)]:
        want = expected(base[:, i], base[:, j], known[:, i] & known[:, j])
        assert (rows[f"c{i}", f"c{j}"] is None) == (want is None) and (want is None or abs(rows[f"c{i}", f"c{j}"] - want) < 1e-7)


def test_few_pairs_equal_many(spark):
    df, *_ = table(spark, 200, 9, 3)
    pairs = [("c0", f"c{i}") for i in range(9)]
    many = {(r.g, r.y): (r.r, r.n) for r in stats.correlate_pairs(df, pairs, "g").collect()}
    few = {(r.g, r.y): (r.r, r.n) for r in stats.correlate_pairs(df, pairs[:4], "g").collect()}
    for key, (r, n) in few.items():
        assert many[key][1] == n and (r is None) == (many[key][0] is None) and (r is None or abs(r - many[key][0]) < 1e-7)


def test_empty_table(spark):
    df, *_ = table(spark, 3, 3, 1)
    assert comoments(df.limit(0), ["c0"], ["c1"]).collect() == []
