"""Prefix scans against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from macrotide.operators.prefix import Running, _carried, _dealt, _places, prefix_scan
from tests.conftest import SF_DIR
from tools.plans import plan_of
from workload import QUERIES

KINDS = {"last": "v", "max": "v", "min": "v", "sum": "v", "count": "v"}


def by_hand(rows):
    out, series = [], {}
    for k, t, v in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or ""), (r[1] is not None, r[1] or 0))):
        seen = series.setdefault(k, [])
        if v is not None:
            seen.append(v)
        out.append((k, t, v, *((seen[-1], max(seen), min(seen), sum(seen)) if seen else (None,) * 4), len(seen)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pieces", [1, 4, 23])
@pytest.mark.parametrize("keys", [["hot"], ["hot", "hot", "hot", "b", "c", None], list("abcdefgh")])
def test_every_kind_over_every_key(spark, pieces, keys):
    rng = random.Random(pieces)
    made = [(rng.choice(keys), t, rng.choice([None, rng.randrange(-50, 50)])) for t in rng.sample(range(5000), 400)] + [("hot", None, 9)]
    df = spark.createDataFrame(made, "k string, t int, v int")
    found = prefix_scan(df, "k", "t", {name: Running(name, c) for name, c in KINDS.items()}, pieces)
    assert sorted([tuple(r) for r in found.collect()], key=repr) == by_hand(made)


@pytest.mark.parametrize("pieces", [1, 7])
def test_without_a_key_and_with_two(spark, pieces):
    rng = random.Random(1)
    made = [("x", t, rng.choice([None, t % 17])) for t in rng.sample(range(999), 200)]
    df = spark.createDataFrame(made, "k string, t int, v int")
    kinds = {name: Running(name, F.col(c)) for name, c in KINDS.items()}
    expected = by_hand(made)
    assert sorted([tuple(r) for r in prefix_scan(df, None, "t", kinds, pieces).collect()], key=repr) == expected
    two = prefix_scan(df.withColumn("k2", F.lit(None).cast("string")), ["k", "k2"], "t", kinds, pieces)
    assert sorted([tuple(r) for r in two.drop("k2").collect()], key=repr) == expected
    assert prefix_scan(df.limit(0), "k", "t", kinds, pieces).collect() == []


def test_each_piece_has_a_task_of_its_own(spark):
    for n in (1, 8, 64):
        placed = spark.range(n).select(F.lit(_places(spark, n))[F.col("id").cast("int")].alias("p")).repartition(n, "p")
        assert placed.groupBy(F.spark_partition_id()).count().count() == n


@pytest.mark.parametrize("name", ["j5_asof_join_hot", "w2_forward_fill_blocks", "w7_drawdown_blocks"])
def test_one_scan_and_one_exchange_of_the_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    rows = plan.split("\n\n")[0]
    assert rows.count("Exchange hashpartitioning") + rows.count("ShuffleExchange") <= 1


def test_a_crossing_key_is_not_gathered(spark):
    """The rows of a key with several pieces meet the crossing keys where they lie, also without a broadcast by size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = _dealt(spark.range(1000).selectExpr("'all' AS k", "id AS t"), ["k"], ["t"], 4)
        plan = plan_of(_carried(table, ["k"], ["t"], {"n": Running("count", "t")}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastHashJoin" in plan
