"""The gate ahead of a table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from macrotide.plans import gate, layers
from tests.conftest import rows
from tools.plans import plan_of


def frame(spark, *values):
    return spark.createDataFrame([(d, k, v) for d, k, v in values], "date string, k int, v double").withColumn("date", F.to_date("date"))


def some_rules():
    return [*gate.not_null("v"), gate.in_range("v", 0, 10), gate.Unique("one row a key", ["date", "k"])]


def test_a_failing_rule_leaves_the_old_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    good = frame(spark, ("2024-01-01", 1, 1.0), ("2024-01-02", 2, 2.0))
    layers.refresh(good, path, "2024-01-01", "2024-01-02", rules=some_rules())
    before = rows(spark.read.parquet(path))
    for bad, name in [(("2024-01-02", 2, 99.0), "v in range"), (("2024-01-02", 3, None), "v is set")]:
        with pytest.raises(gate.ChecksFailed) as stopped:
            layers.refresh(frame(spark, ("2024-01-01", 1, 5.0), bad), path, "2024-01-01", "2024-01-02", rules=some_rules())
        assert stopped.value.counts[name] == 1 and name in str(stopped.value)
        assert rows(spark.read.parquet(path)) == before
    with pytest.raises(gate.ChecksFailed) as stopped:
        gate.write_checked(frame(spark, ("2024-01-02", 2, 1.0), ("2024-01-02", 2, 1.0)), path, some_rules(), "k")
    assert stopped.value.counts == {"v is set": 0, "v in range": 0, "one row a key": 1}
    layers.refresh(frame(spark, ("2024-01-02", 2, 3.0)), path, "2024-01-02", "2024-01-02", rules=some_rules())
    assert [r[2] for r in rows(spark.read.parquet(path).select("date", "k", "v"))] == [1.0, 3.0]


def test_a_check_on_parents_and_an_empty_table(spark, tmp_path):
    parents = spark.createDataFrame([(1,)], "id int")
    rule = gate.HasParent("known", "k", parents, "id")
    counts = gate.write_checked(frame(spark, ("2024-01-01", 1, 1.0), ("2024-01-01", None, 1.0)), str(tmp_path / "a"), [rule])
    assert counts == {"known": 0}
    with pytest.raises(gate.ChecksFailed):
        gate.write_checked(frame(spark, ("2024-01-01", 5, 1.0)), str(tmp_path / "b"), [rule])
    with pytest.raises(gate.ChecksFailed) as stopped:
        gate.write_checked(spark.createDataFrame([], "ts timestamp_ntz"), str(tmp_path / "c"),
                           [gate.at_least(2), gate.fresh("ts", "2024-01-01", 1)])
    assert stopped.value.counts == {"at least 2 rows": 2, "ts fresh": 1}


def test_all_rules_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, ("2024-01-01", 1, 1.0), ("2024-01-02", 2, 20.0)).write.parquet(path)
    checked = gate.check_all(spark.read.parquet(path), [r for r in some_rules() if isinstance(r, gate.Rule)])
    assert plan_of(checked).count("FileScan") <= 1
    assert rows(checked) == [("v in range", 1, False), ("v is set", 0, True)]
