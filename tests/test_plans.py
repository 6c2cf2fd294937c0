"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from macrotide.operators import clean
from macrotide.plans import layers
from macrotide.session import object_store_settings, sized_settings
from tests.conftest import SF_DIR
from tools.plans import plan_of, summary
from workload import QUERIES, standins as st
from workload.registry import table


def text(df):
    return plan_of(df)


# This fill is for a table without a key; its second pass orders one row per year.
ONE_ROW_PER_BLOCK = {"w2_forward_fill_blocks"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("t1", "t2", "t3"))))
def test_no_keyless_window_cross_join_or_python(spark, name):
    plan = text(QUERIES[name](spark, SF_DIR))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "InPandas" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line) and name not in ONE_ROW_PER_BLOCK:
            assert "SinglePartition" not in "".join(lines[i + 1:i + 4])


def test_filters_and_columns_reach_the_scan(spark):
    events = table(spark, SF_DIR, "events")
    plan = text(clean.filter_dates(events, "2024-01-05", "2024-01-20", "ts").select("event_id", "ts"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_one_exchange_for_a_chain_of_windows(spark, tmp_path):
    path = str(tmp_path / "prices")
    st.prices(spark, SF_DIR).write.parquet(path)
    plan = text(layers.price_history(spark.read.parquet(path)))
    assert summary(plan)["hash"] == 1


def test_daily_bars_aggregate_before_the_shuffle(spark):
    plan = text(st.prices(spark, SF_DIR))
    assert summary(plan) == {"hash": 1, "scan": 1} and plan.count("HashAggregate") == 2


def test_versions_of_fixed_width_columns_stay_in_a_hash_aggregate(spark):
    df = st.series(spark, SF_DIR).select("series_key", "date", "numeric_value", F.lit(1).alias("collected"))
    assert "SortAggregate" not in text(clean.latest_version(df, ["series_key", "date"], "collected"))


def test_matrix_needs_one_exchange_more_than_its_input(spark, tmp_path):
    from macrotide.operators.stats import correlation_matrix

    path = str(tmp_path / "facts")
    st.facts(spark, SF_DIR).write.parquet(path)
    plan = text(correlation_matrix(spark.read.parquet(path), ["price_usd", *st.INDICATORS]))
    assert summary(plan).get("hash", 0) + summary(plan).get("single", 0) == 1


def test_object_store_settings():
    settings = object_store_settings("http://store:9000", "user", "word")
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert all(name.startswith("spark.hadoop.fs.s3a.") for name in settings)


def test_partitions_grow_with_the_shuffle():
    assert sized_settings(1, 8)["spark.sql.shuffle.partitions"] == "16"
    assert sized_settings(10 << 40, 4000)["spark.sql.shuffle.partitions"] == "40960"


def test_a_cluster_session_needs_a_size_and_a_shared_folder(spark, monkeypatch):
    from macrotide import session

    with pytest.raises(ValueError, match="shuffle_bytes"):
        session.get_session("x", "spark://host:7077")
    settings = session.sized_settings(100 << 40, 8000)
    assert int(settings["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(ValueError, match="checkpoint"):
        session.checkpoint_root(Session())


def test_prices_do_not_move_for_their_context(spark):
    """Even where the planner's estimate of the wide side is far too large."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = text(st.facts(spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
