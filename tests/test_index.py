"""Ranked search and bucketed tables."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from macrotide.operators.search import ranked_search, write_index
from macrotide.plans import layers
from macrotide.sources.sinks import write_bucketed
from tests.conftest import SF_DIR, rows
from tools.plans import plan_of
from workload import QUERIES, standins as st


def test_ranking_equals_every_score_by_hand(spark, tmp_path):
    texts = {1: "federal funds rate", 2: "Funds, funds and the RATE of funds", 3: None, 4: "", 5: "unemployment rate", 6: "funds federal rate", 7: "élan 30-year"}
    docs = spark.createDataFrame(list(texts.items()), "id int, title string")
    queries = [("a", "funds rate"), ("b", "Rate rate élan"), ("c", "nothing here"), ("d", None)]
    write_index(docs, "id", "title", str(tmp_path / "i"))
    found = rows(ranked_search(spark, str(tmp_path / "i"), spark.createDataFrame(queries, "query_id string, text string"), 3))
    words = {k: re.findall(r"\w+", t.lower()) for k, t in texts.items() if t}
    df, average = Counter(t for w in words.values() for t in set(w)), sum(map(len, words.values())) / len(words)
    expected = []
    for name, text in queries:
        scores = Counter()
        for term, times in Counter(re.findall(r"\w+", (text or "").lower())).items():
            for k, w in words.items():
                if tf := w.count(term):
                    weight = math.log(1 + (len(words) - df[term] + 0.5) / (df[term] + 0.5))
                    scores[k] += times * weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / average))
        top = sorted((-round(v, 9), k) for k, v in scores.items())[:3]
        expected += [(name, i + 1, k, -v) for i, (v, k) in enumerate(top)]
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected], abs=1e-8)


def test_an_empty_index(spark, tmp_path):
    write_index(spark.createDataFrame([(1, None)], "id int, title string"), "id", "title", str(tmp_path / "i"))
    assert ranked_search(spark, str(tmp_path / "i"), spark.createDataFrame([("a", "x")], "query_id string, text string"), 3).collect() == []


def test_windows_and_joins_over_bucketed_tables_have_no_exchange(spark, tmp_path):
    bars = write_bucketed(st.prices(spark, SF_DIR), "bars_by_asset", "asset_id", "date", buckets=8, path=str(tmp_path / "b"))
    assert "Exchange" not in plan_of(layers.price_history(bars))
    assert "Exchange" not in plan_of(QUERIES["k3_bucketed_join"](spark, SF_DIR))
    again = write_bucketed(bars.limit(3).select("asset_id", "date"), "bars_again", "asset_id", buckets=4, path=str(tmp_path / "c"))
    assert again.count() == 3
    spark.sql("DROP TABLE bars_by_asset")
    spark.sql("DROP TABLE bars_again")
