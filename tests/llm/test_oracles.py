"""Registered queries against their SQL on DuckDB."""

from __future__ import annotations

import pytest

from macrotide.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
from tools.compare import connect, normal


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLES[name])
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", ["op5_drop_boilerplate_lines", "op10_url_verdicts"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
