"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

from tests.conftest import SF_DIR
from tools.compare import connect, normal
from workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        result = con.execute(ORACLES[name])
        assert got == normal([d[0] for d in result.description], result.fetchall())


_NUMBERS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_column_types_match_sql(spark, con, name):
    schema = QUERIES[name](spark, SF_DIR).schema
    described = {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
    ours = {f.name: _NUMBERS[f.dataType.simpleString()] for f in schema}
    assert ours == described
