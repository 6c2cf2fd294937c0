from __future__ import annotations

import pytest

from macrotide.session import share_package


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    share_package(spark)


#: Columns whose names operators use inside, which inputs may have too.
CLASHING = (
    "'x' AS site", "'y' AS digests", "1 AS node", "2 AS bucket", "3 AS target", "'z' AS block", "4 AS n_words", "5 AS score",
    "'w' AS items", "6 AS batch", "7 AS degree", "'v' AS place",
)


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, source, text) with further columns of clashing names."""

    def make(rows, schema="doc_id bigint, source string, text string"):
        return spark.createDataFrame(rows, schema).selectExpr("*", *CLASHING)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank texts, repeated rows, a very long text, ties."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    return [
        (1, "a", "Plain text with a few words, and a second line.\nThe second line of it."), (2, None, None), (3, "a", ""),
        (None, "b", "a text without an id, long enough for a window of words or two of them"), (4, "b", " \t\n \r\n"),
        (5, "b", "twice the same row of text here"), (5, "b", "twice the same row of text here"), (6, None, long),
        (7, "a", "Ünïcödé wörds ñandú 日本語 テキスト é"), (None, None, None), (8, "a", "one"),
    ]


def tuples(df, *columns):
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])
