from __future__ import annotations

from macrotide.llm.queries import QUERIES
from tests.conftest import SF_DIR


def run(spark, name, sf_dir=SF_DIR):
    return QUERIES[name](spark, sf_dir).collect()
