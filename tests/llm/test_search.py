"""Ranked search against a plain ranking of every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from macrotide.llm import lexical_search as ls

TERM, LOWER = re.compile(ls.TERM), str.maketrans(ls.UPPER, ls.UPPER.lower())


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k=10):
    counted = [(i, len(w), Counter(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    n_docs, n_terms = len(counted), sum(n for _, n, _ in counted)
    df = Counter(t for _, _, c in counted for t in c)
    found = []
    for item, text in items:
        scores = []
        for doc, n, tf in counted:
            m = 25 + 75 * n * n_docs // n_terms
            total = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t, q in Counter(terms(text)).items()
            )
            if total > 0:
                scores.append((-total, doc is None, doc))
        found += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(found, key=str)


@pytest.fixture
def tables(odd_rows):
    docs = [(i, t) for i, _, t in odd_rows] + [(100 + k, f"term{k % 7} shared word{k % 3} " * (1 + k % 4)) for k in range(60)]
    docs += [(300, "A tie of copies"), (301, "a TIE of copies"), (302, "a tie of Copies")]
    items = [("a", "term3 shared Word1 word1"), ("b", "of copies"), ("c", None), ("d", ""), ("e", "nowhere-found"), (None, "plain TEXT ünïcödé"), ("a", "term5")]
    return docs, items


def search(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS length", "2 AS item", "3 AS terms", "'x' AS n")
    i = spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "1 AS place", "2 AS counts", "3 AS rank")
    return sorted([tuple(r) for r in ls.search(d.repartition(3), i, **settings).collect()], key=str)


@pytest.mark.parametrize("head_rows", [1, 20, 10_000])
def test_every_head_gives_the_ranking_by_hand(spark, tables, head_rows):
    docs, items = tables
    assert search(spark, docs, items, head_rows=head_rows) == by_hand(docs, items)


def test_items_in_several_blocks(spark, tables):
    docs, items = tables
    assert search(spark, docs, items, block_pairs=4) == by_hand(docs, items)


def test_small_buckets_and_pieces(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(ls, "PIECE_BYTES", 7)
    assert ls.count_terms("Ab cd ab, Éx".encode()) == (4, Counter({b"ab": 2, b"cd": 1, "Éx".encode(): 1}))


def test_empty_tables(spark, tables):
    docs, items = tables
    assert search(spark, [], items) == [] and search(spark, docs, []) == []
    assert search(spark, [(1, None), (2, "")], items) == []
