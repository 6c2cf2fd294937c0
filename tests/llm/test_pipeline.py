"""The pipeline, stage by stage, against plain versions of the same decisions."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.conftest import tuples
from tests.llm.test_corpus_wide import brute_classes
from tests.llm.test_native import brute_lines, brute_mix
from tests.llm.test_text_maps import brute_hits


def test_stages_take_effect_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.source, r.text) for r in docs.collect()]
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == columns
            after = {r.doc_id: (r.doc_id, r.source, r.text) for r in docs.collect()}
        if name == "quality":
            clean = [i for i, _, _ in before if labels.get(i) == 1]
            assert sum(i in after for i in clean) >= 0.97 * len(clean)
            assert all(after[i] == row for row in before if (i := row[0]) in after)
        elif name == "line_boilerplate":
            assert Counter(after.values()) == Counter(brute_lines(before))
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "near_duplicates":
            assert set(after) == {i for i, c in brute_classes([(i, t) for i, _, t in before]) if i == c}
        elif name == "benchmark_passages":
            hits = brute_hits([t for _, _, t in before], benchmark)
            assert set(after) == {row[0] for row, (n, hit, _) in zip(before, hits, strict=True) if not (hit and 20 * hit >= n)}
        else:
            assert Counter(tuples(docs, "doc_id", "source", "n_tokens", "pass")) == Counter(brute_mix(before, 0.95, 4.0))


def test_stages_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_registered_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_a_group_of_copies_leaves_one_document_with_its_text(spark):
    """Copies are a third of a site's rows; a line of many other pages is boilerplate still."""
    copy = "\n".join(f"line {k} of the copied page has words {k * 7} of its own" for k in range(6))
    rows = [(k, "a", copy) for k in range(30)]
    rows += [(k, "a", "\n".join(["menu", *(f"page {k} line {j} says {k * j + j}" for j in range(5))])) for k in range(30, 90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").selectExpr("*", "length(text) AS n_chars")
    kept = corpus_pipeline.line_boilerplate(spark, docs, SF_DIR)
    found = {r.doc_id: r.text for r in kept.collect()}
    assert found == {i: t.removeprefix("menu\n") for i, _, t in rows}
    left = corpus_pipeline.mixture(spark, corpus_pipeline.near_duplicates(spark, kept, SF_DIR), SF_DIR)
    assert 0 in {r.doc_id for r in left.collect()}
