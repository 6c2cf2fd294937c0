"""Mixed documents through one stream."""

from __future__ import annotations

import json

from macrotide.plans import layers
from macrotide.sources import bronze
from macrotide.streaming import routes
from macrotide.streaming import run_routed, routed_network, routed_table, stream_documents
from tests.conftest import rows


def land(root, name, document):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(document if isinstance(document, str) else json.dumps(document, indent=2), encoding="utf-8")


def series(stamp, **values):
    points = [{"date": d.replace("_", "-").strip("d"), "value": v} for d, v in values.items()]
    return {"batch_info": {"collection_timestamp": stamp, "category": "sofr"}, "series_data": {"sofr_rate": {"series_id": "SOFR", "data_points": points}, "gone": None}}


def test_runs_follow_each_other_and_equal_the_batch(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        run_routed(stream_documents(spark, str(src), files_per_trigger=2), out, state)

    land(src, "series/a.json", series("2024-02-01T00:00:00", d2024_01_01="1", d2024_01_02="2", d2023_12_31="."))
    land(src, "net/fee_estimates_20240101_000000.json", {"1": 2.5, "6": "bad"})
    land(src, "net/mempool_20240101_000000.json", {"count": 30000, "vsize": 5, "total_fee": 7})
    land(src, "net/recent_blocks_20240101_000000.json", [{"id": "x", "height": 1, "timestamp": 1704067200, "tx_count": 4, "size": 9}, {"id": "y", "height": 2, "timestamp": 1704067300}])
    land(src, "net/recent_blocks_20240102_000000.json", [{"id": "y", "height": 2, "timestamp": 1704067300, "tx_count": 6, "size": 1}])
    run()
    land(src, "series/b.json", series("2024-03-01T00:00:00", d2024_01_02="20"))
    land(src, "series/old.json", series("2024-01-15T00:00:00", d2024_01_01="100", d2024_01_03="3"))
    land(src, "net/fee_estimates_20240102_000000.json", '{"1": 2.')
    land(src, "readme.md", "of no kind")
    land(src, "series/blank.json", " \n")
    run()
    run()  # nothing is new
    found = rows(routed_table(spark, out, "series").select("date", "numeric_value", "series_id"))
    assert [(str(d), v, i) for d, v, i in found] == [
        ("2023-12-31", None, "SOFR"), ("2024-01-01", 1.0, "SOFR"), ("2024-01-02", 20.0, "SOFR"), ("2024-01-03", 3.0, "SOFR"),
    ]
    batch = layers.silver_series(spark, str(src / "series"))
    assert rows(routed_table(spark, out, "series").select(batch.columns)) == rows(batch)
    net = [bronze.read_blocks(spark, f"{src}/net/recent_blocks_*"), bronze.read_fee_snapshots(spark, f"{src}/net/fee_estimates_*"), bronze.read_mempool_snapshots(spark, f"{src}/net/mempool_*")]
    gold = layers.gold_network(*net)
    assert rows(routed_network(spark, out)) == rows(gold) and gold.first().tx_count == 10
    rejects = spark.read.parquet(f"{out}/rejects").select("reason", "batch_file").collect()
    assert sorted((r.reason, r.batch_file.rsplit("/", 1)[1]) for r in rejects) == [("unknown", "readme.md"), ("unreadable", "fee_estimates_20240102_000000.json")]


def test_a_table_is_merged_once_a_run(spark, tmp_path, monkeypatch):
    """However many micro-batches a run takes; what a run landed that failed before its merge is not lost."""
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for day in range(1, 6):
        land(src, f"series/{day}.json", series(f"2024-02-0{day}T00:00:00", **{"d2024_01_01": str(day), f"d2024_01_0{day + 1}": "9"}))
    merged, merge = [], routes.merge_versions_into

    def count(batch, path, *rest):
        merged.append(path)
        if len(merged) == 2:
            raise OSError("lost")
        merge(batch, path, *rest)

    monkeypatch.setattr(routes, "merge_versions_into", count)
    documents = stream_documents(spark, str(src), files_per_trigger=1)
    try:
        run_routed(documents, out, state)
    except OSError:
        run_routed(stream_documents(spark, str(src), files_per_trigger=1), out, state)
    assert len(merged) == 2 + len(routes.ROUTES)
    found = rows(routed_table(spark, out, "series").select("date", "numeric_value"))
    assert [(str(d), v) for d, v in found] == [("2024-01-01", 5.0)] + [(f"2024-01-0{d}", 9.0) for d in range(2, 7)]
    run_routed(stream_documents(spark, str(src), files_per_trigger=1), out, state)
    assert len(merged) == 2 + len(routes.ROUTES)
