"""DuckDB times for the benchmark's queries, on the same Parquet: one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tools.compare import connect  # noqa: E402
from workload import ORACLES  # noqa: E402


def main() -> None:
    con = connect(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    con.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', '8'))}")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            con.execute(ORACLES[name]).fetchall()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 4)
    print(json.dumps({"value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main()
