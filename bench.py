"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. All queries run once to warm up and
then BENCH_RUNS times (3); the figure of each is the median. Results go to the no-op
sink, so every row is computed and none reaches the driver."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from macrotide import get_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = """
flagship_indicator_report a1_pivot_series a2_series_counts a6_return_stats a8_max_drawdown a9_histogram
a11_correlation_matrix a13_correlation_by_regime a14_lagged_correlation a17_daily_blocks a18_fee_history a19_congestion
a20_current_metrics a21_daily_bars a21_daily_bars_by_supplier w1_daily_return w2_forward_fill w3_rolling_volatility
w4_moving_averages w7_drawdown w8_latest_version w11_volatility_regime w13_trend_signal j1_fact_prices j2_densify j5_asof_join
j6_orphans j7_missing_dates q1_check_unique q7_check_outliers q8_completeness u2_merge_versions silver_prices silver_series
""".split()


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=str(cpus), spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        run(spark, name, sf_dir)
    times = {
        name: round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 4) for name in HEADLINE
    }
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": repeats,
    }))


if __name__ == "__main__":
    main()
