"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
tables and cores. Each query runs once to warm up, then is timed to a sink that
reads every row and column; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telemill.catalog import ALL
from telemill.session import local_session

HEADLINE = [
    "q1_hourly_by_machine", "q2_last_hour_kpi", "q3_daily_trend", "q4_temperature_histogram", "q5_scatter",
    "q6_machine_statistics", "q7_alert_feed", "q8_severity_counts", "q9_model_quality", "q10_events_per_minute",
    "q11_top_machines", "d1_d7_measures", "j1_interval_join", "p2_drop_copies", "p3_forward_fill", "f4_zscore", "f8_enrich",
    "a4_describe", "a5_histogram", "a8_correlations", "a15_roc_auc", "s3_decode_json", "s4_partitioned_sink",
]
# Slower ones: a single run, after the others have warmed the JVM.
ONCE = ["x2_stream_hourly", "x8_stream_interval_join", "m3_forest_fit", "m4_forest_predict", "m5_grid_search"]


def timed(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = set(sys.argv[1:])
    spark = local_session(cores, int(cores))
    by_name = {q.name: q for q in ALL}
    seconds = {}
    for name in [*HEADLINE, *ONCE]:
        if wanted and name not in wanted:
            continue
        runs = [timed(spark, by_name[name], sf_dir) for _ in range(1 if name in ONCE else 3)]
        seconds[name] = round(min(runs[-2:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
