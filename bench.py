"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Prints one JSON line.
Set BENCH_QUERIES=all to time every registered query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "agg_monthly", "agg_surprise", "agg_daily_revenue", "agg_clv", "jon_star", "jon_point_in_time",
    "win_dedup_latest", "cdc_scd1", "cdc_scd2", "cdc_upsert", "cdc_scd2_snapshot", "qlt_metrics",
    "qlt_event_log", "qlt_table_metrics", "exp_parse_brl", "exp_latest_obs", "src_rescue", "str_hourly",
    "prv_secure_view", "snk_quarantine", "src_stream_events", "cdc_stream_scd2", "str_stream_hourly",
    "str_medallion_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from strata.plans.registry import load_all
    from strata.session import build_session
    spark = build_session(master=f"local[{cpus}]", app="strata-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus))))
    from strata.session import size_for_input
    from strata.plans.views import TABLES
    parts = size_for_input(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES])
    reg = load_all()
    names = list(reg) if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE
    # Warm-up with queries outside the timed set (JVM JIT, class loading, parquet
    # footer reads); timings below are steady-state, not first-run.
    for w in ("agg_global", "agg_summary_exact", "jon_full_outer", "set_union"):
        reg[w].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = reg[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
           "shuffle_partitions": parts}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
