"""Headline queries timed end to end; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS``
the timed runs per query (the median is reported after one warm-up run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from opstide.catalog import QUERIES  # noqa: E402
from opstide.catalog.bindings import Inputs  # noqa: E402
from opstide.operators.parsing import parse_session_lines  # noqa: E402
from opstide.session import local_session, scratch_path  # noqa: E402
from opstide.sources.logs import read_log_lines  # noqa: E402

HEADLINE = [
    "a2_last_hour_sessions", "a3_session_hourly", "a4_lock_hourly", "a5_lock_table_daily", "a7_techlog_hourly",
    "a8_hourly_metrics", "a9_lock_daily", "a11_top_tables_days", "a12_slow_contexts", "a14_user_load", "a18_top_errors",
    "a19_errors_by_role", "a23_merge_partials", "a25_interval_stats", "j1_conflict_pairs", "j2_disk_status", "j8_inhibit",
    "m3_forecast", "m6_disk_warnings", "m7_fleet_status", "m8_lock_risk", "m10_lock_trend_risk", "m11_lock_forecast",
    "m13_sigma_check", "m15_iforest_nodes", "m16_iforest_score", "m24_table_growth_report", "m28_seasonal_forecast",
    "p1_parse_session_lines", "p2_parse_lock_lines", "s10_upsert_latest", "st1_lock_hourly_stream", "w2_daily_deviation",
    "w14_control_chart", "w15_counter_rate", "w16_hold_for",
]
LINES = 1_000_000


def log_folder(spark, sf_dir: str) -> tuple[str, int]:
    """About a million log lines as text files, made from the event table."""
    lines = Inputs(spark, sf_dir).log_lines.select("line")
    count = lines.count()
    copies = max(1, LINES // count)
    path = scratch_path(spark, "bench-logs")
    lines.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select("line").repartition(16).write.text(path)
    return path, count * copies


def timed(run, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return statistics.median(times[1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "opstide-bench")
    folder, n_lines = log_folder(spark, sf_dir)
    seconds = {"parse_log_files": timed(lambda: parse_session_lines(read_log_lines(spark, folder, "*.txt")), runs)}
    for key in HEADLINE:
        seconds[key] = timed(lambda k=key: QUERIES[k](spark, sf_dir), runs)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of per-query medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "parsed_lines_per_sec": round(n_lines / seconds["parse_log_files"]),
            }
        )
    )


if __name__ == "__main__":
    main()
