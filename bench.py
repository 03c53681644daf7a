"""Seconds per query: one warm-up, then the median of ``BENCH_RUNS`` runs into a sink that discards rows.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default: all), ``BENCH_RUNS`` (default 3),
``BENCH_QUERIES`` (comma separated names, or ``all``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidewater import build_session
from tidewater.plans import QUERIES

HEADLINE = [
    "parse_delimited",
    "flat_map_words",
    "word_count",
    "word_count_running",
    "keyed_reduce",
    "max_by_running",
    "count_by_pair_running",
    "pv_running",
    "uv_running",
    "sum_running",
    "reconcile_inner",
    "interval_join",
    "interval_join_events",
    "tumbling_sum",
    "sliding_sum",
    "et_session_sum",
    "count_tumbling",
    "count_sliding",
    "window_process_udf",
    "watermark_replay",
    "late_updates",
    "sliding_count_late",
    "no_drop_alarm",
    "jump_alarm",
    "topn_running",
    "dedup_first",
    "match_strict",
    "retract_changelog",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
