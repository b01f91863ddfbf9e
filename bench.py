"""Time the headline queries: one JSON line with seconds per query (best of the runs after a warm-up)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bars_minute", "row_ordinal", "pct_change_60", "forward_target", "rolling_std_30", "rsi_14", "macd_diff",
    "returns_and_indicators", "align_position", "align_asof", "feature_table_complete", "last_fold",
    "sentiment_score", "class_report", "headlines", "activity", "constituents", "cap_class", "ranked_screen_value",
    "volume_gainers", "top_gainers", "reasons_by_stock", "table_report", "chunks", "fan_out", "parse_commands",
    "command_replies", "streamed_bars", "trend_model",
]
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    from barframe.session import build_session
    from suite.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        slow = name == "trend_model"
        times = []
        for _ in range(1 if slow else RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times if slow else times[1:]), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
