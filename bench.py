"""Time the headline queries and print one JSON line.

$BENCH_SF_DIR (default /root/testdata/sf0.1) and $BENCH_CPUS set the input and the cores. Each query
runs once to warm up and then $BENCH_RUNS times (default 3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from tickloom.session import build_session  # noqa: E402

HEADLINE = [
    "daily_analytics", "spread_analysis", "rollup_hourly", "candles_1m", "candles_1m_arrival", "candles_5m",
    "rolling_vol_30", "session_vwap", "realized_vol_1h", "asof_spread", "alerts_all", "live_prices",
    "price_history", "spread_heatmap", "replay_candles_5m",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    ticks = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rows": ticks,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
