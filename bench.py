"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs twice to warm up, then BENCH_RUNS times (default 3); the median of
building, planning and fully computing the result is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.indicators import with_indicators
from tickloom.plans import views
from tickloom.plans.queries import QUERIES
from tickloom.session import local_session

HEADLINE = [
    "vwap_sliding", "vwap_plain", "vwap_latest_closed", "bars_1h", "bars_monthly", "last_n_bars",
    "sma_200", "rsi_14", "ema_50", "macd", "indicators", "normalise_candles", "publish_candles",
    "payload_to_bars", "pair_asof", "pair_latest", "measures_latest", "csv_roundtrip", "gold_roundtrip",
    "vwap_stream_append", "vwap_stream_update", "vwap_stream_latest", "pair_stream",
]


def one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one long series."""
    events = views.table(spark, sf_dir, "events")
    return events.select(F.lit("all").alias("symbol"), F.col("ts").alias("datetime"), F.col("value").alias("close"))


LONG_SERIES = {
    "one_series_blocks": lambda spark, sf_dir: with_indicators(one_series(spark, sf_dir), size="1"),
    "one_series_plain": lambda spark, sf_dir: with_indicators(one_series(spark, sf_dir), size=None),
}


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    timed = {}
    for name, query in ({n: QUERIES[n] for n in HEADLINE} | LONG_SERIES).items():
        if only and name not in only:
            continue
        for _ in range(2):
            seconds(query, spark, sf_dir)
        timed[name] = round(statistics.median(seconds(query, spark, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
