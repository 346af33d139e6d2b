"""Seconds per headline query, as one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores,
BENCH_QUERIES optionally a comma-separated choice of registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "price_table",
    "dedupe_first",
    "iqr_filter_ticks",
    "indicators",
    "indicators_blocks",
    "clean_indicators",
    "fill_missing_blocks",
    "macd_blocks",
    "apply_scaler",
    "scaled_features",
    "make_sequences",
    "chronological_split",
    "evaluate",
    "evaluate_blocks",
    "price_histogram",
    "qq_points",
    "encode_series",
    "stream_event_prices",
    "scaled_features_blocks",
    "lstm_against_naive",
)


def main() -> None:
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{CPUS}]",
        "bench",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
