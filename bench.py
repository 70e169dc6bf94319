"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the folder of tables (default sf0.1), BENCH_CPUS the number of cores.
Every query is run to its last column into a sink that keeps nothing; the median of the
warm runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from textwarden.plans.catalog import QUERIES  # noqa: E402
from textwarden.session import get_spark  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Query: table whose rows it screens.
HEADLINES = {
    "pii_screen": "documents",
    "keyword_safety": "documents",
    "prompt_injection": "conversations",
    "input_length_tokens": "documents",
    "output_format": "events",
    "strip_html": "pages",
    "chain": "documents",
    "chain_metrics": "documents",
    "rate_limit_batch": "events",
    "rate_limit_hot_user": "events",
    "semantic_topic": "embeddings",
    "model_judge": "documents",
    "safety_preset": "events",
    "safety_preset_with_model": "events",
    "rate_limit_streaming": "events",
}


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = get_spark(
        "textwarden-bench", f"local[{CPUS}]", spark_sql_shuffle_partitions=CPUS,
        spark_ui_enabled="false", spark_driver_memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, rates = {}, {}
    for name, source in HEADLINES.items():
        seconds(spark, name)
        runs = 1 if name in ("rate_limit_streaming", "rate_limit_hot_user") else RUNS
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(runs)), 3)
        rows = spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
        rates[name] = round(rows / times[name])
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_sec": rates,
        "sf": Path(FOLDER).name.removeprefix("sf"),
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
