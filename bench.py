"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "daily_count",
    "velocity_join",
    "entity_profile",
    "stage1_score",
    "time_split",
    "time_order",
    "dedup_key",
    "freq_lookup",
    "roc_auc",
    "iforest_score",
    "boost_fit",
)


def main() -> None:
    from checks import QUERIES
    from riskloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    # start the JVM's code paths once, so the first query does not carry them
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").count().write.format(
        "noop"
    ).mode("overwrite").save()
    times = {}
    for name in wanted:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
