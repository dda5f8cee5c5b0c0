"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query runs to
completion through the ``noop`` sink (full execution, nothing collected);
the time includes planning and, for source/stream queries, staging files.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "prj_enforce_schema",
    "dq_tag_violations",
    "dq_first_failure_reason",
    "win_gold_summary",
    "agg_metric_query",
    "cdc_skip_change_commits",
    "cdc_scd1_deletes",
    "cdc_scd2_deletes",
    "cdc_change_feed",
    "src_rescued_csv",
    "str_scd1_stream",
    "str_medallion",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from tessera.plans.catalog import QUERIES
    from tessera.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    # warm-up: JVM start, first scan of the parquet footers
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
