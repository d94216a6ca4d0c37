"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keelson.session import build_session  # noqa: E402
from keelson.suite.queries import all_queries  # noqa: E402

HEADLINE = (
    "region_state_counts",
    "dedup_latest",
    "dedup_feed",
    "dq_quarantine",
    "run_metrics",
    "dq_top_states",
    "dq_duplicate_keys",
    "silver_build",
    "scd2_apply",
    "gold_build",
    "fact_dim_join",
    "fact_dim_totals",
    "clustered_rewrite",
    "ingest_bronze",
    "medallion_end_to_end",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    # The first query of a session pays for starting and compiling; keep that out of the times.
    queries["region_state_counts"](spark, sf_dir).count()

    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
