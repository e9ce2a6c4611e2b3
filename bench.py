"""Benchmark the headline queries.

Runs each query over the test tables in ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ..., "warm": {...}}``.
``queries`` holds each query's first run, ``warm`` a second one right after (compiled code is reused).

Every query is executed in full with the ``noop`` sink (all rows produced,
nothing collected to the driver).  One untimed warm-up query runs first on
the smallest test tables (sf0.001, a different folder, so no data of the
measured scale is cached): JVM start-up and JIT warm-up are then not charged
to whichever query happens to run first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "sales_daily",
    "sales_by_channel",
    "sales_by_region",
    "top_products",
    "customer_basket",
    "return_rate",
    "sales_by_category",
    "customer_segments",
    "stock_alerts",
    "product_margin",
    "sales_enriched",
    "validate_layers",
    "ingest_csv",
    "sink_partitioned",
    "load_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tidemark-bench")
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.exists(os.path.join(warm_dir, "lineitem.parquet")):
        warm_dir = sf_dir
    QUERIES["sales_by_channel"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, warm = {}, {}
    for name in names:
        for run in (times, warm):
            t0 = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            run[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.3f}s, again {warm[name]:.3f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "warm": warm,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
