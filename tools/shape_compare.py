"""

* ``count-after-write``: each table is written, then counted with a second
  action on the same DataFrame, which re-executes its whole plan (the
  original pipeline's shape).
* ``observed``: the row count is collected by an ``Observation`` during the
  write itself (``sources.sinks.write_table``), so each table runs once.

Both build the same silver tables from the same bronze frames, one table at a
time. Usage: python tools/shape_compare.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.operators.silver import CLEANERS  # noqa: E402
from tidemark.plans.pipeline import SILVER_PARTITIONS  # noqa: E402
from tidemark.session import local_session, new_run_dir  # noqa: E402
from tidemark.sources import fixtures  # noqa: E402
from tidemark.sources.sinks import write_table  # noqa: E402


def count_after_write(df, path, partition_by):
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.count()


def run(spark, sf_dir, shape):
    out = new_run_dir(spark, f"shape-{shape}")
    bronze = fixtures.bronze_tables(spark, sf_dir)
    t0 = time.perf_counter()
    counts = {}
    for name, clean in CLEANERS.items():
        df = clean(bronze[name])
        parts = SILVER_PARTITIONS.get(name, [])
        if shape == "observed":
            counts[name] = write_table(df, f"{out}/{name}", parts, audit_column=None)
        else:
            counts[name] = count_after_write(df, f"{out}/{name}", parts)
    return time.perf_counter() - t0, counts


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    run(spark, os.path.join(os.path.dirname(sf_dir), "sf0.001"), "observed")  # warm-up
    result = {}
    for shape in ("count-after-write", "observed", "count-after-write", "observed"):
        sec, counts = run(spark, sf_dir, shape)
        result.setdefault(shape, []).append(round(sec, 2))
        result[f"{shape}-rows"] = counts
    assert result["count-after-write-rows"] == result["observed-rows"]
    print(json.dumps({k: v for k, v in result.items() if not k.endswith("-rows")}))


if __name__ == "__main__":
    main()
