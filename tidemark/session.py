"""Session helpers: scratch location and recommended settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """Shared scratch folder for written intermediate tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage every executor can reach) or set with ``setCheckpointDir``.  Only a
    local session that has neither (tests, a laptop) gets a temporary folder of
    its own; any other master without shared storage is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get(CHECKPOINT_CONF) or sc.getCheckpointDir()
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the scratch folder, removed when the driver process ends."""
    d = f"{scratch_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
    atexit.register(remove_dir, spark, d)
    return d


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, if the session still runs (a stopped one can't reach its storage)."""
    jsc = spark.sparkContext._jsc
    if jsc is None or jsc.sc().isStopped():
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Delete the shuffle files of each query that runs meanwhile as soon as it has ended.

    By default they stay until the driver happens to collect its garbage, so that
    a job of many queries holds those of nearly all of them.  A result whose plan
    runs once more (nothing here does) has to make its shuffles anew.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


# Settings the library is designed around (AQE re-plans joins and coalesces
# partitions at runtime; skew-join splitting handles hot join keys).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def sizing_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle / scan sizing for a given input volume (a starting point; AQE adjusts).

    * shuffle partitions: enough that one partition is about ``partition_bytes``
      of input (so a task's sort / aggregation buffers fit executor memory and
      spill stays bounded), and at least two waves of tasks over all cores;
      AQE then coalesces small partitions and splits skewed ones at runtime;
    * ``maxPartitionBytes``: scan splits of the same size.
    """
    shuffle = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        **RECOMMENDED_CONF,
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Local session for tests and benchmarks (Spark UI off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         # no Python call-site capture per Column expression (error-message aid
         # that costs a JVM round trip per function call while building plans)
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         # let Spark's cleaner drop checkpoint files of RDDs no longer referenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
