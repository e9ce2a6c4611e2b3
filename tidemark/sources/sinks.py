"""Table writers.

* Full refresh by path: the new table is written beside the old one and
  published by renaming only when it is complete, so a failed run leaves the
  old table as it was.  Between the two renames there is a moment without a
  table at the path; readers that can't have that use the catalog form.
* Full refresh in the session's catalog (``write_catalog_table``): every
  refresh writes a table of its own (a version), and the table's name is a view
  of the latest one.  ``CREATE OR REPLACE VIEW`` is one catalog operation that
  changes schema and data together, so the name is never missing or half
  written, and a table can be read and replaced by itself: the running read
  stays on the version that it began with, which is kept until the next refresh.
* Partitioned layout: rows are rebalanced on the partition columns before
  the write (``rebalance`` hint): rows of one partition value are grouped so
  few files are written per value, and AQE splits an oversized value (a hot
  month) across several tasks and merges small ones, so files stay near the
  advisory size.  A caller that has dealt the rows by them already says so (``dealt``).
* Files are sorted by the partition columns then the first other column
  (``date`` for daily tables), which also tightens parquet min/max
  statistics for range filters on it.  With ``range_by`` the files hold
  disjoint ranges of that column instead (``repartitionByRange``).
* Row counts come from an ``Observation`` collected during the write — the
  same pass, no second execution of the plan.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_run_dir, remove_dir
from tidemark.sources.files import CORRUPT


_VERSION = re.compile(r"__v\d{20}_[0-9a-f]{6}$")


def _prepared(df: DataFrame, partition_by: Sequence[str], audit_column: str | None, range_by: str | None = None,
              dealt: bool = False) -> DataFrame:
    if audit_column:
        df = df.withColumn(audit_column, F.current_timestamp())
    if range_by:
        # ties stay together, so no two files share a value; a value that is hot makes one large file
        return df.repartitionByRange(range_by).sortWithinPartitions(range_by)
    if partition_by:
        rest = [c for c in df.columns if c not in partition_by and c != audit_column]
        order = [*partition_by, *rest[:1]]
        # rebalance: hash on the partition columns, then AQE splits oversized
        # partitions (a hot month) and merges small ones — bounded file sizes,
        # no sampling pass.  The sort satisfies the writer's own ordering
        # requirement, so it replaces (not adds) a sort.
        df = (df if dealt else df.hint("rebalance", *partition_by)).sortWithinPartitions(*order)
    return df


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and its rows and those that could not be parsed, counted while it is written."""
    obs = Observation()
    corrupt = F.count(F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None))
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), corrupt.alias("corrupt")), obs


def _counts(obs: Observation) -> tuple[int, int]:
    return int(obs.get["rows"]), int(obs.get["corrupt"] or 0)


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  audit_column: str | None = "_updated_at", compression: str = "snappy",
                  range_by: str | None = None, dealt: bool = False) -> tuple[int, int]:
    """Write ``df`` to ``path`` as parquet (full refresh); return its rows, and those that could not be parsed.

    ``dealt``: the rows of a partition value lie in few tasks already, and are not dealt again.
    """
    df, obs = _observed(_prepared(df, partition_by, audit_column, range_by, dealt))
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(new)
    except Exception:
        remove_dir(df.sparkSession, new)
        raise
    _publish(df.sparkSession, new, path)
    return _counts(obs)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), audit_column: str | None = "_updated_at",
                compression: str = "snappy", range_by: str | None = None) -> int:
    """Write ``df`` to ``path`` as parquet (full refresh); return the row count."""
    return write_counted(df, path, partition_by, audit_column, compression, range_by)[0]


def _publish(spark: SparkSession, new: str, path: str) -> None:
    """Put a complete table in the place of the old one, which is deleted last."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = p(f"{new}.old")
    replaced = fs.exists(p(path)) and fs.rename(p(path), old)
    if not fs.rename(p(new), p(path)):
        if replaced:
            fs.rename(old, p(path))
        raise OSError(f"could not publish {path}")
    if replaced:
        fs.delete(old, True)


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def write_catalog_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None,
                        audit_column: str | None = "_updated_at", compression: str = "snappy", keep: int = 2,
                        dealt: bool = False) -> tuple[int, int]:
    """Replace ``schema.table`` of the session's catalog by ``df``, creating the schema; return the counts of ``write_counted``.

    ``df`` may read the table itself.  Its schema may change.  The files lie in a
    folder per version, below ``path`` or the schema's location.  The ``keep``
    latest versions stay, the others are dropped with their files.  A table of
    that name which this function did not write becomes the oldest version, by
    one rename before the first switch.
    """
    spark = df.sparkSession
    schema, _, table = name.rpartition(".")
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}")
    schema = schema or spark.catalog.currentDatabase()
    version = f"{table}__v{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}"
    location = f"{(path or spark.catalog.getDatabase(schema).locationUri).rstrip('/')}/{version}"
    df, obs = _observed(_prepared(df, partition_by, audit_column, dealt=dealt))
    w = df.write.format("parquet").option("compression", compression).option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.saveAsTable(_quoted(schema, version))
    except Exception:
        _drop_version(spark, schema, version, location)
        raise
    if spark.catalog.tableExists(_quoted(schema, table)) and spark.catalog.getTable(_quoted(schema, table)).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {_quoted(schema, table)} RENAME TO {_quoted(schema, f'{table}__v{0:020}_{0:06}')}")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(schema, table)} AS SELECT * FROM {_quoted(schema, version)}")
    for old in versions(spark, schema, table)[:-keep]:
        where = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(schema, old)}").where("col_name = 'Location'").first()
        _drop_version(spark, schema, old, where.data_type)
    return _counts(obs)


def _drop_version(spark: SparkSession, schema: str, version: str, location: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(schema, version)}")
    remove_dir(spark, location)


def versions(spark: SparkSession, schema: str, table: str) -> list[str]:
    """The versions of a table, the oldest first."""
    return sorted(t.name for t in spark.catalog.listTables(schema)
                  if not t.isTemporary and _VERSION.search(t.name) and _VERSION.sub("", t.name).lower() == table.lower())


def list_layer(spark: SparkSession, schema: str) -> list[str]:
    """The tables of a layer in the session's catalog, without their versions."""
    if not spark.catalog.databaseExists(schema):
        return []
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary and not _VERSION.search(t.name))


class FolderStore:
    """Layers of tables as folders: ``root/layer/table``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (),
              audit_column: str | None = "_updated_at", dealt: bool = False) -> tuple[int, int]:
        return write_counted(df, f"{self.root}/{layer}/{table}", partition_by, audit_column, dealt=dealt)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{layer}/{table}")

    def tables(self, layer: str) -> list[str]:
        """The tables that the layer holds (names with a dot are being written)."""
        return sorted(n for n in list_dir(self.spark, f"{self.root}/{layer}") if "." not in n)


class CatalogStore:
    """Layers of tables in the session's catalog: schema ``prefix`` + layer, files below ``root``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def write(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (),
              audit_column: str | None = "_updated_at", dealt: bool = False) -> tuple[int, int]:
        return write_catalog_table(df, f"{self.prefix}{layer}.{table}", partition_by, f"{self.root}/{layer}", audit_column,
                                   dealt=dealt)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(_quoted(f"{self.prefix}{layer}", table))

    def tables(self, layer: str) -> list[str]:
        return list_layer(self.spark, f"{self.prefix}{layer}")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that the session can reach; none if it does not exist."""
    p, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def file_states(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Path, size and time of change of each file, in order."""
    out = []
    for path in sorted(paths):
        p, fs = _path(spark, path)
        state = fs.getFileStatus(p)
        out.append(f"{path}:{state.getLen()}:{state.getModificationTime()}")
    return out


def file_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of all the files."""
    return sum(fs.getFileStatus(p).getLen() for p, fs in (_path(spark, path) for path in paths))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole or not at all."""
    p, fs = _path(spark, f"{path}.new-{uuid.uuid4().hex[:12]}")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    target = _path(spark, path)[0]
    fs.delete(target, False)
    fs.rename(p, target)


def read_texts(spark: SparkSession, path: str) -> list[str]:
    """The small files of a folder (names with a dot are being written)."""
    names = [n for n in list_dir(spark, path) if "." not in n]
    return [r.value for r in spark.read.text([f"{path}/{n}" for n in names], wholetext=True).collect()] if names else []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return it read back.

    For intermediates consumed by several branches of one plan: each branch
    would otherwise recompute the whole upstream (Spark reuses identical
    shuffles, but branches pruned to different columns are not identical).
    The written table also cuts the lineage, so a lost executor re-reads it
    instead of recomputing from the sources.
    """
    path = new_run_dir(df.sparkSession, label)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
