"""File sources: declared-schema CSV and JSON readers with lineage columns.

* CSV: columns bound by the header's names, UTF-8, all text (no inference
  scan), ``PERMISSIVE`` mode with malformed lines kept in ``_corrupt_record``;
  silver leaves those lines out (``well_formed``) and the load report counts them.
* JSON: line-delimited records, or whole-file documents (``multi_line``)
  such as an API response; an envelope ``{"products": [...]}`` is unwrapped
  with ``explode``.  A single JSON document cannot be split, so a whole-file
  document is read by one task — land feeds as many files or as
  line-delimited JSON when they are large.
* Lineage: ``_ingested_at`` (load time) and ``_source_file`` (the file each
  row actually came from, via the ``_metadata`` column).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import schemas

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_source_file": F.col("_metadata.file_path"),
    })


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header of the CSV file, or of the first file of the folder."""
    return spark.read.option("header", True).option("encoding", "UTF-8").csv(path).columns


def header_difference(found: list[str], schema: T.StructType) -> tuple[list[str], list[str]]:
    """(columns of the schema that the header lacks, header columns that the schema lacks)."""
    return [c for c in schema.names if c not in found], [c for c in found if c not in schema.names]


def by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of a text read by name (NULL where the file lacks one), the corrupt line, and the lineage."""
    return with_lineage(df).select(
        *[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in schema.fields], CORRUPT, "_ingested_at", "_source_file")


def well_formed(df: DataFrame) -> DataFrame:
    """Rows whose line or document could be parsed; all rows of a frame without that column."""
    return df.filter(F.col(CORRUPT).isNull()) if CORRUPT in df.columns else df


def csv_reader(reader, columns: list[str]):
    """Reader options for text columns in the header's own order.

    ``enforceSchema`` is off: a file of the folder whose header has another
    order fails the read, instead of having its values bound by position.
    """
    return (reader.schema(_with_corrupt(schemas._strings(*columns)))
            .option("header", True)
            .option("enforceSchema", False)
            .option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def ingest_csv(spark: SparkSession, table: str, path: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Read one raw CSV table (file or folder) into its bronze shape.

    Columns are bound by the header's names.  Columns that the schema lacks are
    left out and missing ones are NULL; ``header_difference`` names both.
    """
    schema = schema or schemas.BRONZE[table]
    return by_name(csv_reader(spark.read, csv_columns(spark, path)).csv(path), schema)


def ingest_all(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Bronze frames for several tables: ``{table: csv path}``."""
    return {table: ingest_csv(spark, table, path) for table, path in paths.items()}


def ingest_json(spark: SparkSession, path: str, schema: T.StructType = schemas.FEED_NESTED,
                multi_line: bool = False) -> DataFrame:
    """Read JSON records with a declared schema (booleans / nulls kept intact)."""
    df = (spark.read.schema(_with_corrupt(schema))
          .option("multiLine", multi_line)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT)
          .json(path))
    return with_lineage(df)


def ingest_json_envelope(spark: SparkSession, path: str, field: str = "products",
                         record: T.StructType = schemas.FEED_FLAT_RECORD,
                         multi_line: bool = True) -> DataFrame:
    """Read documents ``{field: [record, ...]}`` and return one row per record.

    A document that cannot be parsed is one row of NULLs with its text in the
    corrupt column.
    """
    envelope = _with_corrupt(T.StructType([T.StructField(field, T.ArrayType(record))]))
    df = (spark.read.schema(envelope).option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    records = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(None).cast(record))).otherwise(F.col(field))
    rows = df.select(F.explode(records).alias("_r"), CORRUPT, F.col("_metadata.file_path").alias("_source_file"))
    return rows.select("_r.*", CORRUPT, F.current_timestamp().alias("_ingested_at"), "_source_file")
