"""Types from the data: CSV columns and JSON records.

* CSV: files are read as text, and one aggregate over all of them tells each
  column's type, whatever the number of files: every value is placed in the
  lattice empty < integer < decimal < double, date, text, and a column gets the
  least type that holds all of its values.  Digits with a leading zero (a phone
  number, a postcode) are text.  The same pass counts rows and empty values.
* JSON: records are parsed as VARIANT, and ``schema_of_variant_agg`` merges
  their schemas, also those of nested records: fields that only some records
  have, and numbers of several kinds.  Values of types that don't merge are text.

Reads are typed with ``try_cast`` (``try_variant_get``); nothing is sampled.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import CORRUPT, csv_columns, csv_reader, with_lineage

_DECIMAL = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_NUMBER = r"^([+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MAX_DIGITS = 38
# what a decimal holds beside its digits and point: a sign in front, a line end behind
_BESIDE = "+-\n\r\u0085\u2028\u2029"
# the kinds of a filled value, those of a number first
_INT, _LONG, _DIGITS, _FRACTION, _FLOAT, _DAY, _OTHER = range(1, 8)


def _range(bits: int) -> tuple[Column, Column]:
    return F.lit(Decimal(-2 ** bits)), F.lit(Decimal(2 ** bits - 1))


def _kind() -> Column:
    """The kind of a value ``v`` (NULL if null, 0 if empty) whose text as a decimal is ``d``.

    A pattern is matched once, and only where those before did not match.  No cast
    is tried that would fail: Spark throws and catches an exception for each.
    """
    v, digits = F.col("v"), F.col("d")
    whole = v.try_cast(f"decimal({_MAX_DIGITS},0)")
    return (F.when(digits.isNotNull() & (F.instr(digits, ".") == 0),
                   F.when(whole.between(*_range(31)), _INT).when(whole.between(*_range(63)), _LONG).otherwise(_DIGITS))
            .when(digits.isNotNull(), _FRACTION).when(v.isNull(), F.lit(None).cast("int")).when(v == "", 0)
            .when(v.rlike(_NUMBER), _FLOAT)
            .when(v.rlike(_DATE) & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), _DAY).otherwise(_OTHER))


def column_types(text: DataFrame) -> DataFrame:
    """column_name, type_name, rows, empty of each column of a text table, in one pass.

    A column without any value is ``void``; so is every column of an empty table.
    The values of a row are one row each, (column number, value), so that the code
    for one value is compiled once, whatever the number of columns.
    """
    names = [f"c{k}" for k in range(len(text.columns))]  # any name may clash
    pairs = ", ".join(f"{k}, {n}" for k, n in enumerate(names))
    values = text.toDF(*names).select(F.expr(f"stack({len(names)}, {pairs}) AS (c, v)")).withColumn("v", F.trim("v"))
    digits = values.withColumn("d", F.when(F.col("v").rlike(_DECIMAL), F.translate("v", _BESIDE, "")))
    point, kind = F.instr("d", "."), F.col("kind")
    placed = digits.select("c", _kind().alias("kind"), F.when(point == 0, F.length("d")).otherwise(point - 1).alias("w"),
                           F.when(point > 0, F.length("d") - point).alias("f"))
    one = placed.groupBy("c").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(kind >= _INT).alias("filled"), F.count_if(kind == _INT).alias("ints"),
        F.count_if(kind.between(_INT, _LONG)).alias("longs"), F.count_if(kind.between(_INT, _FRACTION)).alias("decimals"),
        F.count_if(kind.between(_INT, _FLOAT)).alias("numbers"), F.count_if(kind == _DAY).alias("dates"),
        F.coalesce(F.max("w"), F.lit(0)).alias("whole_digits"), F.coalesce(F.max("f"), F.lit(0)).alias("fraction_digits"))
    # every column is a row, also of an empty table
    columns = text.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("c"), F.get(F.array(*map(F.lit, text.columns)), F.col("id").cast("int")).alias("column_name"))
    rows = columns.join(one, "c", "left").fillna(0)
    digits = F.col("whole_digits") + F.col("fraction_digits")
    kind = (F.when(F.col("filled") == 0, "void").when(F.col("ints") == F.col("filled"), "int")
            .when(F.col("longs") == F.col("filled"), "bigint")
            .when((F.col("decimals") == F.col("filled")) & (digits <= _MAX_DIGITS),
                  F.concat(F.lit("decimal("), digits.cast("string"), F.lit(","), F.col("fraction_digits").cast("string"), F.lit(")")))
            .when(F.col("numbers") == F.col("filled"), "double").when(F.col("dates") == F.col("filled"), "date").otherwise("string"))
    return rows.select("column_name", kind.alias("type_name"), "rows", (F.col("rows") - F.col("filled")).alias("empty"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """The CSV file or folder as text, with the malformed lines' column."""
    return csv_reader(spark.read, csv_columns(spark, path)).csv(path)


def infer_csv(spark: SparkSession, path: str) -> DataFrame:
    """column_name, type_name, rows, empty of a CSV file or folder; malformed lines take no part."""
    text = read_text(spark, path)
    return column_types(text.where(F.col(CORRUPT).isNull()).drop(CORRUPT))


def ingest_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder of an unknown table with inferred types, malformed lines and lineage."""
    types = {r.column_name: r.type_name for r in infer_csv(spark, path).collect()}  # one row per column
    text = with_lineage(read_text(spark, path))
    typed = [_typed(F.col(f"`{c}`"), t).alias(c) for c, t in types.items()]
    return text.select(*typed, CORRUPT, "_ingested_at", "_source_file")


def _typed(value: Column, kind: str) -> Column:
    if kind in ("string", "void"):
        return value
    if kind == "date":  # a cast would also take a year alone
        return F.try_to_date(F.trim(value), "yyyy-MM-dd")
    return F.trim(value).try_cast(kind)


# ── JSON ────────────────────────────────────────────────────────────────

# a field's name (quoted, or before its colon) stays; types are renamed
_TOKEN = re.compile(r"(?P<name>`(?:[^`]|``)*`|\w+(?=\s*:))|OBJECT<|\bVOID\b|\bVARIANT\b|DECIMAL\((?P<digits>\d+),\s*(?P<scale>\d+)\)")


def variant_ddl(schema: str | None) -> str | None:
    """The type in DDL of what ``schema_of_variant_agg`` tells; null if the records are not objects.

    Whole numbers beyond a bigint stay decimals, other decimals are doubles, and
    what has no type or several becomes text.
    """
    def ddl(m: re.Match) -> str:
        if m["name"]:
            return m[0]
        if m["digits"]:
            return f"DECIMAL({m['digits']},0)" if m["scale"] == "0" else "DOUBLE"
        return "STRUCT<" if m[0] == "OBJECT<" else "STRING"

    return _TOKEN.sub(ddl, schema) if schema and schema.startswith("OBJECT<") and schema != "OBJECT<>" else None


def ingest_json_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON records, one a line or one a file, with the schema that all of them together have.

    A line that cannot be parsed, or is no object, is a row of NULLs with its text in
    the corrupt column.  Lineage columns are added.
    """
    text = with_lineage(spark.read.text(path, wholetext=multi_line)).where(F.trim("value") != "")
    rows = text.withColumn("_v", F.try_parse_json("value"))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT<")), F.lit(False))
    ddl = variant_ddl(rows.where(is_object).agg(F.schema_of_variant_agg("_v")).first()[0])
    bad = F.when(~is_object, F.col("value")).alias(CORRUPT)
    if ddl is None:
        return rows.select(bad, "_ingested_at", "_source_file")
    record = F.when(is_object, F.try_variant_get("_v", "$", ddl)).alias("_r")
    return rows.select(record, bad, "_ingested_at", "_source_file").select("_r.*", CORRUPT, "_ingested_at", "_source_file")
