"""Layer validation: row counts, NULL keys, duplicate keys, orphan references.

Returns one long table ``(table_name, check_name, value)`` so that new checks
add rows, not columns.  All checks come from one pass: every table is read once
as (column number, value) of its key and reference columns and counted per
value (with map-side combine, so a hot key is one row), and the counts meet the
referenced keys in one join, which takes the partitioning of the counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# table -> its key column
KEYS = {
    "sales": "id_vente",
    "customers": "id_client",
    "products": "id_produit",
    "stocks": "id_stock",
    "returns": "id_retour",
    "channels": "id_canal",
}

# (fact table, foreign key column, referenced table)
REFERENCES = [
    ("sales", "id_client", "customers"),
    ("sales", "id_produit", "products"),
    ("sales", "id_canal", "channels"),
    ("returns", "id_produit", "products"),
    ("stocks", "id_produit", "products"),
]


# every checked column has a number: (table, column)
COLUMNS = [*KEYS.items(), *((fact, fk) for fact, fk, _ in REFERENCES)]
_FIGURES = ("rows", "null_keys", "duplicate_keys", "orphans")


def _numbered(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(number, value) of each numbered column: one generator over the row, whose keys are integers."""
    pairs = ", ".join(f"{k}, CAST(`{c}` AS string)" for k, c in columns.items())
    return df.select(F.expr(f"stack({len(columns)}, {pairs}) AS (c, value)"))


def validate_layers(tables: dict[str, DataFrame]) -> DataFrame:
    values = reduce(DataFrame.unionByName, (
        _numbered(tables[t], {k: c for k, (table, c) in enumerate(COLUMNS) if table == t}) for t in KEYS))
    # the keys that a table's references point to, under the number of each reference
    referred = {dim: {len(KEYS) + k: KEYS[dim] for k, (_, _, d) in enumerate(REFERENCES) if d == dim} for *_, dim in REFERENCES}
    known = reduce(DataFrame.unionByName, (_numbered(tables[dim], columns) for dim, columns in referred.items()))
    # known keys do not count, but mark the value: one aggregate instead of two and a sorted join of all values
    both = values.withColumn("held", F.lit(True)).unionByName(
        known.where("value IS NOT NULL").withColumn("held", F.lit(None).cast("boolean")))
    counts = both.groupBy("c", "value").agg(F.count("held").alias("n"), F.max(F.col("held").isNull()).alias("known"))
    there = F.col("value").isNotNull()
    n = F.col("n")
    stats = counts.groupBy("c").agg(
        F.sum(n).alias("rows"), F.sum(F.when(~there, n)).alias("null_keys"),
        F.sum(F.when(there, n - 1)).alias("duplicate_keys"),
        F.sum(F.when(there & ~F.col("known"), n)).alias("orphans"))
    # every check is a row, also of an empty table
    checks = [(k, t, f, f) for k, t in enumerate(KEYS) for f in _FIGURES[:3]]
    checks += [(len(KEYS) + k, t, "orphans", f"orphan_{fk}") for k, (t, fk, _) in enumerate(REFERENCES)]
    wanted = values.sparkSession.createDataFrame(checks, "c int, table_name string, figure string, check_name string")
    value = F.coalesce(*(F.when(F.col("figure") == f, F.col(f)) for f in _FIGURES), F.lit(0))
    return wanted.join(stats, "c", "left").select("table_name", "check_name", value.alias("value"))
