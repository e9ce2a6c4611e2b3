"""Value canonicalisation from a table of rules.

The rules are a table (key, value), joined to the column's trimmed, lower-case
values.  Keys must be unique after the same treatment, so that no row is
doubled; the join carries no hint, and a hot value is split by adaptive
execution.  Values without a rule stay as they are (trimmed), or become NULL,
and can be reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keyed(rules: DataFrame) -> DataFrame:
    return rules.select(F.lower(F.trim("key")).alias("_key"), F.col("value").alias("_value"))


def check_rules(rules: DataFrame) -> None:
    """Fail on keys that are empty or occur twice, naming some."""
    bad = _keyed(rules).groupBy("_key").count().where("count > 1 OR _key IS NULL OR _key = ''")
    found = [r["_key"] for r in bad.limit(5).collect()]  # a few names for the message
    if found:
        raise ValueError(f"rule keys must be unique and not empty: {found}")


def canonicalise(df: DataFrame, column: str, rules: DataFrame, keep_unknown: bool = True) -> DataFrame:
    """``df`` with the rules' values in ``column``, and _matched (NULL for a NULL)."""
    check_rules(rules)
    rules = _keyed(rules)
    key = F.lower(F.trim(df[column]))
    joined = df.join(rules, key == rules["_key"], "left")
    matched = rules["_key"].isNotNull()
    value = F.when(matched, F.col("_value"))
    out = value.otherwise(F.trim(df[column])) if keep_unknown else value
    return joined.select(*[out.alias(column) if c == column else df[c] for c in df.columns],
                         F.when(df[column].isNotNull(), matched).alias("_matched"))


def unmatched(df: DataFrame, column: str, rules: DataFrame) -> DataFrame:
    """value, rows: the values that no rule covers, as they stand in ``df``."""
    check_rules(rules)
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    rules = _keyed(rules)
    return values.join(rules, F.lower(F.trim("value")) == rules["_key"], "left_anti")
