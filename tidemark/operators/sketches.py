"""Distinct counts that can be rolled up without reading the sales again.

A distinct count can't be added up: a customer of two days is one customer of
the month.  A sketch per day and channel, stored as a binary column, can: the
union of sketches estimates the distinct count of any group of days and
channels.  Sketches are HyperLogLog (``hll_sketch_agg``), of fixed size.

``ERROR`` is the bound stated for ``LG_K``: five standard errors of a union,
1.04 / sqrt(2^LG_K) each, and one for rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
ERROR = 5 * 1.04 / 2 ** (LG_K / 2)


def daily_sketches(sales: DataFrame, column: str = "id_client", lg_k: int = LG_K) -> DataFrame:
    """date, id_canal, n (rows), sketch (of the distinct values): what is stored."""
    return sales.groupBy("date", "id_canal").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(column, lg_k).alias("sketch"))


def rolled_up(sketches: DataFrame, keys: Sequence[str], **derived: Column) -> DataFrame:
    """``keys`` (some of them ``derived`` from the stored columns), n, distinct_estimate."""
    return sketches.withColumns(derived).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def within_bound(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= 1 + F.lit(ERROR) * exact
