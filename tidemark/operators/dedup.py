"""Deterministic deduplication.

``dropDuplicates`` keeps an arbitrary row per key, so which copy survives
(and therefore every later filter and aggregate) can change between runs.
``keep_first`` keeps the first row under a total order of the remaining
columns (ascending, NULLs last) instead.

Plan: ``row_number() == 1`` is planned by Catalyst with a *partial*
``WindowGroupLimit`` before the shuffle, so each map task forwards at most
one row per key.  A key that holds a third of the table therefore reaches
its reducer as one row per map task, not as a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__dedup_rn"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (default: all other columns)."""
    keys = list(keys)
    if order is None:
        order = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
