"""Typing and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "yyyy-MM-dd"

# neither digit nor sign nor what a cast trims (white space, control characters)
_NOT_WHOLE = r"[^0-9+\-\x00-\x20\x7F]"


def typed_column(df: DataFrame, name: str, target: str) -> Column:
    """Convert ``df[name]`` to ``target`` without raising on bad input.

    Bronze tables read from CSV are all-string; bronze views built from
    typed sources already carry the right type.  Text is parsed with
    ``try_cast`` / ``try_to_date`` so malformed values become NULL (ANSI mode
    would otherwise fail the whole job), and so do NaN and infinities.  A text,
    date or integer already of the target type is passed through untouched.
    """
    src = df.schema[name].dataType
    c = F.col(name)
    if target == "date":
        if isinstance(src, T.DateType):
            return c
        if isinstance(src, (T.TimestampType, T.TimestampNTZType)):
            return c.cast("date")
        return F.try_to_date(c.cast("string"), DATE_FORMAT)
    if target == "string":
        return c if isinstance(src, T.StringType) else c.cast("string")
    if target in ("double", "float"):
        return finite(c.try_cast(target))
    if target in ("int", "bigint") and not isinstance(src, T.IntegralType):
        # "3.0" (how a reader that saw an empty field writes integers) is 3; fractions are cut, as a cast of the
        # number would
        number = c if isinstance(src, T.FractionalType) else c.try_cast("double")
        whole = finite(number).try_cast(target)
        if isinstance(src, T.FractionalType):
            return whole
        # a text cast that fails throws and catches an exception inside Spark, for "3.0" in every row: text with a
        # character that no integer has is not tried
        direct = F.when(~c.rlike(_NOT_WHOLE), c.try_cast(target)) if isinstance(src, T.StringType) else c.try_cast(target)
        return F.coalesce(direct, whole)
    return c.try_cast(target)


def finite(c: Column) -> Column:
    """NULL for NaN and infinities, which compare as larger than any amount and cannot be summed as cents."""
    return F.when(F.abs(c) < float("inf"), c)


def calendar_columns(date_col: str = "date", with_quarter: bool = True) -> dict[str, Column]:
    """annee / mois / semaine (ISO week) / trimestre of a date column."""
    d = F.col(date_col)
    cols = {
        "annee": F.year(d),
        "mois": F.month(d),
        "semaine": F.weekofyear(d),
    }
    if with_quarter:
        cols["trimestre"] = F.quarter(d)
    return cols
