"""Ordered threshold banding (first matching threshold wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price bands on the selling price, upper bounds exclusive.
PRICE_BANDS = [(100, "Bas"), (500, "Moyen"), (2000, "Haut")]
PRICE_BAND_TOP = "Premium"

# Purchase frequency bands on the number of orders, lower
# bounds inclusive.
FREQUENCY_BANDS = [(10, "Très fréquent"), (5, "Fréquent"), (2, "Occasionnel")]
FREQUENCY_BAND_BOTTOM = "Unique"

# Return-rate bands on the rate in percent, lower bounds
# exclusive.
RETURN_BANDS = [(20, "Critique"), (10, "Élevé"), (5, "Normal")]
RETURN_BAND_BOTTOM = "Faible"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _bands(cond, bands, default) -> Column:
    out = None
    for bound, label in bands:
        test = cond(bound)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(default)


def price_band(x) -> Column:
    c = _c(x)
    return _bands(lambda b: c < b, PRICE_BANDS, PRICE_BAND_TOP)


def frequency_band(x) -> Column:
    c = _c(x)
    return _bands(lambda b: c >= b, FREQUENCY_BANDS, FREQUENCY_BAND_BOTTOM)


def return_band(x) -> Column:
    c = _c(x)
    return _bands(lambda b: c > b, RETURN_BANDS, RETURN_BAND_BOTTOM)
