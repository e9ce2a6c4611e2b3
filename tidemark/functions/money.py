"""Exact money arithmetic.

Money is summed as integer cents and divided with an integer half-up
formula, so results do not depend on the order in which partial sums are
combined (floating-point sums do, which makes rounded totals differ between
runs and between engines).  The public columns stay ``double`` rounded to
two decimals, as in the original pipeline.

Per-row arithmetic runs in bigint (cheap, inside whole-stage codegen) and
falls back to decimal(38,0) only for values whose bigint form overflows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(num, den) -> Column:
    """Integer division (SQL ``div``): truncates toward zero, returns bigint."""
    return F.call_function("div", _c(num), _c(den))


def _hundredths(x) -> Column:
    """``round(x * 100)`` of a double, halves away from zero, as a bigint.

    ``round`` goes through the number's text and a BigDecimal, for every row;
    ``rint`` does not, but takes halves to the even side, which is mended.  The
    difference to the nearest whole number is exact.
    """
    y = _c(x) * 100
    nearest = F.rint(y)
    return F.when(F.abs(y - nearest) == 0.5, y + F.signum(y) * 0.5).otherwise(nearest).try_cast("bigint")


def cents(x) -> Column:
    """Currency amount (double) -> bigint cents, rounded half-up; NULL if not finite or beyond a bigint."""
    return _hundredths(x)


def basis_points(x) -> Column:
    """Percentage (double) -> bigint hundredths of a percent."""
    return _hundredths(x)


def from_cents(x) -> Column:
    """bigint / decimal cents -> double currency amount."""
    return _c(x).cast("double") / 100


DECIMAL = "decimal(38,0)"


def _pair(nb: Column, db: Column, nd: Column, dd: Column) -> Column:
    """Half-away-from-zero nb/db for db > 0, in bigint; decimal(38,0) on overflow.

    ``(2n + sign(n)*d) div 2d`` with truncating ``div``.  The bigint form uses
    ``try_*`` arithmetic, which yields NULL instead of overflowing; only then
    is the decimal form (nd, dd: the same values, wide) evaluated.
    """
    fast = idiv(F.try_add(F.try_multiply(nb, F.lit(2)), F.when(nb < 0, -db).otherwise(db)),
                F.try_multiply(db, F.lit(2)))
    slow = idiv(nd * 2 + F.when(nd < 0, -dd).otherwise(dd), dd * 2)
    return F.coalesce(fast, slow)


def half_up_ratio(num, den, wide_num=None) -> Column:
    """round(num / den), halves away from zero, any signs; NULL if den is 0 or NULL.

    ``num`` and ``den`` are integral.  ``wide_num`` optionally gives the same
    numerator computed in decimal(38,0) for the overflow fallback (when the
    numerator itself is a product that may overflow a bigint).
    """
    n, d = _c(num), _c(den)
    nd = (_c(wide_num) if wide_num is not None else n).cast(DECIMAL)
    dd = d.cast(DECIMAL)
    nb, db = n.try_cast("bigint"), d.try_cast("bigint")
    flip = d < 0
    minus_one = F.lit(-1).cast("bigint")
    q = _pair(F.when(flip, F.try_multiply(nb, minus_one)).otherwise(nb),
              F.when(flip, F.try_multiply(db, minus_one)).otherwise(db),
              F.when(flip, -nd).otherwise(nd), F.abs(dd))
    return F.when(d != 0, q)


def half_up(num, den) -> Column:
    """round(num / den), halves away from zero, for den > 0; NULL otherwise."""
    return F.when(_c(den) > 0, half_up_ratio(num, den))


def half_up_signed(num, den) -> Column:
    """Half-up (away from zero) rounding of num / den for any signs; NULL if den = 0."""
    return half_up_ratio(num, den)


def pct_of(part, whole, scale: int = 2) -> Column:
    """Signed percentage part/whole*100 rounded half-up to ``scale`` decimals.

    Returns a double; NULL when ``whole`` is 0 or NULL.
    """
    factor = 10 ** scale
    p = _c(part)
    fast = F.try_multiply(p.try_cast("bigint"), F.lit(100 * factor).cast("bigint"))
    wide = p.cast(DECIMAL) * (100 * factor)
    return half_up_ratio(fast, whole, wide).cast("double") / factor
