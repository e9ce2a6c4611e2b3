"""Column -> Column building blocks (money, text repair, calendar, bands)."""

from tidemark.functions.bands import (
    frequency_band,
    price_band,
    return_band,
)
from tidemark.functions.calendar import calendar_columns, typed_column
from tidemark.functions.money import (
    basis_points,
    cents,
    from_cents,
    half_up,
    half_up_ratio,
    half_up_signed,
    idiv,
    pct_of,
)
from tidemark.functions.text import (
    canonical_segment,
    fix_category,
    fix_encoding,
    fix_reason,
    fix_refund_status,
    fix_sale_status,
    repair_mojibake,
    strip_spaces,
)

__all__ = [
    "basis_points",
    "calendar_columns",
    "canonical_segment",
    "cents",
    "fix_category",
    "fix_encoding",
    "fix_reason",
    "fix_refund_status",
    "fix_sale_status",
    "frequency_band",
    "from_cents",
    "half_up",
    "half_up_ratio",
    "half_up_signed",
    "idiv",
    "pct_of",
    "price_band",
    "repair_mojibake",
    "return_band",
    "strip_spaces",
    "typed_column",
]
