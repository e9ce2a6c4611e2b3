"""Text normalisation: mojibake repair and value canonicalisation.

``fix_encoding`` and the per-column rules reproduce a fixed rule table of
known broken spellings; ``repair_mojibake`` is the general repair of UTF-8
text that was decoded as Latin-1 / Windows-1252, ``repair_mojibake_runs`` the
same for values of which only parts are broken.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# The literal repair table of the original pipeline, applied in
# this order (innermost first).  Pairs of (broken text, repaired text).
ENCODING_RULES = [
    ('FÃ"s', "Fès"),
    ("MarrakÃ©ch", "Marrakech"),
    ("Ã©", "é"),
    ("Ã ", "à"),
]

# Category repair, regular expressions and their replacement.
CATEGORY_RULES = [
    ("A%olectronique", "Électronique"),
    ("Ã©lectronique", "Électronique"),
]

# Sale status repair, applied after trim + lower-case.
SALE_STATUS_RULES = [
    ("livrã©|livrã@|livrÃ©", "livré"),
]

# Return reason repair.
REASON_RULES = [
    ("ArrivÃ©|ArrivÃ@", "Arrivé"),
    ("endommagÃ©|endommagÃ@", "endommagé"),
]

# Refund status repair; leftover "Ã" is deleted last.
REFUND_STATUS_RULES = [
    ("remboursÃ©|remboursÃ@", "remboursé"),
    ("Ã", ""),
]

# Customer segment spellings, matched case-insensitively.
SEGMENT_CANONICAL = [
    ("premium", "Premium"),
    ("standard", "Standard"),
    ("vip", "VIP"),
]


def _literal_rules(c: Column, rules) -> Column:
    for broken, fixed in rules:
        c = F.replace(c, F.lit(broken), F.lit(fixed))
    return c


def _regex_rules(c: Column, rules) -> Column:
    for pattern, fixed in rules:
        c = F.regexp_replace(c, pattern, fixed)
    return c


def fix_encoding(x) -> Column:
    """Literal repair table for city / region / channel / depot names."""
    return _literal_rules(_c(x), ENCODING_RULES)


def fix_category(x) -> Column:
    return _regex_rules(_c(x), CATEGORY_RULES)


def fix_sale_status(x) -> Column:
    return _regex_rules(F.lower(F.trim(_c(x))), SALE_STATUS_RULES)


def fix_reason(x) -> Column:
    return _regex_rules(_c(x), REASON_RULES)


def fix_refund_status(x) -> Column:
    return _regex_rules(_c(x), REFUND_STATUS_RULES)


def canonical_segment(x) -> Column:
    """Case-insensitive canonical spelling; unknown values pass through."""
    c = _c(x)
    low = F.lower(c)
    out = None
    for key, canon in SEGMENT_CANONICAL:
        out = F.when(low == key, canon) if out is None else out.when(low == key, canon)
    return out.otherwise(c)


def strip_spaces(x) -> Column:
    """Remove every whitespace run (phone numbers)."""
    return F.regexp_replace(_c(x), r"\s+", "")


# The printable Windows-1252 characters of bytes 0x80-0x9F, in
# byte order (0x81, 0x8D, 0x8F, 0x90 and 0x9D are unassigned and skipped).
_CP1252_HIGH = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_CP1252_BYTES = [
    0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C,
    0x8E, 0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B,
    0x9C, 0x9E, 0x9F,
]
_C1_CONTROLS = "".join(chr(b) for b in _CP1252_BYTES)


def repair_mojibake(x) -> Column:
    """General repair of UTF-8 text mis-decoded as Latin-1 / Windows-1252.

    The value is mapped back to the bytes it was decoded from and re-read as
    UTF-8.  It is only attempted when the text looks like mojibake (a lead
    byte followed by a continuation byte) and consists solely of characters
    below U+0100 after mapping, since ``encode`` raises on anything else.
    Values that do not form valid UTF-8 are returned unchanged.
    """
    c = _c(x)
    pre = F.translate(c, _CP1252_HIGH, _C1_CONTROLS)
    candidate = F.try_validate_utf8(F.encode(pre, "ISO-8859-1"))
    looks_broken = pre.rlike("[Â-ô][\u0080-¿]")
    latin1_only = ~pre.rlike("[^\\x{0000}-\\x{00FF}]")
    return F.when(looks_broken & latin1_only, F.coalesce(candidate, c)).otherwise(c)


# one character that was a lead byte, and as many as that byte announces that were continuation bytes
_CONTINUED = f"[\u0080-\u00bf{_CP1252_HIGH}]"
_BROKEN = f"[Â-ß]{_CONTINUED}|[à-ï]{_CONTINUED}{{2}}|[ð-ô]{_CONTINUED}{{3}}"


def repair_mojibake_runs(x) -> Column:
    """Repair of the broken parts of a value; sound parts, in any script, stay.

    The value is split into sequences that look like one mis-decoded character
    and everything between them.  Each sequence is mapped back to its bytes and
    re-read as UTF-8, on its own, and stays as it is if that is not valid.
    """
    c = _c(x)
    parts = F.regexp_extract_all(c, F.lit(f"(?s){_BROKEN}|[^Â-ô]+|."), F.lit(0))

    def mended(part: Column) -> Column:
        data = F.encode(F.translate(part, _CP1252_HIGH, _C1_CONTROLS), "ISO-8859-1")
        return F.when(part.rlike(f"^(?:{_BROKEN})$"), F.coalesce(F.try_validate_utf8(data), part)).otherwise(part)

    return F.when(c.rlike(_BROKEN), F.array_join(F.transform(parts, mended), "")).otherwise(c)
