"""Personal data, also where it is disguised, as spans of the source text.

Base detectors find emails, IPv4 addresses, card numbers (16 to 19 digits,
Luhn) and international phone numbers.  Then transducers rewrite disguises:
look-alike letters and digits, zero-width characters, ``(at)`` / ``[dot]`` /
``name at host dot org`` / ``name arroba host punto es``, letters that look like
digits among digits, and digits spelled in English, French, German or Spanish,
with any white space between them.  A bare "at" before a host with literal dots
is prose ("look at example.com") unless the name has a mark in it (a dot, a
digit), follows a cue ("mail", "write to") or begins the text, a line or a
bracket.  The detectors run again on the rewritten text, and each find is
mapped back to the source characters it came from.  Base spans always stay;
a rewritten find is added unless it lies within a base span of its kind.

Every pattern takes time linear in the text.  Offsets count code points; ends
are exclusive.

Defined results: a null text has no spans and stays null when redacted.  Rows
are judged each for itself.  Extra columns are kept by ``redact`` and ignored
by ``find``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Local part, ``@`` and host with a dot: from each ``@`` to the left as far as the last find, then to the right."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as in ``KINDS``, then start."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


# fixed values: letters that look like Latin ones (Cyrillic, then Greek), in the order of the Latin letters below
LOOK_ALIKES = dict(zip("авеосрхуѕіјһԁԛԝмнткАВЕОСРХУЅІЈНКМТ" "αοενικρτυχγΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aBeocpxysijhdqwmhtkABEOCPXYSIJHKMT" "aoevikptuxyABEZHIKMNOPTYX"))
_GONE = frozenset("​‌‍⁠﻿­")
_DASHES, _DOTS = frozenset("‐‑‒–—−"), frozenset("。․．·")


@lru_cache(maxsize=4096)
def plain(c: str) -> str:
    """The ASCII character that ``c`` stands for, empty for an invisible one, or ``c`` itself."""
    if c in _GONE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c in _DASHES:
        return "-"
    if c in _DOTS:
        return "."
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


# fixed values: the digits 0 to 9 in English, French, German, Spanish
_DIGITS = ("zero one two three four five six seven eight nine", "zéro un deux trois quatre cinq six sept huit neuf",
           "null eins zwei drei vier fünf sechs sieben acht neun", "cero uno dos tres cuatro cinco seis siete ocho nueve")
DIGIT_WORDS = {w: str(d) for words in _DIGITS for d, w in enumerate(words.split())}
_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_GAP = r"[\s-]++"
_OPEN, _CLOSE = r"\s*+[(\[{<]\s*+", r"\s*+[)\]}>]\s*+"
_DOT_WORD = r"(?:dot|punkt|punto|point)"
_DOT = rf"(?:\s++{_DOT_WORD}\s++|{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE})"
# fixed values: endings with which "name at host dot ..." is an address whatever the host, and words that make
# "at ... dot" prose before any other ending
_ENDING = "(?:com|org|net|edu|gov|info|biz|io|co|eu|uk|us|ca|de|fr|es)"
_DETERMINER = ("(?:an?|the|this|that|these|those|each|every|any|some|one|no|which|what|my|your|his|her|its|our|their|another"
               "|un|une|le|la|ce|der|die|das|dem|den|ein|eine|einem|el|los|las|una|este|ese)")
# a name of the domain system: a label has up to 63 characters, the whole up to 253, so up to 127 labels
_LABEL, _ANY_DOT, _MORE = "[a-z0-9-]{1,63}", rf"(?:\.|{_DOT})", "{0,126}"
# one dot at least is disguised
_HOST = rf"(?:{_LABEL}\.){_MORE}+{_LABEL}{_DOT}(?:{_LABEL}{_ANY_DOT}){_MORE}"
_LITERAL_HOST = rf"{_LABEL}(?:\.{_LABEL}){_MORE}\.[a-z]{{2,63}}\b(?!\.[a-z0-9])"
# fixed values: words before a name that is an address when "at" and a host with literal dots follow it
_CUE = "(?:e-?mail|mail|contact|write|reach|correo|kontakt|courriel|escribe|schreib(?:e|en)?)"
_RULES = re.compile(
    rf"(?P<at>(?<=[\w.%+-]){_OPEN}(?:at|@|arroba){_CLOSE}(?=\w)"
    rf"|(?<=[\w.%+-])\s++(?:at|arroba)\s++(?={_HOST}{_ENDING}\b|(?!{_DETERMINER}{_DOT}){_HOST}[a-z]{{2,63}}\b|(?P<literal>{_LITERAL_HOST})))"
    rf"|(?P<dot>(?<=\w){_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}(?=\w)|(?<=\w)\s++{_DOT_WORD}\s++(?=\w))"
    rf"|(?P<plus>\bplus\s++(?={_WORD}\b|[0-9]))"
    rf"|(?P<run>\b{_WORD}\b(?:{_GAP}{_WORD}\b)*)", re.IGNORECASE)
# fixed values: words that stand before "at" in prose where a line or bracket begins
_PROSE = ("(?:looks?|looking|see|seen|meet|met|visit|find|found|read|buy|sold|shop|order|available|located|based|hosted|live|online|open|more"
          "|here|now|out|it|is|are|was|us|me|you|them|him|her|page|site|website|stop|stay|start|back|home|free|only|not|and|or|as)")
# before a bare "at" and a host with literal dots: a name with a mark in it, or one after a cue or where a line or bracket begins
_NAMED = re.compile(rf"(?:[\w+-]*[._%+0-9][\w.%+-]*|(?:(?:\A|[\n:<(\[])\s*+(?!{_PROSE}\Z)|\b{_CUE}(?:\s++(?:to|me|us|him|her|an|a|à))?\s++)[\w.%+-]+)\Z",
                    re.IGNORECASE)
# dots with white space on both sides, in the host after a disguised at
_SPACED = re.compile(rf"{_LABEL}(?:(?:\s++\.\s++|\.){_LABEL}){_MORE}", re.IGNORECASE)
_SPACED_DOT = re.compile(r"\s++\.\s++")
# what a text must hold for a rule to matter: a bracketed at or dot, a dot in words, a plus in words, an at before a host,
# or a spelled digit beside a digit or another spelled one
_BRACKETED = re.compile(rf"[(\[{{<]\s*+(?:at|@|arroba|{_DOT_WORD}|\.)\s*+[)\]}}>]", re.IGNORECASE)
_DOTTED = re.compile(rf"\s{_DOT_WORD}\s", re.IGNORECASE)
_PLUS = re.compile(rf"\bplus\s++(?:{_WORD}\b|[0-9])", re.IGNORECASE)
_AT = re.compile(rf"\s(?:at|arroba)\s++{_LABEL}\.", re.IGNORECASE)
_SPELLED = re.compile(rf"\b{_WORD}(?:{_GAP}{_WORD}\b|[\s.-]++[0-9])|[0-9][\s.-]++{_WORD}\b|\+\s*+{_WORD}\b", re.IGNORECASE)
# a lone spelled digit counts beside a digit, a plus or a dot; a dot in words must be of its language
_DOTS_OF = ("dot|point", "point", "punkt", "punto")
_AFTER, _BEFORE = {}, {}
for _w in DIGIT_WORDS:
    _d = "|".join(d for d, words in zip(_DOTS_OF, _DIGITS) if _w in words.split())
    _AFTER[_w] = re.compile(rf"[\s.-]++[0-9]|(?:\s++(?:{_d})\s++|{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE})\w", re.IGNORECASE)
    _BEFORE[_w] = re.compile(rf"(?:\s(?:{_d})|[(\[{{<]\s*+(?:{_DOT_WORD}|\.)\s*+[)\]}}>])\Z", re.IGNORECASE)
_EACH_WORD = re.compile(rf"({_WORD})(?:{_GAP}(?={_WORD}\b))?", re.IGNORECASE)
# fixed values: letters that look like digits, and those digits
_LETTER_DIGITS = str.maketrans("OolISB", "001158")
# an address of four numbers, or at least eight digits with usual separators, some of them such letters
_LETTERED = re.compile(r"(?<![\w.])[0-9OolISB]{1,3}(?:\.[0-9OolISB]{1,3}){3}(?![\w])|(?<![\w])(?<![0-9OolISB][ .()-])[0-9OolISB](?:[ .()-]?[0-9OolISB]){7,}+(?!\w)")
_LETTER = re.compile("[OolISB]")
_SPACES = re.compile(r"\s{2,}")


def _last_of(text: str, end: int, chars: str) -> int:
    """The end of the text before ``end`` without trailing white space and ``chars``."""
    while end and (text[end - 1].isspace() or text[end - 1] in chars):
        end -= 1
    return end


def _counts(text: str, run: re.Match) -> bool:
    """Whether spelled digits stand for digits: several do, a lone one beside a digit, a plus or a dot."""
    after = _AFTER.get(run[0].lower())
    if after is None or after.match(text, run.end()):
        return True
    a = run.start()
    # to its left: white space, dots and dashes after a digit; white space after a plus, or after a word "plus"
    near = _last_of(text, a, ".-")
    if near < a and near and text[near - 1] in "0123456789":
        return True
    near = _last_of(text, a, "")
    if near and (text[near - 1] == "+" or near < a and text[max(0, near - 4):near].lower() == "plus" and not text[max(0, near - 5):near - 4].isalnum()):
        return True
    # or a dot in words or brackets, itself after a word
    m = _BEFORE[run[0].lower()].search(text, max(0, near - 16), near)
    if m is None:
        return False
    begin = _last_of(text, m.start() + (text[m.start()].isspace()), "")
    closed = text[near - 1] in ")]}>"
    return bool(begin) and (text[begin - 1].isalnum() or text[begin - 1] == "_") and (closed or near < a)


def _spelled_spaces(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Runs of white space among the digits beside a run of spelled digits (from a to b)."""
    lo, hi = a, b
    while lo and (text[lo - 1] in "0123456789-" or text[lo - 1].isspace()):
        lo -= 1
    while hi < len(text) and (text[hi] in "0123456789-" or text[hi].isspace()):
        hi += 1
    return [m.span() for part in ((lo, a), (b, hi)) for m in _SPACES.finditer(text, *part)]


def rewritten(text: str, runs_only: bool = False) -> tuple[str, np.ndarray, np.ndarray] | None:
    """The text without disguises, and where each of its characters starts and ends in the source; None if as before.

    With ``runs_only``, fewer than three spelled digits in a row stay words, as they may be a neighbour's.
    """
    swaps = {} if text.isascii() else {c: p for c in set(text) if not c.isascii() and (p := plain(c)) != c}
    start = end = None
    if swaps:
        kept = np.fromiter((c not in swaps or swaps[c] != "" for c in text), bool, len(text))
        start = np.flatnonzero(kept)
        end = start + 1
        text = "".join(swaps.get(c, c) for c in text)
    lettered = [m for m in _LETTERED.finditer(text)
                if 0 < len(_LETTER.findall(m[0])) < sum(c in "0123456789" for c in m[0])] if _DIGIT.search(text) else []
    if not (lettered or _BRACKETED.search(text) or _DOTTED.search(text) or _PLUS.search(text) or _AT.search(text) or _SPELLED.search(text)):
        return (text, start, end) if swaps else None
    if start is None:
        start = np.arange(len(text))
        end = start + 1
    pieces: list[tuple[int, int, str]] = []  # (from, to, replacement of one character)
    spaces: list[tuple[int, int]] = []
    for m in _RULES.finditer(text):
        if m["run"]:
            if runs_only and len(_EACH_WORD.findall(m[0])) < 3 or not _counts(text, m):
                continue
            for w in _EACH_WORD.finditer(text, *m.span()):
                pieces.append((w.start(), w.end(), DIGIT_WORDS[w[1].lower()]))
            spaces += _spelled_spaces(text, *m.span())
        elif m["at"]:
            # the name is looked for in the 64 characters that a local part may have, and a cue before it
            if m["literal"] and not _NAMED.search(text[max(0, m.start() - 96):m.start()] if m.start() > 96 else text[:m.start()]):
                continue
            pieces.append((*m.span(), "@"))
            host = _SPACED.match(text, m.end())
            if host:
                pieces += [(*d.span(), ".") for d in _SPACED_DOT.finditer(text, *host.span())]
        else:
            pieces.append((*m.span(), "." if m["dot"] else "+"))
    pieces += [(m.start() + x.start(), m.start() + x.end(), x[0].translate(_LETTER_DIGITS)) for m in lettered for x in _LETTER.finditer(m[0])]
    if not pieces:
        return (text, start, end) if swaps else None
    # in order, without overlaps: a disguise takes the white space beside it
    taken = sorted([*((a, 0, b, new) for a, b, new in pieces), *((a, 1, b, " ") for a, b in spaces)])
    pieces = []
    for k, (a, space, b, new) in enumerate(taken):
        if (not pieces or pieces[-1][1] <= a) and not (space and any(x < b for x, other, _, _ in taken[k + 1:k + 2] if not other)):
            pieces.append((a, b, new))
    out, s, e, last = [], [], [], 0
    for a, b, new in [*pieces, (len(text), len(text), "")]:
        out += [text[last:a], new]
        s += [start[last:a], start[a:a + 1]]
        e += [end[last:a], end[b - 1:b] if a < b else end[:0]]
        last = b
    return "".join(out), np.concatenate(s), np.concatenate(e)


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, added), by kind, start and end; added: found only without the disguise."""
    base = base_spans(text)
    found = [(k, s, e, False) for k, s, e in base]
    again = rewritten(text)
    if again is None:
        return found
    by_kind = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    less = rewritten(text, True)
    for reading in [again, less] if less and less[0] != again[0] else [again]:
        plain_text, start, end = reading
        new = []
        for k, s, e in base_spans(plain_text):
            s, e = int(start[s]), int(end[e - 1])
            before = bisect_right(by_kind[k], (s, len(text))) - 1  # the ends of a kind's spans ascend with their starts
            if before < 0 or by_kind[k][before][1] < e:
                new.append((k, s, e))
        found += [(*x, True) for x in new]
        for k in KINDS:  # without those that lie within another
            kept: list[tuple[int, int]] = []
            for s, e in sorted({*by_kind[k], *((s, e) for kind, s, e in new if kind == k)}, key=lambda x: (x[0], -x[1])):
                if not kept or kept[-1][1] < e:
                    kept.append((s, e))
            by_kind[k] = kept
    return sorted(set(found), key=lambda x: (KINDS.index(x[0]), x[1:]))


def redacted(text: str) -> str:
    """The text with each span, or union of overlapping spans, replaced by its (first) kind in brackets."""
    out, last, covered = [], 0, sorted((s, e, k) for k, s, e, _ in spans(text))
    for k, (s, e, kind) in enumerate(covered):
        if s >= last:
            out += [text[last:s], f"[{kind}]"]
        last = max(last, e)
    return "".join([*out, text[last:]]) if covered else text


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (array of kind, start, end, added)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches):
        names = ("kind", "start", "end", "added")
        for batch in batches:
            rows = [[dict(zip(names, x)) for x in spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    doc = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(freeing(run), f"doc_id {doc}, spans array<struct<kind:string,start:long,end:long,added:boolean>>")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, a digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: ~s["added"])
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *(count(k) for k in KINDS),
        F.sha2(F.array_join(F.transform(base, told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", told), ",").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind; ``size_col``, if there, is the new length."""
    text_at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches):
        for batch in batches:
            old = batch.column(text_at)
            new = [None if not t.is_valid else redacted(t.as_py()) for t in old]
            columns = list(batch.columns)
            columns[text_at] = pa.array(new, old.type)
            if size_at is not None:
                sizes = columns[size_at].to_pylist()
                columns[size_at] = pa.array([size if not t.is_valid or t.as_py() == n else len(n)
                                             for size, t, n in zip(sizes, old, new)], columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(freeing(run), docs.schema)
