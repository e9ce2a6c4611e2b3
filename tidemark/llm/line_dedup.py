"""Line dedup by winnowing over line hashes.

The text's lines (without blank ones) are hashed.  A window is a shortest run of
lines that holds at least ``min_words`` words, one beginning and one ending at
each line where the text has that many.  Each window selects the line with its
smallest hash; equal windows select equal lines, so any run of ``min_words``
words that two places share has a selected line in common (the winnowing
guarantee).  Selected lines that occur only once are dropped after a count of
hashes, which leaves few of the windows.  The others are matched as a whole: the
windows around a shared line, to its left and right, carry a digest of all their
lines, and the earliest place of each digest is joined to the later ones, in the
order of (doc_id, text hash, line).  That finds the whole-line part of every
match without the pairs of a line that thousands of documents share; nothing is
extended into lines that are shared in part.

So a line is deleted exactly when it belongs to a run of at least ``min_words``
words that also occurs at an earlier place.  The earliest copy of any line
always stays.  Lines are compared without white space at their ends; blank
lines after a deleted line go with it.

Defined results: a null text stays null and an empty one empty.  Null ids come
last.  Rows that repeat both id and text are one place: none of them is later.
Extra columns are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeing, saved, text_or_empty

MIN_WORDS = 50


def windows(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, bytes]]:
    """(hash of the selected line, its number, first line, last line, window digest); numbers count non-blank lines."""
    lines = [s for line in text.split("\n") if (s := line.strip())]
    total = np.cumsum([0, *(len(s.split()) for s in lines)])
    if total[-1] < min_words:
        return []
    hashes = [xxhash.xxh3_64_intdigest(s) for s in lines]
    data = np.array(hashes, "<u8").tobytes()
    n = len(lines)
    last = np.searchsorted(total, total[:-1] + min_words) - 1  # of the window that begins at each line
    first = np.searchsorted(total, total[1:] - min_words, "right") - 1  # of the one that ends at each line
    runs = {(a, b) for a, b in enumerate(last.tolist()) if b < n} | {(a, b) for b, a in enumerate(first.tolist()) if a >= 0}
    out = []
    for a, b in sorted(runs):
        h = min(hashes[a:b + 1])
        at = b - hashes[a:b + 1][::-1].index(h)
        out.append((h - (1 << 63), at, a, b, xxhash.xxh3_128_digest(data[8 * a:8 * b + 8])))
    return out


def without(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the lines of ``runs`` (first, last), and without blank lines right after those."""
    gone = {k for a, b in runs for k in range(a, b + 1)}
    out, number, deleted = [], 0, False
    for line in text.split("\n"):
        if line.strip():
            deleted = number in gone
            number += 1
        if not deleted:
            out.append(line)
    return "\n".join(out)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining runs as one."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def fingerprints(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Selected lines: fp, doc_id, text_hash, and the windows that selected them (digest, first, last)."""
    window = pa.list_(pa.struct([("digest", pa.binary()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches):
        for batch in batches:
            rows = []
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                by_line: dict = {}
                for h, at, a, b, digest in windows(text, min_words):
                    by_line.setdefault((h, at), []).append({"digest": digest, "first": a, "last": b})
                rows += [(h, doc, key, w) for (h, _), w in by_line.items()]
            if rows:
                fp, doc, key, w = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp, pa.int64()), pa.array(doc, batch.schema.field(0).type), pa.array(key, pa.int64()),
                     pa.array(w, window)], ["fp", "doc_id", "text_hash", "windows"])

    rows = docs.select(F.col(id_col).alias("doc_id"), _text_hash(text_col).alias("text_hash"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # rows that repeat id and text give the same windows; one place each is left by the aggregates below
    return rows.mapInArrow(freeing(run), f"fp long, doc_id {kind}, text_hash long, "
                                "windows array<struct<digest:binary,first:int,last:int>>")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, runs (array of first, last), sources (ids of the documents with the earliest copies)."""
    selected = saved(fingerprints(docs, id_col, text_col, min_words), "winnowing")
    # counts are written before they are joined: adaptive execution splits a hot key only between plain exchanges
    shared = saved(selected.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"), "winnowing-repeated")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "first").alias("place")
    found = saved(selected.join(shared, "fp", "left_semi").select("doc_id", "text_hash", F.explode("windows").alias("w"))
                  .select("doc_id", "text_hash", "w.*"), "winnowing-shared")
    earliest = found.groupBy("digest").agg(F.min(place).alias("source"), F.max(place).alias("latest")).where("latest > source")
    earliest = saved(earliest.select("digest", "source"), "winnowing-earliest")
    later = found.withColumn("place", place).join(earliest, "digest").where("place > source")
    runs = later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("runs"),
                                                    F.collect_set("source.doc_id").alias("sources"))
    return runs


def with_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
              runs_col: str = "runs") -> DataFrame:
    """``docs`` and a column (runs, sources) of what is to be deleted, null if nothing."""
    runs = repeated_runs(docs, id_col, text_col, min_words).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.struct("runs", "sources").alias("_found"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), _text_hash(text_col).alias("_key"))
    joined = rows.join(runs, (rows["_key"] == runs["_hash"]) & rows["_doc"].eqNullSafe(runs["_id"]), "left")
    return joined.select("_row.*", F.col("_found").alias(runs_col))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars",
                 min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later repeated runs in the text; ``size_col``, if there, is the new length."""
    runs_col = "runs"
    while runs_col in docs.columns:
        runs_col += "_"
    text_at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            found = columns.pop()
            old = columns[text_at]
            new, sizes = old.to_pylist(), None if size_at is None else columns[size_at].to_pylist()
            for k, f in enumerate(found):
                if f.is_valid:
                    new[k] = without(new[k], [(r["first"], r["last"]) for r in f["runs"].as_py()])
                    if sizes:
                        sizes[k] = len(new[k])
            columns[text_at] = pa.array(new, old.type)
            if sizes is not None:
                columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return with_runs(docs, id_col, text_col, min_words, runs_col).mapInArrow(freeing(run), docs.schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, deleted_lines, runs (text: first:last, comma-joined), sources, text_sha256 (of what stays) of each row."""
    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                runs = merged([(r["first"], r["last"]) for r in found["runs"]]) if found else []
                rest = without(text, runs) if runs else text or ""
                rows.append((doc, sum(b - a + 1 for a, b in runs), ",".join(f"{a}:{b}" for a, b in runs),
                             sorted(x for x in found["sources"] if x is not None) if found else [],
                             hashlib.sha256(rest.encode()).hexdigest()))
            kind = batch.schema.field(0).type
            kinds = [kind, pa.int64(), pa.string(), pa.list_(kind), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                                             ["doc_id", "deleted_lines", "runs", "sources", "text_sha256"])

    rows = with_runs(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), min_words=min_words)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(freeing(run), f"doc_id {kind}, deleted_lines long, runs string, sources array<{kind}>, text_sha256 string")
