"""Target-distribution importance resampling over hashed word n-grams, by batch concatenation.

The documents whose n-grams look like those of a target set are drawn: every
n-gram falls into a bucket, a bucket's gain is the logarithm of how much more
frequent it is in the target than in the corpus, a document's weight is the sum
of its gains, and Gumbel noise on top turns "the highest scores" into sampling
without replacement.

Texts are read in groups: the texts of a group are joined by a sentinel that no
word contains, one regular-expression pass finds the words of all, and a binary
search of the words' places in the texts' offsets tells whose they are.  An
n-gram whose first and last word lie in different texts is masked; the rest is
counted with ``bincount``, per bucket or, weighted by gain, per document.  A
text longer than a group is read in pieces, cut between words; a piece begins
with the last words of the one before, whose n-grams are masked as well.

Counts are over all rows of both tables: one row per task and bucket met, then
summed.  At most ``buckets`` counts go to the driver, and as many gains to the
tasks.  The ranks are exact and need no task over all rows: the scored rows are
range-sorted and written, and a row's rank is its place in its partition plus
the rows of the partitions before.

Defined results: a null text has no words; its weight is 0.  A null id counts
as "-" for the noise and is the largest of a tie.  Rows that repeat an id and
the text have the same score and take ranks of their own.  Extra columns are
ignored.  An empty table gives an empty result; without any feature in the
target, gains still follow the formula.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

MAX_N = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
GROUP_BYTES = 2_000_000
CACHE_WORDS = 300_000
_CACHED_BYTES = 64  # longer words are hashed each time
_SENTINEL = b"\n"
# letters of ASCII in lower case, digits, and all of UTF-8 beyond ASCII
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class _Buckets(dict):
    """The checksum of each word met."""

    def __missing__(self, word: bytes) -> int:
        crc = zlib.crc32(word)
        if len(word) <= _CACHED_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = crc
        return crc


def pieces(texts: list[bytes], max_n: int, most: int) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Groups of about ``most`` bytes: (the text of each piece, the pieces, the number of words each repeats from before)."""
    rows, group, repeated, size = [], [], [], 0
    for row, text in enumerate(texts):
        at, tail = 0, b""
        while True:
            end = len(text)
            if end - at > most:
                gap = _GAP.search(text, at + most)
                end = gap.start() if gap else end
            rows.append(row)
            group.append(tail + text[at:end])
            repeated.append(len(tail.split()))
            size += len(group[-1]) + 1
            if end < len(text):
                tail = b" ".join(_last_words(group[-1].lower(), max_n - 1) + [b""])
            if size >= most:
                yield rows, group, repeated
                rows, group, repeated, size = [], [], [], 0
            if end >= len(text):
                break
            at = end
    if group:
        yield rows, group, repeated


def _last_words(text: bytes, n: int) -> list[bytes]:
    if not n:
        return []
    size = 256  # the last words are looked for in a growing tail
    while True:
        words = _WORD.findall(text[-size:])
        if len(words) > n or size >= len(text):
            return words[-n:]
        size *= 4


def features(texts: list[bytes], max_n: int, buckets: int, crc: _Buckets,
             most: int = GROUP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Of UTF-8 texts: (text of each feature, its bucket, length of the n-grams), in parts that fit memory."""
    for rows, group, repeated in pieces(texts, max_n, most):
        joined = _SENTINEL.join(group).lower()  # of bytes: ASCII letters only
        words = _WORD.findall(joined)
        if not words:
            continue
        inside = _IS_WORD[np.frombuffer(joined, np.uint8)]
        starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
        offsets = np.append(0, np.cumsum([len(g) + 1 for g in group]))[:-1]
        piece = np.searchsorted(offsets, starts, side="right") - 1
        row = np.asarray(rows)[piece]
        # words that a piece repeats from the one before end no n-gram of their own
        first = np.searchsorted(piece, np.arange(len(group)))
        new = np.arange(len(words)) - first[piece] >= np.asarray(repeated)[piece]
        sums = np.fromiter(map(crc.__getitem__, words), np.int64, len(words))
        yield row[new], sums[new] % buckets, 1
        for n in range(2, max_n + 1):
            if len(words) < n:
                break
            sums = np.fromiter((zlib.crc32(b" " + w, c) for w, c in zip(words[n - 1:], sums.tolist())), np.int64, len(words) - n + 1)
            whole = (piece[:-(n - 1)] == piece[n - 1:]) & new[n - 1:]
            yield row[n - 1:][whole], sums[whole] % buckets, n


def _utf8(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _counts(texts: DataFrame, text_col: str, max_n: int, buckets: int) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket."""

    def run(batches):
        total, crc = np.zeros(buckets, np.int64), _Buckets()
        for batch in batches:
            for _, bucket, _ in features(_utf8(batch.column(0)), max_n, buckets, crc):
                total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    return texts.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, text_col: str = "text",
          target_text_col: str = "text") -> np.ndarray:
    """The gain of each bucket, in thousandths of a nat, rounded down."""

    def counts(df, col):
        n = np.zeros(buckets, np.int64)
        for r in _counts(df, col, max_n, buckets).collect():  # at most one row per bucket
            n[r.bucket] = r.n
        return n.tolist()

    s, t = counts(docs, text_col), counts(target, target_text_col)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((y + 1.0) * all_s / ((x + 1.0) * all_t))) for x, y in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, max_n: int = MAX_N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of each document."""
    by_bucket = gain.astype(np.float64)  # sums below 2**53 are exact

    def run(batches):
        crc = _Buckets()
        for batch in batches:
            rows = batch.num_rows
            words, count, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows)
            for row, bucket, n in features(_utf8(batch.column(1)), max_n, len(by_bucket), crc):
                found = np.bincount(row, minlength=rows)
                count += found
                words += found if n == 1 else 0
                weight += np.bincount(row, by_bucket[bucket], minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(count), pa.array(weight.astype(np.int64))],
                ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``scored`` and rank: 1, 2, 3 … by score, null beyond floor(a * rows / b) for a share (a, b)."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # the place is the partition's number and, below it, the row's place in the partition
    rows = saved(scored.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "importance-order")
    rows = rows.withColumn("_part", F.shiftright("_place", 33))
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the sort
    parts = saved(parts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"), "n"), "importance-parts")
    drawn = (parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * share[0]) // share[1]
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    return rows.join(parts, "_part").withColumn("rank", F.when(rank <= drawn, rank)).drop("_place", "_part", "_before", "n")


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N,
         buckets: int = BUCKETS, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
         target_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null: not drawn)."""
    weighed = weigh(docs, gains(docs, target, max_n, buckets, text_col, target_text_col), max_n, id_col, text_col)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))), 256),
                           1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = saved(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "importance")
    out = ranked(scored.where(F.col("n_words") >= min_words), (percent, 100))
    return out.unionByName(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
