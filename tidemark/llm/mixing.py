"""Mixing sources to target weights: a time-varying curriculum (DataFrame functions only).

Every source has a weight schedule over training time 0 to 1, given as knots
(time, weight) joined by straight lines.  The integral of its schedule is the
source's weight in the mix: the budget is shared by these weights, a source
stops at ``most`` times its own size, and what is above is shared again by
weight among the others until none is above.

A source meets its target along its schedule: the demand up to time t is the
target times the integral up to t over the whole integral.  Its documents stand
in an order given by a hash of their ids; the demand is inverted at the token
where a document starts, in closed form (the integral is quadratic between two
knots), and that time is the document's position.  A source whose target is
above its size is passed through again from its first document on; the document
at which the target ends is cut.  The mix is the range-sort by position.

A running sum over the documents of one source would put a hot source into one
task, so the documents are dealt into ``BUCKETS`` by the leading bits of their
hash: sums per (source, bucket) give where a bucket starts, and a running sum
within the bucket gives the rest.  Nothing is broadcast by hint, and no join
key but (source, bucket) is met by documents.

Defined results: a null text has size 0; a document of size 0 takes no words
and has no position.  A null source is a source of its own, the last in order.
A null id counts as "-".  Rows that repeat an id stand side by side, by hash of
their text; rows that repeat both are interchangeable.  Extra columns are
ignored by ``schedule`` and kept by ``mixed``.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_or_empty

Schedule = Sequence[tuple[float, float]]

# of the sources in code-point order, repeating; the integrals are 5, 2 and 1
SCHEDULES: tuple[Schedule, ...] = (((0, 6), (1, 4)), ((0, 2), (1, 2)), ((0, 0), (1, 2)))
SHARE = 1.5
MOST = 2
SEED = "mix"
BUCKET_BITS = 12
_KEY_DIGITS = 15  # hexadecimal digits of the order's hash
_BEFORE = (Window.unboundedPreceding, -1)


def integral(knots: Schedule) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def _check(schedules: Sequence[Schedule]) -> None:
    for knots in schedules:
        times = [t for t, _ in knots]
        if times[0] != 0 or times[-1] != 1 or times != sorted(set(times)):
            raise ValueError(f"knots must run from time 0 to time 1: {knots}")
        if min(w for _, w in knots) < 0 or integral(knots) <= 0:
            raise ValueError(f"weights must not be negative, nor all zero: {knots}")


def _segments(schedules: Sequence[Schedule]) -> Column:
    """Per schedule its lines between knots: (integral up to it, its time, its length, weight at its start, slope)."""

    def lines(knots):
        done = 0.0
        for (t, w), (t2, w2) in zip(knots, knots[1:]):
            yield F.struct(F.lit(float(done)).alias("done"), F.lit(float(t)).alias("t"), F.lit(float(t2 - t)).alias("dt"),
                           F.lit(float(w)).alias("w"), F.lit((w2 - w) / (t2 - t)).alias("slope"))
            done += (t2 - t) * (w + w2) / 2

    return F.array(*(F.array(*lines(knots)) for knots in schedules))


def time_of(demand: Column, lines: Column) -> Column:
    """The time at which the integral of a schedule reaches ``demand``."""
    line = F.try_element_at(F.filter(lines, lambda x: x["done"] <= demand), F.lit(-1))
    more = demand - line["done"]
    root = line["w"] + F.sqrt(F.greatest(F.lit(0.0), line["w"] * line["w"] + 2 * line["slope"] * more))
    return line["t"] + F.when(root > 0, F.least(line["dt"], F.try_divide(2 * more, root))).otherwise(F.lit(0.0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, and: schedule (its place), weight, target.

    The sources' ranks and the water level need them in one order: one task
    over one row per source.
    """
    weights = F.array(*(F.lit(float(integral(s))) for s in schedules))
    sources = sizes.withColumn("schedule", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                                            % len(schedules)).cast("int"))
    sources = sources.withColumn("weight", F.element_at(weights, F.col("schedule") + 1)).withColumn(
        "cap", F.col("source_size") * F.lit(float(most)))
    # sources that reach their cap first come first; the level is that of the first one that does not reach it
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    sources = sources.withColumns({
        "left": F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(order.rowsBetween(*_BEFORE)), F.lit(0.0)),
        "weights": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    sources = sources.withColumn("level", F.col("left") / F.col("weights"))
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole)
    target = F.coalesce(F.least(F.col("cap"), F.col("weight") * level), F.col("cap"))
    return sources.select("source", "source_size", "schedule", "weight", target.alias("target"))


def schedule(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, most: int = MOST,
             seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, ``carry``, size, source_size, target, taken, passes, order_key.

    ``passes`` holds (pass, position, words) of each time the document is taken.
    """
    _check(schedules)
    key = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))), 256),
                             1, _KEY_DIGITS), 16, 10).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(source_col).alias("source"),
                       word_count(text_or_empty(text_col)).alias("size"), key.alias("order_key"),
                       F.xxhash64(text_or_empty(text_col)).alias("text_hash"))
    # a join key that is never null, and keeps the order of the sources
    rows = saved(rows.withColumns({"tag": F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")),
                                   "bucket": F.shiftright("order_key", 4 * _KEY_DIGITS - BUCKET_BITS)}), "mixing")
    sums = saved(rows.groupBy("tag", "bucket").agg(F.sum("size").alias("size")), "mixing-sums")
    sources = targets(sums.groupBy(F.col("tag").alias("source")).agg(F.sum("size").alias("source_size")), schedules, share, most)
    bucket_at = F.coalesce(F.sum("size").over(Window.partitionBy("tag").orderBy("bucket").rowsBetween(*_BEFORE)), F.lit(0))
    starts = saved(sums.select("tag", "bucket", bucket_at.alias("bucket_at"))
                   .join(sources.withColumnRenamed("source", "tag"), "tag"), "mixing-starts")

    inside = Window.partitionBy("tag", "bucket").orderBy("order_key", "text_hash").rowsBetween(*_BEFORE)
    at = rows.join(starts, ["tag", "bucket"]).withColumn("at", F.col("bucket_at") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = at.withColumn("lines", F.element_at(_segments(schedules), F.col("schedule") + 1))

    def taken(k: int) -> Column:
        begin = F.col("source_size") * k + F.col("at")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - begin)).cast("long")
        return F.struct(F.lit(k).alias("pass"), time_of(F.col("weight") * F.try_divide(begin.cast("double"), F.col("target")), F.col("lines")).alias("position"),
                        words.alias("words"))

    passes = F.filter(F.array(*map(taken, range(int(-(-most // 1))))), lambda p: p["words"] > 0)
    at = at.withColumn("passes", passes)
    return at.select("doc_id", *carry, "size", "source_size", "target",
                     F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"]).alias("taken"), "passes", "order_key")


def by_position(scheduled: DataFrame) -> DataFrame:
    """The documents range-sorted by the position at which they are first taken (null last: not taken)."""
    first = scheduled.withColumn("position", F.get("passes", F.lit(0))["position"])
    # written first: the sort samples its input for the ranges, and reads it again
    return saved(first, "mixing-positions").orderBy(F.col("position").asc_nulls_last(), "order_key", "doc_id")


def mixed(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, most: int = MOST,
          seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix in training order: every column of ``docs`` once per pass, with _pass, _position, _words (of the text, from its start)."""
    rows = saved(docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row")), "mixing-docs")
    plain = rows.select("_row", *(F.col(f"_doc.{c}").alias(f"_{k}") for k, c in enumerate((id_col, text_col, source_col))))
    placed = schedule(plain, schedules, share, most, seed, "_0", "_1", "_2", carry=["_row"])
    passes = saved(placed.select("_row", "order_key", F.explode("passes").alias("p")), "mixing-passes")
    out = rows.join(passes, "_row").orderBy("p.position", "order_key", "p.pass")
    return out.select("_doc.*", F.col("p.pass").alias("_pass"), F.col("p.position").alias("_position"), F.col("p.words").alias("_words"))
