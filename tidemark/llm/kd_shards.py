"""Sharding with a k-d tree over document metadata, cut at weighted medians.

Points are the distinct texts, weighted by the bytes of all their copies; their
coordinates are metadata: size, language, source (of the copy with the smallest
id).  Every node that still stands for more than one shard is split along the
dimension in which its points spread widest, at the weighted quantile that
gives each side its number of shards, until the leaves have the target bytes
(total / shards).  All nodes of a level are split together.  A quantile is
found by refining histograms: a point's place is a 62-bit number (coordinate,
then a hash of the text), and each round sums the weights of 4096 bins within
the bin that holds the quantile.

Copies of a text stay together wherever they fit into a shard.  Points heavier
than ``MAX_GROUP`` of a shard (at most shards / ``MAX_GROUP``) are dealt first at
each split: in the order of the dimension, up to the side's share of them, or,
if a side can't hold that, the heaviest first to the side with more room.  The
cut among all other points is then at the quantile that makes up for them.
Only a group heavier than a whole shard, which may be a third of the corpus, is
dealt by document into parts of ``MAX_GROUP`` that are neighbours in every order.

The law is ``bytes``: the shards' sizes are near equal, within about the size of
a light point for each level, as long as the heavy ones leave room for that.

Defined results: a null text counts as empty (size 8).  Null languages and
sources count as empty names.  Rows that repeat an id get a slot
each.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import saved, text_or_empty

SHARDS = 24
MAX_GROUP = 0.005      # of a shard's bytes: heavier points are dealt one by one
TOLERANCE = 0.001      # of a node's bytes: a bin this light is not refined
BIN_BITS = 12
SLOT_BUCKETS = 1024    # slots are numbered within so many buckets of a shard
# a place: coordinate, hash of the text, part of the group (shards / MAX_GROUP parts at most)
_COORDINATE_BITS, _HASH_BITS, _PART_BITS = 24, 25, 13
_BITS = _COORDINATE_BITS + _HASH_BITS + _PART_BITS
DIMENSIONS = ("size", "lang", "source")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, digest, lang, source: all that later steps need, without the text."""
    text = text_or_empty(text_col)
    column = lambda c: (F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c)
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       column("lang"), column("source"))


def heavy_weight(total: int, shards: int) -> int:
    """Points above this weight are heavy."""
    return max(1, int(total / shards * MAX_GROUP))


def with_parts(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` and the part of its group that each belongs to: 0, unless the group is too heavy for a shard."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    most = heavy_weight(total, shards)
    heavy = rows.groupBy("digest").agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n"))
    parts = F.least(F.ceil(F.col("weight") / most), F.col("n"), F.lit(1 << _PART_BITS)).cast("int").alias("parts")
    # fewer groups than shards are that heavy
    heavy = F.broadcast(heavy.where((F.col("weight") > total / shards) & (F.col("n") > 1)).select("digest", parts))
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1))).cast("int")
    return rows.join(heavy, "digest", "left").withColumn("part", part).drop("parts")


def points(rows: DataFrame) -> DataFrame:
    """digest, part, weight, and one place by dimension."""
    texts = rows.groupBy("digest").agg(
        F.first("size").alias("size"),
        F.min_by(F.struct("lang", "source"), F.struct(F.col("doc_id").isNull(), "doc_id", "lang", "source")).alias("meta"))
    weights = rows.groupBy("digest", "part").agg(F.sum("size").alias("weight"))
    low, high = rows.agg(F.min("size"), F.max("size")).first()
    # coordinates from 0 to 1; categories lie at their hash, so that no list of them is needed
    log = lambda c: F.log2(c.cast("double"))
    size = (log(F.col("size")) - log(F.lit(low))) / F.greatest(log(F.lit(high)) - log(F.lit(low)), F.lit(1e-9))
    category = lambda c: F.pmod(F.xxhash64(F.coalesce(c, F.lit(""))), F.lit(1 << 20)) / (1 << 20)
    at = {"size": size, "lang": category("meta.lang"), "source": category("meta.source")}
    tie = F.shiftrightunsigned(F.xxhash64("digest"), 64 - _HASH_BITS)
    top = F.lit((1 << _COORDINATE_BITS) - 1)

    def place(c):
        line = F.shiftleft(F.least(F.floor(c * (1 << _COORDINATE_BITS)), top), _HASH_BITS).bitwiseOR(tie)
        return F.shiftleft(line, _PART_BITS).bitwiseOR(F.col("part").cast("long"))

    return weights.join(texts, "digest").select("digest", "part", "weight", *(place(c).alias(k) for k, c in at.items()))


def _lookup(values: dict[int, float | int], kind: str) -> Column:
    """A value by node; there are fewer nodes than shards."""
    return F.element_at(F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast(kind)))), F.col("node"))


def _quantiles(items: DataFrame, wanted: dict[int, float], total: dict[int, float]) -> dict[int, tuple[int, float]]:
    """By node: the place up to which (exclusive) points lie left, so that about ``wanted`` of the weight does.

    ``items`` has node, place, weight.  Each round narrows every node's interval to one of its bins.
    """
    bits = _BITS
    low, left, cut = dict.fromkeys(wanted, 0), dict.fromkeys(wanted, 0.0), {}
    while True:
        shift = max(0, bits - BIN_BITS)
        active = [k for k in wanted if k not in cut]
        inside = items.where(F.col("node").isin(active)).withColumn("low", _lookup({k: low[k] for k in active}, "long"))
        inside = inside.where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + (1 << bits)))
        bins = inside.groupBy("node", F.shiftright(F.col("place") - F.col("low"), shift).alias("bin")).agg(F.sum("weight").alias("w"))
        run = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")))
        need = _lookup({k: wanted[k] - left[k] for k in active}, "double")
        # the bin in which the wanted weight is reached; at most one row by node
        found = run.where(F.col("upto") >= need).groupBy("node").agg(F.min_by(F.struct("bin", "w", "upto"), "bin").alias("b"))
        rows = {r.node: r.b for r in found.collect()}
        for k in active:
            if k not in rows:  # rounding: all of the weight lies left
                cut[k] = (1 << _BITS, total[k])
                continue
            b = rows[k]
            before = left[k] + b.upto - b.w
            start = low[k] + (b.bin << shift)
            if shift == 0 or b.w <= TOLERANCE * total[k]:  # the nearer edge of the bin
                after = before + b.w
                cut[k] = (start, before) if wanted[k] - before < after - wanted[k] else (start + (1 << shift), after)
            low[k], left[k] = start, before
        bits = shift
        if all(k in cut for k in wanted):
            return cut


def _dealt(heavy: list[Row], d: str, room: tuple[float, float]) -> tuple[list[Row], list[Row]]:
    """Heavy points of a node left and right: by their place, the left side's share of them, if both sides have the room."""
    weight, left, right, done = sum(p.weight for p in heavy), [], [], 0
    share = weight * room[0] / max(sum(room), 1e-9)
    for p in sorted(heavy, key=lambda p: (p[d], bytes(p.digest), p.part)):
        if not right and done + p.weight / 2 <= share:
            left.append(p)
            done += p.weight
        else:
            right.append(p)
    if done <= room[0] and weight - done <= room[1]:
        return left, right
    sides, free = ([], []), list(room)
    for p in sorted(heavy, key=lambda p: (-p.weight, p[d], bytes(p.digest), p.part)):
        k = 0 if free[0] >= free[1] else 1
        sides[k].append(p)
        free[k] -= p.weight
    return sides


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """digest, part, shard of each point."""
    every = saved(points(rows).withColumn("node", F.lit(0)), "kd-points")
    most = heavy_weight(every.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0], shards)
    items = every.where(F.col("weight") <= most)
    heavy = {0: every.where(F.col("weight") > most).collect()}  # by node; at most shards / MAX_GROUP in all
    span = {0: (0, shards)}  # by node: first shard and number of shards
    while any(n > 1 for _, n in span.values()):
        split = [k for k, (_, n) in span.items() if n > 1]
        here = items.where(F.col("node").isin(split))
        stats = {r.node: r for r in here.groupBy("node").agg(
            F.sum("weight").alias("w"), *(F.min(d).alias(f"{d}_0") for d in DIMENSIONS),
            *(F.max(d).alias(f"{d}_1") for d in DIMENSIONS)).collect()}

        def width(k, d):
            ends = [stats[k][f"{d}_0"], stats[k][f"{d}_1"]] if k in stats else []
            ends += [p[d] for p in heavy[k]]
            return max(ends) - min(ends) if ends else 0

        widest = {k: max(range(len(DIMENSIONS)), key=lambda d: width(k, DIMENSIONS[d])) for k in split}
        place = F.element_at(F.array(*DIMENSIONS), _lookup(widest, "int") + 1)
        total = {k: float(stats[k].w) if k in stats else 0.0 for k in split}
        new, wanted = {}, {}
        for k in split:
            first, n = span[k]
            left, right = 2 * k + 1, 2 * k + 2
            new[left], new[right] = (first, n // 2), (first + n // 2, n - n // 2)
            room = total[k] + sum(p.weight for p in heavy[k])
            room = (room * (n // 2) / n, room * (n - n // 2) / n)
            heavy[left], heavy[right] = _dealt(heavy.pop(k), DIMENSIONS[widest[k]], room)
            if k in stats:  # what the heavy points leave for the others
                wanted[k] = min(total[k], max(0.0, room[0] - sum(p.weight for p in heavy[left])))
        cut = _quantiles(here.select("node", place.alias("place"), "weight"), wanted, total) if wanted else {}
        cuts = _lookup({k: cut[k][0] for k in split if k in cut}, "long") if cut else F.lit(0)
        side = F.when(place < cuts, 2 * F.col("node") + 1).otherwise(2 * F.col("node") + 2)
        node = F.when(F.col("node").isin(split), side).otherwise(F.col("node")).cast("int")
        items = saved(items.withColumn("node", node), "kd-points")
        span = {**{k: v for k, v in span.items() if k not in split}, **new}
    light = items.select("digest", "part", _lookup({k: first for k, (first, _) in span.items()}, "int").alias("shard"))
    dealt = [(p.digest, p.part, span[k][0]) for k, ps in heavy.items() for p in ps]
    return light.unionByName(rows.sparkSession.createDataFrame(dealt, light.schema)) if dealt else light


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    rows = saved(with_parts(saved(sizes(docs, id_col, text_col), "kd-sizes"), shards), "kd-rows")
    # a heavy group's documents are dealt over its parts, so no join key holds more than a part
    rows = saved(rows.join(assign(rows, shards), ["digest", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOT_BUCKETS)).alias("bucket")), "kd-shards")
    # slots: rows are numbered within small buckets, after the rows of the buckets before
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))  # shards x buckets rows
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("number", number).join(F.broadcast(counts), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("at") + F.col("number")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
