"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

Frequent digests are found with Misra-Gries counters, counted exactly
("verified") and their winners broadcast, so that the rows of a text that makes
up a third of the corpus are decided map-side and never shuffled.  All other
digests, each below a known share of the rows, take the ordinary shuffle.

Spark's ``approx_top_k_*`` aggregates are mergeable Misra-Gries counters (the
frequent-items sketch).  They are only a filter: a digest they miss or
misjudge takes the other path and gets the same result.

Defined results: a null text counts as empty.  Of equal texts the largest
``doc_id`` stays (nulls are smallest; a group with null ids only keeps null).
Rows that repeat both the id and the text of the row that stays are marked kept
as well, being the same row; ``deduplicated`` returns one of them.
Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_or_empty

# counters per sketch (a power of two); at most as many digests are broadcast
COUNTERS = 4096
# sketches are merged in a tree: tasks -> this many groups -> one
MERGE_GROUPS = 64


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters / 2`` candidate digests, among them each with over ``8 / counters`` of the rows."""
    local = (digests.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("g"))
             .agg(F.expr(f"approx_top_k_accumulate(digest, {counters}) AS sketch")))
    # grouped, though into one: without a group the aggregate also runs on empty partitions, and fails there
    merged = local.groupBy(F.col("g") < 0).agg(F.expr(f"approx_top_k_combine(sketch, {counters}) AS sketch"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {counters // 2})")).alias("top"))
    return top.where("top.count > 1").select(F.col("top.item").alias("digest"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the text in UTF-8)."""
    digests = saved(docs.select(F.col(id_col).alias("doc_id"), F.sha2(text_or_empty(text_col), 256).alias("digest")),
                    "exact-dedup")
    total = digests.count()
    # verified: the exact count of a candidate, and only those with a real share of the rows
    winners = (digests.join(F.broadcast(frequent_digests(digests, counters)), "digest")
               .groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .where(F.col("group_size") >= max(2, total // counters)))
    winners = saved(winners, "exact-dedup-winners")
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    rest = rest.select("digest", "doc_id", F.max("doc_id").over(group).alias("keep_id"),
                       F.count(F.lit(1)).over(group).alias("group_size"))
    return hot.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"),
        F.col("digest").alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns, one per distinct text."""
    keep = (decide(docs, id_col, text_col).where("kept")
            .select(F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_sha")).distinct())
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                       F.sha2(text_or_empty(text_col), 256).alias("_digest"))
    kept = rows.join(keep, rows["_id"].eqNullSafe(keep["_keep_id"]) & (rows["_digest"] == keep["_sha"]), "left_semi")
    return kept.dropDuplicates(["_digest"]).select("_row.*")
