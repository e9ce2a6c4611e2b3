"""Approximate nearest neighbours: an NN-descent graph, searched greedily.

Building.  Equal vectors are one node.  A first graph links each node to the
nearest ones among its neighbours along random lines (sorted blocks, so a dense
cluster cannot overload a task).  Then each round joins every node's list
(its neighbours and a sample of those it is a neighbour of) with the vectors of
the list, compares list members with each other ("neighbours of neighbours"),
and keeps each node's ``NEIGHBOURS`` nearest.  Pairs that were compared in an
earlier round are skipped; rounds end when few links change.

The lists are dealt by node into buckets of a bounded number of nodes (at least
16 buckets, so that small tables have as many tasks), and a vector is sent once
to each bucket that needs it: at most once for each list that names it, of which
there are about ``NEIGHBOURS + REVERSE``.  Lists compare single-precision
vectors; a search, and so the result, works in double precision.

Searching.  All queries walk the graph together.  Each keeps the ``POOL``
nearest nodes it has met; a round expands the ``BEAM`` nearest that are not
expanded yet, sends their neighbours not met before to the buckets that hold
the vectors, and merges the distances that come back (in double precision on
the original vectors).  A query ends when its pool is expanded.

Every row is indexed; nothing is sampled but the reverse neighbours of a round.

Defined results: vectors that are null, all zero, of another length than the
most frequent one, or that hold a null or a non-finite component take no part,
nor do rows with a null id.  Rows that repeat id and vector are one.  A query's
own id is never its neighbour.  Equal vectors are all found, by smaller id
first.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, saved

NEIGHBOURS, REVERSE = 24, 24  # of a node in the graph; of the nodes it is a neighbour of, in a round
WALK_REVERSE = 48              # of those, in a search
LINES, BLOCK = 3, 128
ROUNDS, LEAST_CHANGE = 8, 0.02
POOL, BEAM = 256, 80
BUCKET_NODES, LEAST_BUCKETS = 4096, 16  # at most, at least
BUCKET_BYTES = 64 << 20        # of single-precision vectors that the lists of a bucket may name
BUCKET_QUERIES = 256


def nodes(vectors: DataFrame, members: int, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (node, vec, members: the smallest ids), and all rows (vec_id, node) that take part."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
                      & F.exists("vec", lambda x: x != 0))  # NaN is larger than any number
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vec") == (length.n if length else 0)).select("vec_id", "vec", _hash("vec").alias("hash"))
    rows = saved(rows.distinct(), "nn-rows")
    rank = F.dense_rank().over(Window.partitionBy("hash", "vec").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= members)
    found = saved(few.groupBy("hash", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("members")), "nn-vectors")
    # different vectors of one hash, if there are any, get numbers of their own
    shared = saved(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "nn-shared")
    if shared.limit(1).count():
        rank = F.row_number().over(Window.partitionBy("hash").orderBy("vec"))
        own = saved(found.join(shared, "hash").select("hash", "vec", F.xxhash64("hash", rank).alias("own")), "nn-own")
        numbered = lambda df: df.join(own, ["hash", "vec"], "left").withColumn("node", F.coalesce("own", "hash"))
    else:
        numbered = lambda df: df.withColumn("node", F.col("hash"))
    return (saved(numbered(found).select("node", "vec", "members"), "nn-nodes"), numbered(rows).select("vec_id", "node"))


def _hash(col: str) -> Column:
    return F.xxhash64(col)


def _bucket_nodes(found: DataFrame) -> int:
    """Nodes by bucket: so many that the vectors their lists name fit ``BUCKET_BYTES``."""
    one = found.select(F.size("vec").alias("n")).first()
    return max(16, min(BUCKET_NODES, BUCKET_BYTES // (4 * max(1, one.n if one else 1) * (NEIGHBOURS + REVERSE))))


def _buckets(found: DataFrame) -> int:
    return max(LEAST_BUCKETS, -(-found.count() // _bucket_nodes(found)))


def _bucket(col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node, of (u, v, d, new); a pair that was there before is not new."""
    edges = edges.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy("d", "v"))
    return edges.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def _top(u: np.ndarray, v: np.ndarray, d: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest distinct v of each u."""
    by = np.lexsort((v, d, u))
    u, v, d = u[by], v[by], d[by]
    begins = lambda *columns: np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))[:len(u)]
    once = begins(u, v)  # equal pairs have equal distances
    u, v, d = u[once], v[once], d[once]
    first = np.flatnonzero(begins(u))
    place = np.arange(len(u)) - np.repeat(first, np.diff(np.append(first, len(u))))
    keep = place < k
    return pd.DataFrame({"u": u[keep], "v": v[keep], "d": d[keep]})


def _distances(x: np.ndarray) -> np.ndarray:
    """Between the rows of each (m x dimension) block."""
    square = (x * x).sum(axis=-1)
    return np.sqrt(np.maximum(square[..., :, None] + square[..., None, :] - 2 * x @ np.swapaxes(x, -1, -2), 0))


def _along_lines(found: DataFrame, k: int, ranges: int) -> DataFrame:
    """First links: the nearest in sorted blocks along random lines."""

    def project(parts):
        for part in parts:
            x = np.stack(part["vec"])
            lines = np.random.default_rng(7).standard_normal((LINES, x.shape[1]))
            yield pd.concat([part[["node", "vec"]], pd.DataFrame(x @ lines.T, index=part.index, columns=[f"at{t}" for t in range(LINES)])], axis=1)

    def near(parts):
        held = pd.DataFrame()
        for part in parts:
            held = pd.concat([held, part])
            while len(held) >= 2 * BLOCK:
                yield block(held.iloc[:BLOCK])
                held = held.iloc[BLOCK // 2:]
        for a in range(0, max(1, len(held) - BLOCK // 2), BLOCK // 2):
            if len(held) > 1:
                yield block(held.iloc[max(0, min(a, len(held) - BLOCK)):][:BLOCK])

    def block(rows):
        d = _distances(np.stack(rows["vec"]))
        np.fill_diagonal(d, np.inf)
        node, n = rows["node"].to_numpy(), min(k, len(rows) - 1)
        at = np.argpartition(d, n - 1, axis=1)[:, :n]
        return pd.DataFrame({"u": np.repeat(node, n), "v": node[at].ravel(), "d": np.take_along_axis(d, at, 1).ravel(), "new": True})

    lines = ", ".join(f"at{t} double" for t in range(LINES))
    placed = saved(found.select("node", "vec").mapInPandas(project, f"node long, vec array<double>, {lines}"), "nn-lines")
    links = None
    for t in range(LINES):
        by = placed.select("node", "vec", f"at{t}").repartitionByRange(max(1, ranges), f"at{t}").sortWithinPartitions(f"at{t}", "node")
        part = by.select("node", "vec").mapInPandas(near, "u long, v long, d double, new boolean")
        links = part if links is None else links.unionByName(part)
    return _nearest(links, k)


def _compare(k: int):
    """Lists (bucket, x, list of v and new) and vectors (bucket, v, vec, far) to the nearest pairs within lists."""

    def run(lists: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(lists) or not len(vectors):
            return _top(*(np.zeros(0, t) for t in (np.int64, np.int64, float)), k)
        ids, first = np.unique(vectors["v"].to_numpy(), return_index=True)
        x = np.stack(vectors["vec"].to_numpy()[first]).astype(np.float32)
        limit = vectors["far"].to_numpy()[first]
        width = max(map(len, lists["list"]))
        found = []
        for a in range(0, len(lists), 256):
            rows = lists["list"].iloc[a:a + 256]
            member = np.zeros((len(rows), width), np.int64)
            new, there = np.zeros(member.shape, bool), np.zeros(member.shape, bool)
            for r, row in enumerate(rows):
                member[r, :len(row)] = [e["v"] for e in row]
                new[r, :len(row)] = [e["new"] for e in row]
                there[r, :len(row)] = True
            at = np.minimum(np.searchsorted(ids, member), len(ids) - 1)
            d = _distances(x[at])
            pair = there[:, :, None] & there[:, None, :] & (new[:, :, None] | new[:, None, :]) & (member[:, :, None] != member[:, None, :])
            pair &= d < limit[at][:, :, None]  # a link that its node would keep; both directions are in the block
            r, i, j = np.nonzero(pair)
            found.append((member[r, i], member[r, j], d[r, i, j].astype(float)))
        return _top(*(np.concatenate(c) for c in zip(*found)), k)

    return run


def _reverse(edges: DataFrame, most: int, salt: int = 0) -> DataFrame:
    """(x, v, new): a sample of the nodes v that have x as a neighbour, new links first."""
    rank = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("new"), F.xxhash64("v", F.lit(salt)), "v"))
    return edges.select(F.col("v").alias("x"), F.col("u").alias("v"), "new").withColumn("rank", rank).where(
        F.col("rank") <= most).drop("rank")


def graph(found: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """(u, v, d) the approximate k nearest nodes of each node."""
    n, buckets = found.count(), _buckets(found)
    edges = saved(_along_lines(found, k, -(-n // BUCKET_NODES)), "nn-graph")
    for r in range(rounds):
        lists = edges.select(F.col("u").alias("x"), "v", "new").unionByName(_reverse(edges, REVERSE, r))
        lists = lists.groupBy("x").agg(F.collect_list(F.struct("v", "new")).alias("list"))  # k + REVERSE at most
        lists = saved(lists.where(F.exists("list", lambda e: e["new"])).withColumn("bucket", _bucket("x", buckets)), "nn-lists")
        # the distance below which a node keeps a new link
        far = edges.groupBy("u").agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("n")).select(
            F.col("u").alias("node"), F.when(F.col("n") < k, float("inf")).otherwise(F.col("far")).alias("far"))
        needed = lists.select(F.col("bucket").alias("at"), F.explode("list").alias("e")).select("at", F.col("e.v").alias("v")).distinct()
        vectors = needed.join(found.join(far, "node", "left"), F.col("v") == F.col("node")).select(
            "at", "v", F.col("vec").cast("array<float>").alias("vec"), F.coalesce("far", F.lit(float("inf"))).alias("far"))
        compared = lists.groupBy("bucket").cogroup(vectors.groupBy("at")).applyInPandas(_compare(k), "u long, v long, d double")
        old = edges
        edges = saved(_nearest(edges.withColumn("new", F.lit(False)).unionByName(compared.withColumn("new", F.lit(True))), k), "nn-graph")
        discard(old)
        discard(lists)
        if edges.where("new").count() <= LEAST_CHANGE * n * k:
            break
    return edges


def _evaluate(requests: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Distances of requested nodes, and the neighbours of those within the asker's bound."""
    out = []
    if len(requests) and len(held):
        node = held["node"].to_numpy()
        by = np.argsort(node)
        node, x, near = node[by], np.stack(held["vec"].to_numpy()[by]), held["near"].to_numpy()[by]
        for q, vec, bound, ids in zip(requests["q"], requests["vec"], requests["bound"], requests["ids"]):
            at = np.minimum(np.searchsorted(node, ids), len(node) - 1)
            d = np.sqrt(((x[at] - vec) ** 2).sum(axis=1))
            keep = np.flatnonzero(d <= bound)
            if len(keep):
                out.append((q, ids[keep], d[keep], [near[a].tolist() for a in at[keep]]))
    return pd.DataFrame(out, columns=["q", "ids", "d", "near"])


def _advance(pool: int, beam: int):
    """A round's answers into the state of each query: ids, d, near (of nodes to be expanded, else empty), met, next."""

    def run(state: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        by_query: dict = {}
        for q, ids, d, near in zip(answers["q"], answers["ids"], answers["d"], answers["near"]):
            by_query.setdefault(q, []).append((ids, d, near))
        out = []
        for s in state.itertuples(index=False):
            rows = list(zip(s.d.tolist(), s.ids.tolist(), s.near))
            for ids, d, near in by_query.get(s.q, ()):
                rows += zip(d.tolist(), ids.tolist(), near)
            rows = sorted(rows, key=lambda r: r[:2])[:pool]
            met, nxt, near = set(s.met.tolist()), [], []
            left = beam
            for d, _, links in rows:
                if len(links) and left:
                    left -= 1
                    for v in links:
                        if v not in met:
                            met.add(v)
                            nxt.append(v)
                    links = []
                near.append(list(links))
            bound = rows[-1][0] if len(rows) == pool else float("inf")
            out.append((s.q, s.vec, bound, [r[1] for r in rows], [r[0] for r in rows], near, list(met), nxt, s.qb))
        return pd.DataFrame(out, columns=list(state.columns))

    return run


_STATE = "q long, vec array<double>, bound double, ids array<long>, d array<double>, near array<array<long>>, met array<long>, next array<long>, qb int"


def search(found: DataFrame, edges: DataFrame, wanted: DataFrame, pool: int = POOL, beam: int = BEAM) -> DataFrame:
    """(q, node, d): the nearest nodes met of each node q in ``wanted``, itself included."""
    buckets = _buckets(found)
    near = edges.select(F.col("u").alias("x"), "v").unionByName(
        _reverse(edges.withColumn("new", F.lit(False)), WALK_REVERSE).select("x", "v"))
    near = near.groupBy("x").agg(F.collect_set("v").alias("near"))
    held = saved(found.join(near, F.col("node") == F.col("x"), "left").select(
        _bucket("node", buckets).alias("bucket"), "node", "vec", F.coalesce("near", F.array().cast("array<long>")).alias("near")), "nn-held")
    wanted = wanted.select(F.col("node").alias("q")).distinct()
    query_buckets = max(1, -(-wanted.count() // BUCKET_QUERIES))
    none = F.array().cast("array<long>")
    state = wanted.join(found, F.col("q") == F.col("node")).select(
        "q", "vec", F.lit(float("inf")).alias("bound"), none.alias("ids"), F.array().cast("array<double>").alias("d"),
        F.array().cast("array<array<long>>").alias("near"), F.array("q").alias("met"), F.array("q").alias("next"),
        _bucket("q", query_buckets).alias("qb"))
    state = saved(state, "nn-search")
    while state.where(F.size("next") > 0).limit(1).count():
        requests = state.select("q", "vec", "bound", F.explode("next").alias("id")).withColumn("bucket", _bucket("id", buckets))
        requests = requests.groupBy("bucket", "q").agg(F.any_value("vec").alias("vec"), F.any_value("bound").alias("bound"),
                                                       F.collect_list("id").alias("ids"))
        answers = requests.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInPandas(
            _evaluate, "q long, ids array<long>, d array<double>, near array<array<long>>")
        answers = answers.withColumn("qb", _bucket("q", query_buckets))
        old = state
        state = saved(state.groupBy("qb").cogroup(answers.groupBy("qb")).applyInPandas(_advance(pool, beam), _STATE), "nn-search")
        discard(old)
    return state.select("q", F.explode(F.arrays_zip("ids", "d")).alias("e")).select("q", F.col("e.ids").alias("node"), F.col("e.d").alias("d"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            pool: int = POOL, beam: int = BEAM) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance): the k nearest found of each row with ``is_query`` (of vec_id)."""
    found, rows = nodes(vectors, k + 1, id_col, vec_col)
    edges = graph(found)
    queries = saved(rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")), "nn-queries")
    met = search(found, edges, queries.select(F.col("q").alias("node")), pool, beam)
    met = met.join(found.select("node", "members"), "node").select("q", F.explode("members").alias("vec_id"), F.col("d").alias("score"))
    # the k + 1 first rows by query node: one of them may be the query's own
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))
    # written first: copies of one vector may be a third of the queries, and a hot key is split only between plain exchanges
    met = saved(met.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank"), "nn-met")
    result = queries.join(met, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
