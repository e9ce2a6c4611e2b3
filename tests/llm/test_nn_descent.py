import math
import random

import numpy as np

from pyspark.sql import functions as F

from tidemark.llm import nn_descent, registry

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    """query_id -> [(score, vec_id)] over the rows that take part."""
    ok = {(i, tuple(np.float32(v).tolist())) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    length = max({len(v) for _, v in ok}, key=lambda n: (sum(len(v) == n for _, v in ok), -n), default=0)
    ok = [(i, np.array(v)) for i, v in ok if len(v) == length]
    return {i: sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in ok if j != i)[:k] for i, v in ok if i % 100 == 0}


def found(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    return got


def recall(got, want):
    share = []
    for q, w in want.items():
        g = got.get(q, [])
        assert len(g) == len(w) and g == sorted(g)
        share.append(len({i for _, i in g} & {i for _, i in w}) / max(1, len(w)))
    return np.mean(share)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows), found(registry.QUERIES["op4_nn_descent"](spark, sf))
    assert set(got) == set(want) and recall(got, want) >= 0.95
    vec = {i: np.array(v, float) for i, v in rows}
    for q, g in got.items():
        for score, i in g:
            assert score == float(np.sqrt(((vec[q] - vec[i]) ** 2).sum()))


def test_odd_rows_and_copies(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(250)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(1000, 1401)]  # copies, some of them queries
    rows += [(2000, None), (2100, [0.0] * 4), (2200, [1.0, None, 0.0, 0.0]), (2300, [1.0, float("nan"), 0.0, 0.0]),
             (2400, [float("inf"), 0.0, 0.0, 0.0]), (2500, [1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (7, rows[7][1]), (100, rows[100][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(4).selectExpr("*", "1 AS node")
    got, want = found(nn_descent.nearest(df, F.col("vec_id") % 100 == 0)), brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert [i for _, i in got[1200]] == list(range(1000, 1010)) and [i for _, i in got[1000]] == list(range(1001, 1011))


def test_small_tables(spark):
    for rows in ([], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (3, [4.0, 5.0])]):
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
        got = found(nn_descent.nearest(df, F.col("vec_id") % 100 == 0))
        assert got == {q: w for q, w in brute(rows).items() if w}


def test_vectors_of_one_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_hash", lambda col: F.xxhash64(col) % 40)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(150)] + [(i, [1.0, 2.0, 3.0]) for i in range(200, 230)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3)
    got, want = found(nn_descent.nearest(df, F.col("vec_id") % 100 == 0)), brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert [i for _, i in got[200]] == list(range(201, 211))


def test_buckets_by_dimension(spark):
    for size, want in ((1, 4096), (768, 64 * 2 ** 20 // (4 * 768 * 48)), (10 ** 6, 16)):
        one = spark.range(1).select(F.array_repeat(F.lit(1.0), size).alias("vec"))
        assert nn_descent._bucket_nodes(one) == want
    assert nn_descent._bucket_nodes(spark.createDataFrame([], "vec array<double>")) == 4096
