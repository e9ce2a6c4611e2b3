import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import connected, registry, simhash


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_pairs(fps):
    a = np.array(sorted(fps), np.uint64)
    for k in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[k + 1:] ^ a[k]) <= 3):
            yield int(a[k]), int(a[k + 1 + j])


@pytest.mark.parametrize("max_list", [1024, 2])
def test_links_of_clustered_fingerprints(spark, max_list):
    rng = random.Random(4)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(60):  # walks, so that components are chains and clouds
            fps.add(x)
            x ^= sum(1 << rng.randrange(64) for _ in range(rng.choice([1, 2, 3, 4, 6]))) & ((1 << 64) - 1)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    nodes = spark.createDataFrame(signed, "fp long").repartition(3)
    roots = {r.node: r.root for r in connected.components(simhash.links(nodes, max_list=max_list)).collect()}
    got, want = {}, {}
    for n, r in brute_components(near_pairs(fps), fps).items():
        want.setdefault(r, set()).add(n)
    for x, in signed:
        got.setdefault(roots.get(x, x), set()).add(x % (1 << 64))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(got) < len(fps) - 100


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(300)] + [(1000 + k, 1000) for k in range(1, 200)] + [(5000, 5000)]
    random.Random(1).shuffle(chain)
    got = {r.node: r.root for r in connected.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, **{1000 + k: 1000 for k in range(1, 200)}}
    assert connected.components(spark.createDataFrame([], "a long, b long")).count() == 0


def check(got, docs):
    fps = [(k, brute_fingerprint(t)) for k, t in docs]
    roots = brute_components(near_pairs({f for _, f in fps}), {f for _, f in fps})
    first = {}
    for k, f in fps:
        if k is not None:
            first[roots[f]] = min(k, first.get(roots[f], k))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((k, f"{f:016x}", first.get(roots[f])) for k, f in fps), key=key)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == want


def test_op10_whole_table(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    check(registry.QUERIES["op10_simhash"](spark, sf_small).collect(), docs)


def test_odd_rows_and_deduplicated(spark, docs_of, tmp_path):
    long = " ".join(f"w{k % 977}" for k in range(150_000))
    docs = [(5, None), (3, ""), (4, " \t\n"), (7, "One"), (8, "one"), (9, "a b"), (9, "c d e f"), (9, "c d e f"),
            (None, "ONE"), (None, "alone here"), (20, long), (12, long + " end")]
    docs_of(docs).write.parquet(f"{tmp_path}/documents.parquet")
    check(registry.QUERIES["op10_simhash"](spark, str(tmp_path)).collect(), docs)
    kept = simhash.deduplicated(docs_of(docs)).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:10]) for r in kept) == [
        (0, "alone here"), (3, ""), (7, "One"), (9, "a b"), (9, "c d e f"), (12, long[:10])]
    assert kept[0].digest == "x" and simhash.deduplicated(docs_of([])).count() == 0
