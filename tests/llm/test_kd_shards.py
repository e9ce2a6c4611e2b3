import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import kd_shards, registry


def check(rows, docs, shards=24):
    """Every row once, sizes and checksums right, slots gapless; returns the shards' bytes."""
    want = sorted(((k is None, k or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in docs))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == want
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return [size[k] for k in range(shards)]


def test_whole_table_and_copies_together(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()]
    rows = registry.QUERIES["op3_kd_shards"](spark, "/root/testdata/sf0.1").collect()
    size = check(rows, docs)
    mean, largest = sum(size) / 24, max(len((t or "").encode()) for _, t in docs)
    assert max(abs(s - mean) for s in size) < 0.01 * mean + largest
    groups = defaultdict(set)
    for r in rows:
        groups[r.text_crc32, r.size].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) < 30  # only groups at a cut that are heavier than a point
    heavy = defaultdict(int)
    for r in rows:
        heavy[r.text_crc32, r.size] += r.size
    assert not [g for g, shards in groups.items() if len(shards) > 1 and heavy[g] <= mean]  # none that fits a shard is cut


def test_a_group_of_a_third_is_dealt_out(spark, docs_of):
    rng = random.Random(7)
    docs = [(k, "hot text " * 20 if k % 3 == 0 else "w" * rng.randint(0, 400) + str(k)) for k in range(6000)]
    size = check(kd_shards.shard(docs_of(docs)).collect(), docs)
    mean = sum(size) / 24
    assert max(abs(s - mean) for s in size) < 0.03 * mean


@pytest.mark.parametrize("docs", [[], [(1, "a")], [(1, None), (1, ""), (None, "é" * 5), (None, "é" * 5), (2, "x" * 300_000)]])
def test_small_tables(spark, docs_of, docs):
    check(kd_shards.shard(docs_of(docs)).collect(), docs)
    narrow = docs_of(docs).drop("lang", "source")
    check(kd_shards.shard(narrow, shards=3).collect(), docs, 3)


def test_groups_that_fit_a_shard_stay_whole(docs_of):
    rng = random.Random(3)
    docs = [(k, "w" * rng.randint(0, 200) + str(k)) for k in range(4000)]
    for g, copies in enumerate((300, 200, 150, 60, 40, 30, 20, 20, 10, 5)):  # up to nine tenths of a shard
        docs += [(10_000 + 1000 * g + k, f"group {g} " * 5) for k in range(copies)]
    rng.shuffle(docs)
    rows = kd_shards.shard(docs_of(docs)).collect()
    size = check(rows, docs)
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    mean = sum(size) / 24
    assert max(abs(s - mean) for s in size) < 0.03 * mean


def brute_cut(points, wanted):
    """(left, right) of (place, weight, key): the cut after or before the point that reaches the wanted weight, where it is nearer."""
    points, done = sorted(points), 0
    for k, (_, w, _) in enumerate(points):
        if done + w >= wanted:
            k += 0 if wanted - done < done + w - wanted else 1
            return points[:k], points[k:]
        done += w
    return points, []


def test_equals_a_plain_tree(docs_of, monkeypatch):
    monkeypatch.setattr(kd_shards, "TOLERANCE", 0)
    monkeypatch.setattr(kd_shards, "MAX_GROUP", 1.0)  # no heavy point
    rng = random.Random(5)
    docs = docs_of([(k, rng.choice("xyz") * rng.randint(1, 300) + str(k // 2)) for k in range(900)])
    docs = docs.selectExpr("doc_id", "text", "CASE WHEN doc_id % 3 = 0 THEN 'de' WHEN doc_id % 7 > 0 THEN 'en' END AS lang",
                           "concat('src', doc_id % 11) AS source")
    rows = kd_shards.with_parts(kd_shards.sizes(docs), 7)
    points = [(bytes(p.digest), p.weight, {d: p[d] for d in kd_shards.DIMENSIONS}) for p in kd_shards.points(rows).collect()]

    def tree(points, first, n):
        if n == 1:
            return {k: first for k, _, _ in points}
        d = max(kd_shards.DIMENSIONS, key=lambda d: max(p[2][d] for p in points) - min(p[2][d] for p in points))
        by_key = {p[0]: p for p in points}
        sides = brute_cut([(p[2][d], p[1], p[0]) for p in points], sum(p[1] for p in points) * (n // 2) / n)
        left, right = ([by_key[k] for *_, k in side] for side in sides)
        return tree(left, first, n // 2) | tree(right, first + n // 2, n - n // 2)

    assert {bytes(r.digest): r.shard for r in kd_shards.assign(rows, 7).collect()} == tree(points, 0, 7)
