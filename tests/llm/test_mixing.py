import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, registry


def brute_targets(sizes, weights, share=1.5, most=2):
    """Shares by weight; who is above its cap stops there and the excess is shared again, until none is above."""
    target = dict.fromkeys(sizes, 0.0)
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        for s in free:
            target[s] = left * weights[s] / sum(weights[x] for x in free)
        above = [s for s in free if target[s] > most * sizes[s]]
        if not above:
            return target
        for s in above:
            target[s] = float(most * sizes[s])
        capped |= set(above)


def area(knots, t):
    done = 0.0
    for (a, w), (b, v) in zip(knots, knots[1:]):
        if t <= a:
            break
        x = min(t, b) - a
        done += w * x + (v - w) / (b - a) * x * x / 2
    return done


def brute(rows, schedules=mixing.SCHEDULES):
    """rows: (doc_id, text, source) with distinct ids -> doc_id: (size, source_size, target, taken, positions)"""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    names = sorted({s for *_, s in rows if s is not None}) + ([None] if any(s is None for *_, s in rows) else [])
    total = {s: sum(size[d] for d, _, x in rows if x == s) for s in names}
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target = brute_targets(total, weights)
    out = {}
    for k, s in enumerate(names):
        mine = sorted((hashlib.sha256(f"mix:{d}".encode()).hexdigest()[:15], d) for d, _, x in rows if x == s)
        left, taken, at = int(target[s]), dict.fromkeys((d for _, d in mine), 0), {d: [] for _, d in mine}
        begin = 0
        for _ in range(2):
            for _, d in mine:
                n = min(size[d], left)
                if n > 0:
                    lo, hi = 0.0, 1.0
                    for _ in range(60):  # bisection, in place of the closed form
                        mid = (lo + hi) / 2
                        lo, hi = (mid, hi) if area(schedules[k % 3], mid) * target[s] < begin * weights[s] else (lo, mid)
                    at[d].append(hi)
                    taken[d] += n
                    left -= n
                begin += size[d]
        out |= {d: (size[d], total[s], target[s], taken[d], at[d]) for _, d in mine}
    return out


ROWS = [(k, " ".join(["w"] * (k * 7 % 23)), ("b", "z", "é", None, "z", "a", "z")[k % 7]) for k in range(300)]
ROWS += [(1000, None, "a"), (1001, "", "lone"), (1002, "x " * 500, "é"), (1003, "one", "small")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).selectExpr("*", "1 AS size", "'x' AS target")


def test_equals_brute_force(spark):
    want = brute(ROWS)
    got = mixing.schedule(frame(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        size, source_size, target, taken, at = want[r.doc_id]
        assert (r.size, r.source_size, r.taken) == (size, source_size, taken)
        assert r.target == pytest.approx(target)
        assert [p["position"] for p in r.passes] == pytest.approx(at, abs=1e-6)
    by_source = {}
    for r in got:
        by_source.setdefault(dict((d, s) for d, _, s in ROWS)[r.doc_id], []).append(r)
    for rows in by_source.values():
        assert sum(r.taken for r in rows) == int(rows[0].target)
        assert all(r.taken <= 2 * r.size for r in rows)
    assert any(len(r.passes) == 2 for r in got) and any(r.size and not r.taken for r in got)


@pytest.mark.parametrize("sizes", [{"a": 0}, {"a": 10}, {"a": 10, "b": 0}, {"a": 1, "b": 1000, "c": 5, "d": 5, None: 7},
                                   {f"s{k:02}": (k * 37) % 50 for k in range(40)}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    want = brute_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)})
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(want)


def test_schedule_shapes_the_mix(spark):
    rows = [(k, "w " * 10, "ab"[k % 2]) for k in range(400)]
    out = mixing.mixed(frame(spark, rows), [((0, 3), (1, 1)), ((0, 1), (0.5, 1), (1, 3))], share=0.5).collect()
    assert [r._position for r in out] == sorted(r._position for r in out)
    assert out[0].text == "w " * 10 and out[0].target == "x"  # the clashing column is the document's own
    late = [sum(r._words for r in out if r.source == s and r._position >= 0.5) / sum(r._words for r in out if r.source == s) for s in "ab"]
    assert late[0] == pytest.approx(1.5 / 4 * 1.0, abs=0.02) and late[1] == pytest.approx(2 / 3, abs=0.02)


def test_flat_schedule_and_zero_weights(spark):
    rows = [(k, "w " * 10, "a") for k in range(100)]
    at = [r._position for r in mixing.mixed(frame(spark, rows), [((0, 1), (1, 1))], share=1, most=1).collect()]
    assert at == pytest.approx([k / 100 for k in range(100)])
    none_first = mixing.mixed(frame(spark, rows), [((0, 0), (0.5, 0), (1, 2))], share=1, most=1).collect()
    assert min(r._position for r in none_first) >= 0.5 and len(none_first) == 100
    for bad in ([((0, 1), (0.5, 1))], [((0, 0), (1, 0))], [((0, -1), (1, 3))]):
        with pytest.raises(ValueError):
            mixing.schedule(frame(spark, rows), bad)


def test_repeats_empty_and_hot(spark):
    assert mixing.schedule(frame(spark, [])).collect() == [] and mixing.mixed(frame(spark, [])).collect() == []
    rows = [(7, "a b c", "s"), (7, "a b c", "s"), (7, "d e f", "s"), (None, "a", None), (None, None, None)]
    got = mixing.schedule(frame(spark, rows)).collect()
    assert len(got) == 5 and sum(r.taken for r in got if r.doc_id == 7) == int(next(r.target for r in got if r.doc_id == 7))
    again = mixing.schedule(frame(spark, rows[::-1])).collect()
    key = lambda rs: sorted((r.doc_id or 0, r.size, r.taken, str(r.passes)) for r in rs)
    assert key(got) == key(again)
    mix = mixing.mixed(frame(spark, rows))
    assert mix.agg(F.sum("_words")).first()[0] == sum(r.taken for r in got)


def test_op12(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()])
    got = registry.QUERIES["op12_mixing"](spark, sf_small)
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double",
                                "taken": "bigint", "position": "double"}
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r["size"], r.source_size, r.taken) == (want[r.doc_id][0], want[r.doc_id][1], want[r.doc_id][3])
    at = [r.position for r in rows if r.position is not None]
    assert at == sorted(at) and rows[len(at):] == [r for r in rows if r.position is None]
