import hashlib

import duckdb
import pytest

from tidemark.llm import exact_dedup, registry


def brute(docs):
    groups = {}
    for k, t in docs:
        groups.setdefault(t or "", []).append(k)
    out = []
    for k, t in docs:
        ids = [i for i in groups[t or ""] if i is not None]
        keep = max(ids) if ids else None
        out.append((k, keep, len(groups[t or ""]), k == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("counters", [8, 4096])
def test_decisions(docs_of, counters):
    docs = [(1, "a"), (2, None), (3, ""), (None, "a"), (5, "b"), (5, "b"), (None, "c"), (8, "A"), (9, "é" * 100_000)]
    docs += [(k, "hot") for k in range(10, 400)] + [(k, f"text {k}") for k in range(400, 800)]
    got = exact_dedup.decide(docs_of(docs, parts=7), counters=counters).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_deduplicated_keeps_columns_and_one_row_per_text(docs_of):
    docs = [(1, "a"), (2, None), (3, ""), (5, "b"), (5, "b"), (None, "c"), (None, "c"), (4, "a")]
    rows = exact_dedup.deduplicated(docs_of(docs)).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.digest) for r in rows) == [(0, "c", "x"), (3, "", "x"), (4, "a", "x"), (5, "b", "x")]
    assert exact_dedup.deduplicated(docs_of([])).count() == 0


def test_hot_digests_take_no_shuffle(docs_of):
    docs = docs_of([(k, "hot" if k % 3 else f"text {k}") for k in range(3000)], parts=4)
    digests = docs.selectExpr("sha2(text, 256) AS digest")
    found = [r.digest for r in exact_dedup.frequent_digests(digests, 64).collect()]
    assert hashlib.sha256(b"hot").hexdigest() in found and len(found) <= 32


@pytest.mark.parametrize("name", ["op6_url_filter", "op7_exact_dedup"])
def test_sql_twin(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    want = con.sql(registry.ORACLE_SQL[name])
    got = registry.QUERIES[name](spark, sf_small)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)
