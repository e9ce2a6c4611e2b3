import hashlib
import random

from tidemark.llm import line_dedup, registry


def brute(docs, min_words):
    """Lines kept of each (doc_id, text): any run of lines with min_words words that begins earlier elsewhere is deleted."""
    places = sorted({(k is None, k or 0, t or "") for k, t in docs})  # the tests' texts order as their hashes may not: ids differ
    lines = {p: [s for x in p[2].split("\n") if (s := x.strip())] for p in places}
    seen, gone = {}, {p: set() for p in places}
    for p in places:
        for a in range(len(lines[p])):
            words = 0
            for b in range(a, len(lines[p])):
                words += len(lines[p][b].split())
                if words >= min_words:
                    run = tuple(lines[p][a:b + 1])
                    if run in seen:
                        gone[p] |= set(range(a, b + 1))
                    else:
                        seen[run] = p
    return {p: [s for k, s in enumerate(lines[p]) if k not in gone[p]] for p in places}


def kept_lines(text):
    return [s for x in (text or "").split("\n") if (s := x.strip())]


def test_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    pool = [" ".join(rng.choice("abcdefg") * rng.randint(1, 2) for _ in range(rng.choice([1, 1, 2, 3, 8]))) for _ in range(40)]
    passages = [[rng.choice(pool) for _ in range(rng.randint(2, 7))] for _ in range(6)]
    docs = []
    for k in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            lines += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(pool), "", "u" + str(rng.random())]
        docs.append((k if k else None, "\n".join(lines)))
    got = line_dedup.deduplicated(docs_of(docs), min_words=8).collect()
    want = {p[:2]: kept for p, kept in brute(docs, 8).items()}
    assert len(got) == 60 and any(len(kept_lines(t)) > len(want[(k is None, k or 0)]) for k, t in docs)
    for r in got:
        assert kept_lines(r.text) == want[(r.doc_id is None, r.doc_id or 0)]
        assert r.n_chars == len(r.text) and r.digest == "x"


def test_op5_whole_table(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = {p[1]: kept for p, kept in brute(docs, 50).items()}
    got = {r.doc_id: r for r in registry.QUERIES["op5_line_dedup"](spark, sf_small).collect()}
    assert set(got) == {k for k, _ in docs} and sum(r.deleted_lines for r in got.values()) > 0
    for k, t in docs:
        assert got[k].deleted_lines == len(kept_lines(t)) - len(want[k])
        assert all(s < k for s in got[k].sources if s != k)
        if not got[k].deleted_lines:
            assert got[k].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_odd_rows(spark, docs_of):
    run = "\n".join(f"line {k} of ten words in a passage for this" for k in range(6))
    docs = [(1, run), (1, run), (2, f"own start\n\n{run}\n\n\nown end"), (3, None), (4, ""), (5, "\n \n"), (None, run),
            (6, "w " * 300_000), (7, "\n".join(["same line again"] * 20_000))]
    got = sorted(((r.doc_id or 0, r.text if r.text is None or len(r.text) < 99 else len(r.text)) for r in
                  line_dedup.deduplicated(docs_of(docs)).collect()), key=str)
    assert got == sorted([(0, ""), (1, len(run)), (1, len(run)), (2, "own start\n\nown end"), (3, None), (4, ""), (5, "\n \n"),
                          (6, 600_000), (7, "same line again")], key=str)
    assert line_dedup.deduplicated(docs_of([])).count() == 0
