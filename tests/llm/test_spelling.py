import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import registry, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, min_letters=5, min_count=3):
    n = Counter()
    for d, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'-' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_letters and c >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def brute(rows):
    n = brute_words(rows)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def told(df):
    rows = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed, words, docs):
    """Random words over few letters, so that many are near each other, with skewed counts."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 7))) for _ in range(words)]
    return [(k, " ".join(rng.choice(vocab[: rng.choice((3, 20, words))]) for _ in range(60))) for k in range(docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(docs_of, seed):
    rows = corpus(seed, 150, 60)
    want = brute(rows)
    assert told(spelling.variants(docs_of(rows))) == want
    assert any(r[1] and r[1] != r[2] for r in want)  # a chain of two


def test_odd_rows(docs_of):
    long = "ab" * 40_000
    rows = [(1, None), (2, ""), (3, "42 £ 日本語"), (None, "Éclair éclair ÉCLAIR eclair Eclair eclair ECLAIR"), (4, "x" * 200_000),
            (5, "aaaaab aaaaab aaaaab aaaab aaaab aaaab aaaaaab"), (5, "aaaaab aaaaab aaaaab aaaab aaaab aaaab aaaaaab"),
            (6, f"{long} {long} {long} {long}x {long}x {long}x y{long} {long} {long} {long}"), (7, "naïve-naïve_naïve naives naives naives")]
    assert told(spelling.variants(docs_of(rows))) == brute(rows)
    assert told(spelling.variants(docs_of([]))) == set()
    assert told(spelling.variants(docs_of([(1, "one two")]))) == set()


def test_labels_are_exact():
    word = "".join(random.Random(0).choice("ab") for _ in range(120))
    found = spelling.labels(word)
    assert len(found) == 121 == len(set(found)) and found[:3] == ["", word[0], word[:2]]
    assert spelling.labels(word[:90]) == found[:91] and spelling.labels(word[:90] + "é")[91] != found[91]


def test_a_group_as_large_as_the_alphabet(docs_of):
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    rows = [(k, " ".join([f"long{c}tail"] * (3 + k))) for k, c in enumerate(letters)]
    got = told(spelling.variants(docs_of(rows), drop_every=0))
    assert {r[4] for r in got} == {len(letters) - 1}
    assert sum(r[1] is not None for r in got) == sum(92 >= 2 * (3 + k) for k in range(len(letters)))


def test_flushes(docs_of, monkeypatch):
    rows = corpus(9, 150, 30)
    monkeypatch.setattr(spelling, "_FLUSH_WORDS", 5)
    assert brute_words(rows) == {r.word: r.n for r in spelling.counted(docs_of(rows)).where("n >= 3").collect()}


def test_roots(spark):
    chain = [(k, max(k - 1, 0)) for k in range(40)] + [(100, 100), (101, 100)]
    got = {r.id: r.root for r in spelling.roots(spark.createDataFrame(chain, "id long, to long")).collect()}
    assert got == {**dict.fromkeys(range(40), 0), 100: 100, 101: 100}


def test_op11(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = registry.QUERIES["op11_spelling"](spark, sf_small)
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert told(got) == brute(rows)
