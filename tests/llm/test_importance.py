import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import importance, registry

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, max_n=1):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)], len(words)


def brute(docs, target, max_n=1, buckets=10_000, min_words=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for texts, n in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            for f in grams(text, max_n)[0]:
                n[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for d, text in docs:
        found, words = grams(text, max_n)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'-' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((x for x in out if x[4] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0]))
    ranks = {id(x): k + 1 for k, x in enumerate(able[:len(able) * percent // 100])}
    return sorted([(d, n, w, s, ranks.get(id(x))) for x in out for d, n, w, s, _ in [x]], key=str)


def told(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()], key=str)


TEXTS = ["Über die ÉTÉ 42 b2b", None, "", "...", "a-b_c d'e\x00f\ng", "ÀÉ é É x" * 30, "nul\x7fdel £5 “quoted” 日本語 テスト",
         "one two three " * 50, "word " * 25 + "tail", "x" * 5000 + " y " * 30]
DOCS = [(k, TEXTS[k % len(TEXTS)]) for k in range(90)] + [(None, "null id " * 20), (3, "twice " * 30), (3, "twice " * 30)]


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_features_in_small_groups(max_n):
    texts = [(t or "").encode() for t in TEXTS]
    for most in (1, 7, 64, 1 << 20):
        count, words = np.zeros((len(texts), 97), int), np.zeros(len(texts), int)
        for row, bucket, n in importance.features(texts, max_n, 97, importance._Buckets(), most):
            np.add.at(count, (row, bucket), 1)
            words += np.bincount(row, minlength=len(texts)) * (n == 1)
        for k, t in enumerate(TEXTS):
            want, n_words = grams(t, max_n)
            assert words[k] == n_words
            assert count[k].tolist() == np.bincount([zlib.crc32(f.encode()) % 97 for f in want] or [0], minlength=97).tolist() if want else not count[k].any()


@pytest.mark.parametrize("max_n", [1, 2])
def test_equals_brute_force(spark, docs_of, max_n):
    target = ["one two three", None, "Über ÉTÉ", "word tail " * 9]
    aims = spark.createDataFrame([(k, t, 9) for k, t in enumerate(target)], "item_id long, text string, rank int")
    got = importance.draw(docs_of(DOCS, 4).withColumnRenamed("kept", "rank"), aims, max_n=max_n, percent=30)
    assert told(got) == brute(DOCS, target, max_n, percent=30)
    assert got.where("rank = 1").count() == 1


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert told(importance.draw(docs_of(DOCS[:0]), none)) == []
    assert told(importance.draw(docs_of(DOCS), none)) == brute(DOCS, [])
    assert told(importance.draw(docs_of(DOCS), none, percent=0)) == brute(DOCS, [], percent=0)
    assert [r[4] for r in told(importance.draw(docs_of([(1, "too short")]), none, percent=100))] == [None]


def test_word_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(importance, "CACHE_WORDS", 10)
    crc = importance._Buckets()
    words = [b"w%d" % (k % 37) for k in range(500)] + [b"long" * 100]
    assert [crc[w] for w in words] == [zlib.crc32(w) for w in words] and len(crc) <= 10


def test_op13(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    got = registry.QUERIES["op13_importance"](spark, sf_small)
    assert dict(got.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert told(got) == brute(docs, target)
