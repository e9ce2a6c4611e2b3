import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import language_id as lid
from tidemark.llm import registry


def grams_of(words, order):
    """Kneser-Ney counts by brute force: raw for the highest order and word beginnings, else distinct letters before."""
    raw = [Counter() for _ in range(order + 1)]
    for w in words:
        w = f" {w} "
        for p in range(1, len(w)):
            for k in range(1, order + 1):
                if p - k + 1 >= 0:
                    raw[k][w[p - k + 1:p + 1]] += 1
    out = {order: raw[order]}
    for k in range(order - 1, 0, -1):
        before = Counter(g[1:] for g in raw[k + 1])
        out[k] = Counter({g: n if g[0] == " " and k > 1 else before[g] for g, n in raw[k].items()})
    return out


def brute_prob(counts, gram):
    """Interpolated Kneser-Ney probability of a gram's last letter."""
    k, c = len(gram), counts[len(gram)]
    once, twice = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
    d = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    after = {g: n for g, n in c.items() if g[:-1] == gram[:-1]}
    lower = 1 / (len(c) + 1) if k == 1 else brute_prob(counts, gram[1:])
    if not after:
        return lower
    total = sum(after.values())
    return max(after.get(gram, 0) - d, 0) / total + sum(min(d, n) for n in after.values()) / total * lower


@pytest.fixture(scope="module")
def words():
    rng = random.Random(6)
    return ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(150)]


def test_model_as_the_formula(words):
    counts = grams_of(words, 4)
    model = lid.fit({k: (list(c), np.array(list(c.values()))) for k, c in counts.items()}, 4)
    scorer = lid.Scorer({"x": model})
    for text in (words[0], "abcd", "zéb", "a", "ddddzzddd"):
        want, padded = 0.0, f" {text} "
        for p in range(1, len(padded)):
            want += math.log(brute_prob(counts, padded[max(0, p - 3):p + 1]))
        got, n = scorer.entropies([text])
        assert n[0] == len(text) + 1 and got[0, 0] == pytest.approx(-want / n[0], rel=1e-6)


def test_counts_in_spark(spark, words):
    rows = spark.createDataFrame([(" ".join(words[k::5]), "x") for k in range(5)], "text string, lang string").repartition(3)
    got = lid._collected(lid._levels(rows, 4), 4)["x"]
    want = grams_of(words, 4)
    for k in range(1, 5):
        assert dict(zip(got[k][0], got[k][1].tolist())) == dict(want[k])


def test_held_out_accuracy_on_whole_table(spark, sf_small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = registry.QUERIES["op9_language_id"](spark, sf_small).collect()
    assert {r.doc_id for r in got} == set(docs)
    import zlib
    right = defaultdict(list)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        right[r.held_out].append(r.lang_pred == docs[r.doc_id].lang)
    assert np.mean(right[True]) > 0.97 and len(right[True]) > 40
    assert np.mean([r.accepted for r in got]) > 0.97


def test_odd_rows_and_rejection(spark, sf_small, docs_of):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    known = lid.learn(table)
    odd = [(1, None), (2, ""), (3, "12 34 ²½ !!"), (4, "word " * 60_000), (5, "x"), (None, "日本語 テスト 한국어 " * 40),
           (6, "qzx kjwq xvzk qqj zxkw " * 60)]
    got = {r.doc_id: r for r in lid.predict(docs_of(odd), known).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and not any(got[k].accepted for k in (1, 2, 3, 6, None))
    kept = lid.accepted(docs_of(odd + [(9, table.first().text)]), known).collect()
    assert 9 in {r.doc_id for r in kept} and not {1, 2, 3, 6, None} & {r.doc_id for r in kept} and kept[0].digest == "x"
    nothing = lid.learn(docs_of([]))
    assert [r.lang_pred for r in lid.predict(docs_of([(1, "some text")]), nothing).collect()] == ["und"]
    assert lid.predict(docs_of([]), known).count() == 0


def test_every_n_gram_is_kept(spark, docs_of):
    rng = random.Random(9)
    many = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(20_000)]
    docs = docs_of([(3 * k, " ".join(many[k::20])) for k in range(20)], lang="x")
    learned = {r.doc_id for r in docs.where((lid.remainder("doc_id") != 1) & (
        lid.F.crc32(lid.F.col("doc_id").cast("string")) % (3 * lid.CALIBRATION_SHARE) >= 3)).collect()}
    counts = grams_of([w for k in range(20) if 3 * k in learned for w in many[k::20]], lid.ORDER)
    assert len(counts[lid.ORDER]) > 80_000  # what each order of one language was cut to
    got = lid.learn(docs).models["x"]
    assert [len(keys) for keys, _ in got.grams] == [len(counts[k]) for k in range(1, lid.ORDER + 1)]
    want = lid.fit({k: (list(c), np.array(list(c.values()))) for k, c in counts.items()})
    texts = many[:50] + ["zzq", "abcabc"]
    assert lid.Scorer({"x": got}).entropies(texts)[0] == pytest.approx(lid.Scorer({"x": want}).entropies(texts)[0], rel=1e-9)


def test_joined_models_as_broadcast_ones(spark, sf_small, docs_of):
    table = spark.read.parquet(f"{sf_small}/documents.parquet").where("doc_id < 60")
    one, two = lid.learn(table), lid.learn(table, broadcast_grams=0)
    assert isinstance(two, lid.Tabled) and two.grams.count() > 1000
    assert set(one.limits) == set(two.limits)
    for lang, limit in one.limits.items():
        assert two.limits[lang] == pytest.approx(limit, rel=1e-9)
    odd = [(1, None), (2, ""), (3, "12 34 ²½ !!"), (5, "x"), (None, "日本語 テスト 한국어 " * 40), (7, "x"), (7, "qzx kjwq " * 90)]
    docs = docs_of(odd + [(r.doc_id + 100, r.text) for r in table.where("doc_id < 30").collect()])
    told = lambda found: sorted(((r.doc_id or 0, r.letters, r.lang_pred, r.accepted, round(r.score, 8), round(r.entropy, 8))
                                 for r in found.collect()), key=str)
    assert told(lid.predict(docs, two)) == told(lid.predict(docs, one))
    kept = lambda found: sorted((r.doc_id or 0, r.text, r.digest) for r in found.collect())
    assert kept(lid.accepted(docs, two)) == kept(lid.accepted(docs, one)) != []


def test_long_runs_of_letters_count_whole(spark, words):
    rng = random.Random(4)
    runs = ["".join(rng.choices("abcdé", k=n)) for n in (63, 64, 65, 66, 100, 127, 128, 129, 130, 192, 1000)]
    rows = spark.createDataFrame([(" ".join(words + runs), "x")], "text string, lang string")
    got, counts = lid._collected(lid._levels(rows, 4), 4)["x"], grams_of(words + runs, 4)
    for k in range(1, 5):
        assert dict(zip(got[k][0], got[k][1].tolist())) == dict(counts[k])
    scorer = lid.Scorer({"x": lid.fit(got, 4)})
    for run in ["zabce" * 13, "".join(rng.choices("abcdéz", k=200)), *runs[:-1]]:
        padded = f" {run} "
        want = sum(math.log(brute_prob(counts, padded[max(0, p - 3):p + 1])) for p in range(1, len(padded)))
        h, n = scorer.entropies([run])
        assert n[0] == len(run) + 1 and h[0, 0] == pytest.approx(-want / n[0], rel=1e-6)
    same, other = ("ab" * 40 + tail * 300 for tail in ("c", "d"))  # agree in their first 80 letters
    a, b = scorer.entropies([same, other])[0]
    assert a[0] != b[0]
