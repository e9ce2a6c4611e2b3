"""Language identification with interpolated Kneser-Ney character models.

One model per language over the letters of words (lower case, a blank before
and after each).  Counting covers all learning rows but those for calibration
(one in ``CALIBRATION_SHARE``): tasks count the n-grams of their distinct words,
Spark sums them, and derives the lower orders' type counts ("continuations": in
how many letters' company an n-gram occurs).  Every n-gram is kept.  Models of
up to ``BROADCAST_GRAMS`` n-grams are broadcast as sorted arrays: n-gram hashes
with their interpolated log probability, and context hashes with the log weight
of the next lower order.  Larger ones stay tables (``Tabled``), to which the
distinct n-grams of the texts are joined, with the same results.

A text's language is the one of the lowest cross-entropy per letter.  As the
models see words one by one, a task scores each distinct word once and keeps a
bounded cache.  Rejection is calibrated on learning rows that are left out of
the counts: a text is accepted while its cross-entropy is within what nearly
all calibration texts of its language show, wider for short texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected.  Without any learned language every text is.  A null id is never
learned from.  Ties go to the first language by name.  Extra columns are
ignored by ``predict`` and kept by ``accepted``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import groups
from .common import freeing, saved

ORDER = 5
BROADCAST_GRAMS = 1_000_000  # n-grams in all models together; larger models are joined instead
MAX_WORD = 64             # letters; longer runs of letters are taken in parts
BLOCK_LETTERS = 2_000_000 # that a task turns into n-grams at a time
FLUSH_WORDS = 200_000     # distinct words that a task counts before it emits n-grams
CACHE_WORDS = 150_000
CALIBRATION_SHARE = 61    # one learning row of so many is for calibration
SHORT_LETTERS = 400       # texts below this get a wider limit
DEFAULT_MARGIN = 1.0
MIN_MARGIN, MARGIN_FACTOR = 0.5, 1.5  # nats per letter; times the calibration texts' 99.9th percentile
SHARPNESS = 10.0          # of the score

_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; empty if the text has no letter."""
    found = _LETTERS.findall(text.lower())
    if not text.isascii() and not all(map(str.isalpha, found)):  # the pattern also takes numerals such as a raised 2
        found = [w for part in found for w in "".join(c if c.isalpha() else " " for c in part).split()]
    return found


def parts_of(words: list[str], order: int) -> list[str]:
    """The words, those of more than ``MAX_WORD`` letters in parts that are longer than that too.

    A part begins with a blank if its word does, or with letters of the part before as context, and ends with a blank
    if its word does: every letter is new in one part, after its full context of ``order`` - 1 letters (one at least).
    """
    over = max(order - 1, 1)
    if not words or max(map(len, words)) <= MAX_WORD:
        return words
    out = []
    for w in words:
        if len(w) <= MAX_WORD:
            out.append(w)
            continue
        starts = range(0, len(w) - MAX_WORD + 1, MAX_WORD)
        for a, b in zip(starts, [*starts[1:], len(w)]):
            out.append((w[a - over:b] if a else " " + w[:b]) + (" " if b == len(w) else ""))
    return out


def _blocks(words: list[str]):
    """Pieces of the list with about ``BLOCK_LETTERS`` letters: their first and last place."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    first = 0
    while first < len(words):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BLOCK_LETTERS, "right")))
        yield first, last
        first = last


def _flat(words: list[str], order: int) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Padded words or parts in one text, its code points, the word of each, the letters before each in its word or part,
    and the places of the characters to count: all but first blanks and the context of parts."""
    padded = [f" {w} " if len(w) <= MAX_WORD else w for w in words]
    text = "".join(padded)
    n = np.fromiter(map(len, padded), np.int64, len(padded))
    word = np.repeat(np.arange(len(words)), n)
    before = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    context = np.fromiter((1 if w[0] == " " else max(order - 1, 1) for w in padded), np.int64, len(padded))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    return text, points, word, before, np.flatnonzero(before >= context[word])


def _powers(n: int) -> np.ndarray:
    """Of the last character, then leftwards (modulo 2^64)."""
    return np.cumprod(np.append(np.uint64(1), np.full(n - 1, _BASE)))


def _hashes(points: np.ndarray, orders: int) -> list[np.ndarray]:
    """[k - 1][p]: a hash of the k characters that end at p (meaningless where they begin before the array)."""
    out, powers = [points.copy()], _powers(orders)
    for k in range(1, orders):
        h = out[-1].copy()
        h[k:] += points[:-k] * powers[k]
        out.append(h)
    return out


def _distinct(hashes: list[np.ndarray], at: np.ndarray, before: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the longest n-grams (up to ``order``) that end at ``at``: the place of each one's first, and each place's n-gram."""
    k = np.minimum(before[at] + 1, order)
    h = np.choose(k - 1, [x[at] for x in hashes]) * np.uint64(8) + k.astype(np.uint64)
    _, first, group = np.unique(h, return_index=True, return_inverse=True)
    return first, group


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


@dataclass
class Model:
    """Interpolated Kneser-Ney model of one language."""

    grams: list = field(default_factory=list)     # by order: sorted hashes, log probabilities
    contexts: list = field(default_factory=list)  # by length: sorted hashes, log weights of the next lower order
    unseen: float = 0.0                            # log probability of a letter that was never met
    entropy: float = 0.0                           # of the n-grams of the highest order it was fitted to

    def log_probs(self, hashes: list[np.ndarray], at: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Of the characters at places ``at``, after ``before`` known ones."""
        total, left = np.zeros(len(at)), np.arange(len(at))
        for k in range(len(self.grams), 0, -1):
            now = before[left] >= k - 1
            here = left[now]
            p = _find(*self.grams[k - 1], hashes[k - 1][at[here]], np.nan)
            miss = np.isnan(p)
            total[here[~miss]] += p[~miss]
            if k > 1:  # the weight of the lower order after this context, 1 if the context was never met
                total[here[miss]] += _find(*self.contexts[k - 2], hashes[k - 2][at[here[miss]] - 1], 0.0)
            left = np.sort(np.concatenate([left[~now], here[miss]]))
        total[left] += self.unseen
        return total


def fit(grams: dict[int, tuple[list[str], np.ndarray]], order: int = ORDER) -> Model:
    """A model from (n-grams, counts) by order."""
    model = Model()
    for k in range(1, order + 1):
        texts, counts = grams.get(k, ([], np.zeros(0)))
        if not len(texts):
            break
        counts = np.asarray(counts, float)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(-1, k).astype(np.uint64) + np.uint64(1)
        power = _powers(k)
        gram = (points[:, ::-1] * power).sum(axis=1, dtype=np.uint64)
        context = (points[:, -2::-1] * power[:-1]).sum(axis=1, dtype=np.uint64) if k > 1 else np.zeros(len(texts), np.uint64)
        keys, group = np.unique(context, return_inverse=True)
        discount = _discount((counts == 1).sum(), (counts == 2).sum())
        total = np.bincount(group, counts)
        weight = np.minimum(discount, counts)
        weight = np.bincount(group, weight) / total
        if k == 1:
            lower = np.full(len(texts), -math.log(len(texts) + 1))
            model.unseen = math.log(max(weight[0], 1e-6) / (len(texts) + 1))
        else:
            flat = points.reshape(-1)  # the n-grams side by side: each one's last character after k - 2 known ones
            at = np.arange(k - 1, len(flat), k)
            lower = model.log_probs(_hashes(flat, k - 1), at, np.full(len(at), k - 2))
            model.contexts.append((keys, np.log(weight)))
        p = np.maximum(counts - discount, 0) / total[group] + weight[group] * np.exp(lower)
        by = np.argsort(gram)
        model.grams.append((gram[by], np.log(p[by])))
        model.entropy = float(-(counts * np.log(p)).sum() / counts.sum())
    return model


class Scorer:
    """Scores texts under all languages' models, with a bounded cache of words."""

    def __init__(self, models: dict[str, Model]):
        self.langs = sorted(models)
        self.models = [models[k] for k in self.langs]
        self.order = max((len(m.grams) for m in self.models), default=1)
        self._forget()

    def _forget(self):
        self._index: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.models) + 1))

    def _learn(self, words: list[str]) -> None:
        found = [self._scores]
        for a, b in _blocks(words):
            _, points, word, before, at = _flat(words[a:b], self.order)
            hashes = _hashes(points, self.order)
            # a letter's probability depends on its n-gram only, and n-grams repeat: each is looked up once
            first, gram = _distinct(hashes, at, before, self.order)
            once = at[first]
            scores = [np.bincount(word[at], m.log_probs(hashes, once, before[once])[gram], b - a) for m in self.models]
            found.append(np.stack([*scores, np.bincount(word[at], minlength=b - a)], axis=1))
        first = len(self._index)
        self._index.update(zip(words, range(first, first + len(words))))
        self._scores = np.concatenate(found)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts x languages), and the number of characters; 0 of a text without letters."""
        by_text = [parts_of(words_of(t), self.order) for t in texts]
        flat = [w for ws in by_text for w in ws]
        if len(self._index) > CACHE_WORDS:
            self._forget()
        at = np.fromiter(map(self._index.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            met = list(map(flat.__getitem__, new))
            self._learn(list(set(met)))
            at[new] = list(map(self._index.__getitem__, met))
        sums = np.concatenate([np.zeros((1, len(self.models) + 1)), np.cumsum(self._scores[at], axis=0)])
        ends = np.cumsum([0, *map(len, by_text)])
        total = sums[ends[1:]] - sums[ends[:-1]]
        n = np.rint(total[:, -1])
        return -total[:, :-1] / np.maximum(n, 1)[:, None], n


@dataclass
class Identifier:
    """Models with their calibrated limits; broadcast to the tasks."""

    models: dict[str, Model]
    limits: dict[str, tuple[float, float]] = field(default_factory=dict)  # mean cross-entropy, margin

    def scorer(self) -> Scorer:
        """With a cache of its own: one for each task, which ends with it."""
        return Scorer(self.models)

    def judge(self, texts: list[str], scorer: Scorer | None = None) -> list[tuple[str, float, float, int, bool]]:
        """(language, score, cross-entropy, characters, accepted) of each text."""
        s = scorer or self.scorer()
        if not s.langs:
            return [("und", 0.0, 0.0, 0, False)] * len(texts)
        return _decided(s.langs, self.limits, *s.entropies(texts))


@dataclass
class Tabled:
    """Models of any size as tables, with their calibrated limits."""

    langs: list[str]
    order: int
    grams: DataFrame      # gram, by_lang: its last letter's log probability in each language, null where it is not met
    contexts: DataFrame   # context, by_lang: the log weight of the next lower order
    unseen: list[float]   # by language
    limits: dict[str, tuple[float, float]]


def _decided(langs: list[str], limits: dict, h: np.ndarray, n: np.ndarray) -> list[tuple[str, float, float, int, bool]]:
    """From cross-entropies (texts x languages) and numbers of characters."""
    best = h.argmin(axis=1)
    low = h[np.arange(len(h)), best]
    score = 1 / np.exp(SHARPNESS * (low[:, None] - h)).sum(axis=1)
    mean, margin = np.array([limits[k] for k in langs]).reshape(-1, 2)[best].T
    ok = low <= mean + margin * _width(n)
    return [(langs[b], float(p), float(e), int(c), bool(a)) if c else ("und", 0.0, 0.0, 0, False)
            for b, p, e, c, a in zip(best, score, low, n, ok)]


def _width(n):
    return np.sqrt(1 + SHORT_LETTERS / np.maximum(n, 1))


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3: rows with 1 are held out."""
    return F.crc32(F.col(id_col).cast("string")) % 3


def _count(order: int):
    """Batches of (text, lang) to (lang, n-gram, n): the highest order, and shorter ones that begin a word."""

    def emit(counters):
        for lang, words in counters.items():
            all_words, all_n = list(words), np.fromiter(words.values(), np.int64, len(words))
            for a, b in _blocks(all_words):
                text, points, word, before, at = _flat(all_words[a:b], order)
                hashes = _hashes(points, order)
                first, group = _distinct(hashes, at, before, order)
                once = at[first]
                sizes = np.minimum(before[once] + 1, order)
                grams = [text[p - size + 1:p + 1] for p, size in zip(once.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()),
                     pa.array(np.rint(np.bincount(group, all_n[a:b][word[at]])).astype(np.int64))], ["lang", "gram", "n"])

    def run(batches):
        counters: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                counters.setdefault(lang.as_py(), Counter()).update(parts_of(words_of(text.as_py()), order))
                if sum(map(len, counters.values())) > FLUSH_WORDS:
                    yield from emit({k: c for k, c in counters.items() if c})
                    counters = {}
        yield from emit({k: c for k, c in counters.items() if c})

    return run


def _text_grams(text: str, order: int) -> Counter:
    """The longest n-grams (up to ``order``) that end at each letter of a text's words, with their counts."""
    out: Counter = Counter()
    for word, n in Counter(words_of(text)).items():
        padded = f" {word} "
        for p in range(1, len(padded)):
            out[padded[max(0, p - order + 1):p + 1]] += n
    return out


def _levels(rows: DataFrame, order: int) -> DataFrame:
    """Of rows (text, lang): lang, k, gram, n: every n-gram of every order and its Kneser-Ney count."""
    counted = rows.mapInArrow(freeing(_count(order)), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # written once: every order below reads it
    counted = saved(counted.withColumn("k", F.length("gram")), "language-grams")
    level = counted.where(F.col("k") == order)
    levels = [level]
    for k in range(order - 1, 0, -1):
        more = level.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        level = counted.where(F.col("k") == k).unionByName(more.withColumn("k", F.lit(k)))
        # a word's beginning never has a letter before it, so no n-gram comes from both sides
        levels.append(level)
    everything = levels[0]
    for level in levels[1:]:
        everything = everything.unionByName(level)
    return everything


def _collected(levels: DataFrame, order: int) -> dict[str, dict[int, tuple[list[str], np.ndarray]]]:
    out: dict = {}
    found = levels.select("lang", "k", "gram", "n").toArrow()
    for lang in found["lang"].unique().to_pylist():
        for k in range(1, order + 1):
            part = found.filter(pc.and_(pc.equal(found["lang"], lang), pc.equal(found["k"], k)))
            if len(part):
                out.setdefault(lang, {})[k] = (part["gram"].to_pylist(), part["n"].to_numpy())
    return out


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _tabled(levels: DataFrame, order: int) -> Tabled:
    """What ``fit`` computes, as tables."""
    told = {(r.lang, r.k): r for r in levels.groupBy("lang", "k").agg(
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
        F.count(F.lit(1)).alias("types")).collect()}
    langs = sorted({lang for lang, _ in told})
    value = lambda by: F.element_at(F.create_map(*(F.lit(x) for kv in by.items() for x in kv)), F.col("lang"))
    lower, probs, weights, unseen, entropy = None, [], [], {}, {}
    for k in range(1, order + 1):
        here = {lang: r for (lang, kk), r in told.items() if kk == k}
        if not here:
            break
        level = levels.where(F.col("k") == k).select(
            "lang", "gram", "n", value({lang: _discount(r.once, r.twice) for lang, r in here.items()}).alias("d"),
            F.expr(f"left(gram, {k - 1})").alias("context"), F.expr("substring(gram, 2)").alias("rest"))
        context = saved(level.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), (F.sum(F.least("d", F.col("n").cast("double"))) / F.sum("n")).alias("weight")), "language-contexts")
        rows = level.join(context, ["lang", "context"])
        if k == 1:
            rows = rows.withColumn("lower", 1 / (value({lang: r.types for lang, r in here.items()}) + 1))
            unseen = {r.lang: math.log(max(r.weight, 1e-6) / (here[r.lang].types + 1)) for r in context.collect()}
        else:
            rows = rows.join(lower.select("lang", F.col("gram").alias("rest"), F.exp("p").alias("lower")), ["lang", "rest"])
            weights.append(context.select("lang", "context", F.log("weight").alias("p")))
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")
        lower = saved(rows.select("lang", "gram", "n", F.log(p).alias("p")), "language-probabilities")
        probs.append(lower.select("lang", "gram", "p"))
        entropy |= {r.lang: r.h for r in lower.groupBy("lang").agg((-F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias("h")).collect()}

    def by_lang(tables, key, label):
        rows = tables[0]
        for t in tables[1:]:
            rows = rows.unionByName(t)
        each = F.array(*(F.max(F.when(F.col("lang") == lang, F.col("p"))) for lang in langs))
        return saved(rows.groupBy(key).agg(each.alias("by_lang")), label)

    return Tabled(langs, len(probs), by_lang(probs, "gram", "language-model"), by_lang(weights, "context", "language-weights"),
                  [unseen[lang] for lang in langs], {lang: (entropy[lang], DEFAULT_MARGIN) for lang in langs})


def _gram_scores(wanted: DataFrame, model: Tabled) -> DataFrame:
    """Of distinct n-grams (gram): gram, scores (the log probability of the last letter in each language)."""
    wanted = saved(wanted.withColumn("k", F.length("gram")), "language-wanted")
    needs, need = [], None
    for k in range(model.order, 0, -1):  # those n-grams and, order by order, what they back off to
        own = wanted.where(F.col("k") == k).select("gram")
        if need is not None:
            own = own.unionByName(need.select(F.expr("substring(gram, 2)").alias("gram"))).distinct()
        need = saved(own, "language-needed")
        needs.append((k, need))
    lower, scores = None, []
    # one order after the other: no n-gram is joined by more others than there are letters
    for k, need in reversed(needs):
        rows = need.join(model.grams.withColumnRenamed("by_lang", "p"), "gram", "left")
        if k == 1:
            score = [F.coalesce(F.col("p")[i], F.lit(u)) for i, u in enumerate(model.unseen)]
        else:
            rows = rows.withColumn("context", F.expr(f"left(gram, {k - 1})")).withColumn("rest", F.expr("substring(gram, 2)"))
            rows = rows.join(model.contexts.withColumnRenamed("by_lang", "w"), "context", "left")
            rows = rows.join(lower.select(F.col("gram").alias("rest"), F.col("scores").alias("lower")), "rest")
            score = [F.coalesce(F.col("p")[i], F.coalesce(F.col("w")[i], F.lit(0.0)) + F.col("lower")[i])
                     for i in range(len(model.langs))]
        lower = saved(rows.select("gram", F.array(*score).alias("scores")), "language-scores")
        scores.append(lower)
    out = scores[0]
    for level in scores[1:]:
        out = out.unionByName(level)
    return out


def _by_joins(rows: DataFrame, model: Tabled, first: str) -> DataFrame:
    """As ``_judged``: the texts' n-grams are joined to the tables."""
    langs, limits, order = model.langs, model.limits, model.order
    gram = pa.list_(pa.struct([("gram", pa.string()), ("n", pa.int64())]))
    named = first.split()[0]

    def count(batches):
        for batch in batches:
            for at, texts in groups(batch.column(2)):
                found = [_text_grams(t, order) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)),
                     pa.array([sum(x.values()) for x in found], pa.int64()),
                     pa.array([[{"gram": g, "n": n} for g, n in x.items()] for x in found], gram)],
                    [named, "row", "letters", "grams"])

    def decide(batches):
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]
        for batch in batches:
            n = batch.column(1).to_numpy()
            h = np.array([x or [0.0] * len(langs) for x in batch.column(2).to_pylist()]).reshape(-1, len(langs))
            columns = list(zip(*_decided(langs, limits, h, n))) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             [named, "lang_pred", "score", "entropy", "letters", "accepted"])

    # the row numbers hold because they are written with what belongs to them
    counted = saved(rows.select(rows.columns[0], F.monotonically_increasing_id().alias("row"), rows.columns[1]).mapInArrow(
        freeing(count), f"{first}, row long, letters long, grams array<struct<gram:string,n:long>>"), "language-texts")
    each = counted.select("row", F.explode("grams").alias("g")).select("row", "g.*")
    scores = _gram_scores(each.select("gram").distinct(), model)
    mean = F.array(*(-F.sum(F.col("n") * F.col("scores")[i]) / F.sum("n") for i in range(len(langs))))
    entropies = saved(each.join(scores, "gram").groupBy("row").agg(mean.alias("h")), "language-entropies")
    return counted.select(named, "row", "letters").join(entropies, "row", "left").select(named, "letters", "h").mapInArrow(
        decide, f"{first}, lang_pred string, score double, entropy double, letters long, accepted boolean")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
          broadcast_grams: int = BROADCAST_GRAMS) -> Identifier | Tabled:
    """Models of the languages that ``docs`` name, from rows that are not held out."""
    rows = docs.where((remainder(id_col) != 1) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    left_out = F.crc32(F.col(id_col).cast("string")) % (3 * CALIBRATION_SHARE) < 3
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), left_out.alias("left_out"))
    levels = saved(_levels(rows.where("NOT left_out").select("text", "lang"), order), "language-levels")
    # a language without calibration texts (in a small table) keeps the fit's own figure and a wide margin
    if levels.count() > broadcast_grams:
        identifier = _tabled(levels, order)
    else:
        models = {k: fit(g, order) for k, g in _collected(levels, order).items()}
        identifier = Identifier(models, {k: (m.entropy, DEFAULT_MARGIN) for k, m in models.items()})
    judged = _judged(rows.where("left_out").select("lang", "text"), identifier, "lang string")
    right = judged.where("lang = lang_pred AND letters > 0")
    means = {r.lang: r.m for r in right.groupBy("lang").agg(F.avg("entropy").alias("m")).collect()}
    mean = F.create_map(*(F.lit(x) for kv in means.items() for x in kv))[F.col("lang")] if means else F.lit(0.0)
    spread = right.groupBy("lang").agg(F.percentile_approx(
        (F.col("entropy") - mean) / F.sqrt(1 + SHORT_LETTERS / F.col("letters")), 0.999).alias("top"))
    identifier.limits |= {r.lang: (means[r.lang], max(MIN_MARGIN, MARGIN_FACTOR * r.top)) for r in spread.collect()}
    return identifier


def _judged(rows: DataFrame, identifier: Identifier | Tabled, first: str) -> DataFrame:
    """Of rows (anything, text): the first column and the judgement."""
    if isinstance(identifier, Tabled):
        return _by_joins(rows, identifier, first)
    shared = rows.sparkSession.sparkContext.broadcast(identifier)

    def run(batches):
        judge, scorer = shared.value.judge, shared.value.scorer()
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]
        for batch in batches:
            for at, texts in groups(batch.column(1)):
                columns = zip(*judge(texts, scorer))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    [first.split()[0], "lang_pred", "score", "entropy", "letters", "accepted"])

    return rows.mapInArrow(freeing(run), f"{first}, lang_pred string, score double, entropy double, letters long, accepted boolean")


def predict(docs: DataFrame, identifier: Identifier | Tabled, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), entropy, letters, accepted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _judged(rows, identifier, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}")


def accepted(docs: DataFrame, identifier: Identifier | Tabled, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is accepted as one of the learned languages."""
    if isinstance(identifier, Tabled):
        key = F.sha2(F.col(text_col), 256)
        judged = _judged(docs.select(key.alias("_key"), F.col(text_col).alias("text")), identifier, "_key string")
        good = saved(judged.where("accepted").select(F.col("_key")).distinct(), "language-accepted")
        return docs.join(good, F.sha2(docs[text_col], 256) == good["_key"], "left_semi")
    shared = docs.sparkSession.sparkContext.broadcast(identifier)
    text_at = docs.columns.index(text_col)

    def run(batches):
        judge, scorer = shared.value.judge, shared.value.scorer()
        for batch in batches:
            for at, texts in groups(batch.column(text_at)):
                yield batch.slice(at, len(texts)).filter(pa.array([x[-1] for x in judge(texts, scorer)], pa.bool_()))

    return docs.mapInArrow(freeing(run), docs.schema)
