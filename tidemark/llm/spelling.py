"""Spelling variants: words one edit apart, found through pairs of trie nodes.

A word's prefixes are nodes of a trie, its suffixes nodes of the trie of the
reversed words.  Both sorts of nodes are numbered (one row per node), and a word
is then told by integer pairs (prefix node, suffix node):

* the pairs at which the suffix follows the prefix, which hold the whole word;
* the pairs that skip one letter.

Two words share a skipping pair exactly if they differ in the letter skipped: a
group by that pair.  A word's skipping pair is another's whole pair exactly if
the first has one letter more: a join on that pair, in which each skipping pair
meets one word at most.  Of equal letters in a row only the first is skipped, so
each pair of words is found once.  The neighbours are exact; nothing is compared
afterwards.

A group holds at most one word per letter of the alphabet (90), so its
neighbours are read from its sorted list, without its pairs.  Everything else is
a join or an aggregate over integers: words are numbered by falling frequency,
then by code point, and so the best of a word's neighbours is their minimum.
Roots are found by pointer doubling; a form has at least ``ratio`` times the
occurrences, so the chains are short.

A node is told by its letters, up to ``PLAIN`` of them, and by the SHA-256 of
them beyond, which keeps the rows of a long word linear in its length.

Defined results: a null text has no words; a null id counts as "-".  Rows that
repeat an id and a text count each.  Extra columns are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
DROP_EVERY = 97
PLAIN = 48
_FLUSH_WORDS, _FLUSH_BYTES, _FLUSH_PLACES = 300_000, 8_000_000, 50_000
# texts are read as Latin-1, other characters as "?"; A-Z is lower-cased before
_RUN = re.compile(rb"[a-z\xc0-\xff]+")


def runs(doc_id, text: str | None, drop_every: int = DROP_EVERY) -> Counter:
    """The words of a text and how often each occurs, with the letter left out of every ``drop_every``-th run (by checksum)."""
    out: Counter = Counter()
    data = (text or "").encode("latin-1", "replace").lower()  # of bytes: ASCII letters only
    base = zlib.crc32(f"{'-' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(m[0] for m in _RUN.finditer(data)).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
        if drop_every and h % drop_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def counted(docs: DataFrame, min_letters: int = MIN_LETTERS, drop_every: int = DROP_EVERY, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """word, n over all documents."""

    def told(total):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def run(batches):
        total: Counter = Counter()
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in runs(doc_id, text.as_py(), drop_every).items():
                    if len(word) >= min_letters:
                        size += 0 if word in total else len(word)
                        total[word] += n
                if len(total) > _FLUSH_WORDS or size > _FLUSH_BYTES:
                    yield told(total)
                    total, size = Counter(), 0
        yield told(total)

    rows = docs.select(F.col(id_col), F.col(text_col))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def labels(word: str) -> list[str]:
    """What tells the trie node of each prefix, from the empty one on: its letters, or beyond ``PLAIN`` their hash."""
    out = [word[:k] for k in range(min(len(word), PLAIN) + 1)]
    sha = hashlib.sha256(word[:PLAIN].encode())
    for letter in word[PLAIN:]:
        sha.update(letter.encode())
        out.append("#" + sha.hexdigest())
    return out


def places(words: DataFrame) -> DataFrame:
    """id, skips, first, before, after: the labelled pairs of each word of ``words`` (id, word).

    ``first`` is false where the letter skipped is the same as the one before it.
    """
    names = ["id", "skips", "first", "before", "after"]

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for key, word in zip(*(c.to_pylist() for c in batch.columns)):
                before, after = labels(word), labels(word[::-1])[::-1]
                for k in range(len(word) + 1):
                    rows.append((key, False, True, before[k], after[k]))
                    if k < len(word):
                        rows.append((key, True, k == 0 or word[k - 1] != word[k], before[k], after[k + 1]))
                    if len(rows) >= _FLUSH_PLACES:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])

    return words.select("id", "word").mapInArrow(run, "id long, skips boolean, first boolean, before string, after string")


def _nodes(labelled: DataFrame, side: str) -> DataFrame:
    """The trie's nodes and their numbers."""
    return saved(labelled.select(side).distinct().withColumn(f"{side}_node", F.monotonically_increasing_id()), f"spelling-{side}")


def near(words: DataFrame) -> DataFrame:
    """id, best (the least id among its neighbours), n_near, of each word of ``words`` (id, word) that has a neighbour."""
    labelled = saved(places(words), "spelling-places")
    pairs = labelled
    for side in ("before", "after"):
        pairs = pairs.join(_nodes(labelled, side), side)
    pairs = saved(pairs.select("id", "skips", "first", "before_node", "after_node"), "spelling-pairs")
    key = ["before_node", "after_node"]

    # one letter replaced: as many words as the alphabet has letters, at most
    group = pairs.where("skips").groupBy(*key).agg(F.array_sort(F.collect_list("id")).alias("ids")).where("size(ids) > 1")
    replaced = group.select("ids", F.explode("ids").alias("id")).select(
        "id", F.when(F.col("id") == F.col("ids")[0], F.col("ids")[1]).otherwise(F.col("ids")[0]).alias("best"),
        (F.size("ids") - 1).cast("long").alias("n"))
    # one letter more, one letter less
    whole = pairs.where("NOT skips").select(*key, F.col("id").alias("shorter"))
    longer = pairs.where("skips AND first").join(whole, key).select("id", "shorter")
    ends = F.array(F.struct("id", F.col("shorter").alias("best")), F.struct(F.col("shorter").alias("id"), F.col("id").alias("best")))
    inserted = longer.select(F.explode(ends).alias("e")).select("e.id", "e.best", F.lit(1).cast("long").alias("n"))
    return replaced.unionByName(inserted).groupBy("id").agg(F.min("best").alias("best"), F.sum("n").alias("n_near"))


def roots(steps: DataFrame) -> DataFrame:
    """id, root: the end of each chain of ``steps`` (id, to), where to = id ends one.  Chains double in length per round."""
    steps = saved(steps.select("id", "to", F.lit(True).alias("moved")), "spelling-steps")
    while steps.where("moved").limit(1).count():
        ahead = steps.select(F.col("id").alias("to"), F.col("to").alias("next"))
        steps = saved(steps.join(ahead, "to").select("id", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")),
                      "spelling-steps")
    return steps.select("id", F.col("to").alias("root"))


def variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO,
             drop_every: int = DROP_EVERY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of at least ``min_letters`` and ``min_count`` occurrences."""
    counts = saved(counted(docs, min_letters, drop_every, id_col, text_col).where(F.col("n") >= min_count), "spelling-counts")
    words = saved(counts.orderBy(F.col("n").desc(), "word").withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    numbers = words.select(F.col("id").alias("best"), F.col("n").alias("best_n"))
    linked = saved(near(words), "spelling-near").join(numbers, "best")
    found = words.select("id", "n").join(linked, "id", "left")
    form = F.when(F.col("best_n") >= F.lit(ratio) * F.col("n"), F.col("best"))
    found = saved(found.select("id", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"),
                               F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(found.select("id", F.coalesce("form", "id").alias("to")))
    spelled = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
    out = found.join(ends, "id").join(spelled("id"), "id").join(spelled("form"), "form", "left").join(spelled("root"), "root")
    return out.select(F.col("id_word").alias("word"), F.col("form_word").alias("form"), F.col("root_word").alias("root"),
                      "n", "n_near", "form_n")
