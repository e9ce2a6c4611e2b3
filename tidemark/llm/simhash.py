"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has 64 bits, one for each bit that is set in over half of the
hashes of the text's word shingles.  Two fingerprints link when at most three
bits differ.  Three bits touch at most three of the eight bytes, so linked
fingerprints share at least five positional bytes; and of any seven positions
at least four.  The inverted index therefore lists fingerprints under each
choice of four of the first seven bytes (35 keys).  Within a list, shared
positional bytes are tallied for each pair, pairs below five are dropped, and
the rest are verified bit by bit.  A pair is handled under its first shared key
only.

Equal fingerprints are one node, so copies make no pairs.  A list of more than
``MAX_LIST`` fingerprints is not paired: its members are listed anew under five
bytes (one more of the other four, which linked ones must share as well).  Such
a list has at most 2^24 members; it is connected by masking each choice of
three of its 24 free bits and joining equal rests, without forming pairs.
What leaves a list is a spanning forest of its links, not all links.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links as any other.  A text of fewer words than a shingle
is one shingle.  The component id is the smallest non-null doc_id, null only in
a component without any.  Extra columns are ignored by ``decide`` and kept by
``deduplicated``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing, row_key, saved
from .connected import components

WORDS, MAX_BITS, SEED = 3, 3, 42
MAX_LIST = 1024
_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
_KEYS = [sum(1 << p for p in c) for c in combinations(range(7), 4)]  # by lexicographic order of the positions
_FIVE = [sum(1 << p for p in c) for c in combinations(range(8), 5)]


def fingerprint(text: str, words: int = WORDS) -> int:
    w = text.encode().lower().split()  # bytes: lowers A-Z, splits at blank and \t to \r
    if not w:
        return 0
    n = min(words, len(w))
    digests = b"".join([xxhash.xxh64_digest(b" ".join(s), SEED) for s in zip(*(w[k:] for k in range(n)))])
    h = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(h[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, row (tells rows of one id apart), fp (the fingerprint as a signed long)."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py() or "", words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "row", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(freeing(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, row string, fp long")


def _key(mask: int, fp=None):
    """The bytes of ``mask``'s positions, side by side, under the mask."""
    key = F.lit(mask).cast("long")
    for p in range(8):
        if mask >> p & 1:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255).cast("long")))
    return key


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """A spanning forest of the links: each node but the roots, and its root."""
    up: dict[int, int] = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    nodes = [x for x in up if root(x) != x]
    return nodes, [root(x) for x in nodes]


def _linked(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys (four bytes under their mask), found under the first shared key."""
    found_a, found_b, d = [], [], 1
    at = np.flatnonzero(keys[1:] == keys[:-1])
    while len(at):
        x = fps[at] ^ fps[at + d]
        shared = x.view(np.uint8).reshape(-1, 8) == 0  # little-endian: column p is byte p
        first = shared[:, :7] & (np.cumsum(shared[:, :7], axis=1) <= 4)
        ok = (shared.sum(axis=1) >= 8 - max_bits) & (first @ (1 << np.arange(7)) == keys[at] >> 32)
        ok[ok] = np.bitwise_count(x[ok].view(np.uint64)) <= max_bits
        found_a.append(fps[at[ok]])
        found_b.append(fps[at[ok] + d])
        d += 1
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (fps[:0], fps[:0])


def _out(kind: int, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                      ["kind", "a", "b"])


def _tally(max_list: int, max_bits: int):
    """Batches of (key, fp), sorted, to (0, node, root) of links and (1, key, fp) of members of longer lists."""

    def paired(keys, fps):
        size = np.diff(np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)))
        long = np.repeat(size > max_list, size)
        if long.any():
            yield _out(1, keys[long], fps[long])
        a, b = _linked(keys[~long], fps[~long], max_bits)
        if len(a):
            yield _out(0, *_spanning(a, b))

    def run(batches):
        keys, fps, too_long = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if too_long is not None:  # the rest of a long list that has left already
                end = int(np.searchsorted(keys, too_long, "right"))
                if end:
                    yield _out(1, keys[:end], fps[:end])
                    keys, fps = keys[end:], fps[end:]
                if not len(keys):
                    continue
                too_long = None
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if last:
                yield from paired(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
            if len(keys) > max_list:
                yield _out(1, keys, fps)
                too_long, keys, fps = keys[0], keys[:0], fps[:0]
        if len(keys):
            yield from paired(keys, fps)

    return run


def _connect(fps: np.ndarray, free: list[int], max_bits: int) -> np.ndarray:
    """For each of the distinct fingerprints, which differ in the ``free`` bits only, the index of its component's first."""
    up = np.arange(len(fps))
    for bits in combinations(free, max_bits):
        if not up.any():
            break
        rest = fps & ~np.uint64(sum(1 << b for b in bits))
        order = np.argsort(rest, kind="stable")
        same = np.flatnonzero(rest[order[1:]] == rest[order[:-1]])
        i, j = order[same], order[same + 1]
        while len(i):
            i, j = up[i], up[j]
            differ = i != j
            i, j = i[differ], j[differ]
            np.minimum.at(up, np.maximum(i, j), np.minimum(i, j))
            while (up[up] != up).any():
                up = up[up]
    return up


def _dense(max_bits: int):
    """Batches of (key of five bytes, fp), sorted, to (0, node, root)."""

    def linked(key, fps):
        mask = int(key) >> 40
        free = [8 * p + k for p in range(8) if not mask >> p & 1 for k in range(8)]
        up = _connect(fps.view(np.uint64), free, max_bits)
        node = np.flatnonzero(up != np.arange(len(up)))
        if len(node):
            yield _out(0, fps[node], fps[up[node]])

    def run(batches):
        held, key = [], None
        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
            for a, b in zip(edges[:-1], edges[1:]):
                if keys[a] != key and held:
                    yield from linked(key, np.concatenate(held))
                    held = []
                key = keys[a]
                held.append(fps[a:b])
        if held:
            yield from linked(key, np.concatenate(held))

    return run


def links(nodes: DataFrame, max_list: int = MAX_LIST, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``nodes`` (fp) with at most ``max_bits`` differing bits."""
    if not 0 < max_bits <= 3:
        raise ValueError("the index is made for 1 to 3 bits")
    out = "kind int, a long, b long"
    # each row becomes 35: dealt out first, as adaptive execution may have merged the few bytes of ``nodes`` into one task
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = nodes.repartition(parts, "fp").select(F.explode(F.array(*(_key(m, F.col("fp")) for m in _KEYS))).alias("key"), "fp")
    tallied = saved(index.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(freeing(_tally(max_list, max_bits)), out),
                    "simhash-tally")
    # the members of long lists, under each key of five bytes that holds their four
    four = F.shiftrightunsigned("a", 32)
    five = F.array(*(F.when(four.bitwiseAND(F.lit(m)) == four, _key(m, F.col("b"))) for m in _FIVE))
    dense = tallied.where("kind = 1").select(F.explode(F.array_compact(five)).alias("key"), F.col("b").alias("fp")).distinct()
    dense = dense.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(freeing(_dense(max_bits)), out)
    return tallied.where("kind = 0").unionAll(dense).select("a", "b")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
           max_list: int = MAX_LIST, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, row, fp, root (a fingerprint that names the component), component_id."""
    fps = saved(fingerprints(docs, id_col, text_col, words), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = saved(components(links(nodes.select("fp"), max_list, max_bits)), "simhash-components")
    # every node with its component; those without links are their own
    linked = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    # written before it is joined: adaptive execution splits a hot fingerprint only between plain exchanges
    labels = saved(linked.select("fp", "root").join(named, "root"), "simhash-labels")
    return fps.join(labels, "fp").select("doc_id", "row", "fp", "root", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: that of the smallest id."""
    decided = decide(docs, id_col, text_col, words)
    keep = decided.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("keep"))
    rows = docs.select(F.struct("*").alias("_row"), row_key(id_col, text_col).alias("_key"))
    return rows.join(keep, rows["_key"] == keep["keep"], "left_semi").dropDuplicates(["_key"]).select("_row.*")
