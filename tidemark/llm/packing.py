"""Sequence packing: bounded-space online best fit, leftovers merged at the end.

Each task keeps a fixed number of open windows.  A document's ids (with the end
id) are cut into full windows, and the rest is placed in the open window with
the smallest gap that holds it.  When none does and no more may be opened, the
fullest window is emitted; if its gap is worth a fragment, the waiting piece is
cut to fill it.  The windows still open at the end of the tasks, a fixed number
per task, are merged: laid end to end over all tasks and cut anew into full
windows, the last of them into windows of a power of two ids, which need no
padding.

All windows but the merged ones are final when their task ends; the merge moves
only sizes of windows, and the pieces of open windows take one join.  The first
step is written to the shared scratch folder, so a task that runs again after an
executor is lost cannot disagree with what later steps have read.

Defined results: a null text counts as empty, and an empty one is packed as its
end id.  Rows that repeat an id are packed each for itself.  Extra columns are
ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bpe import encoder, slices
from .common import freeing, saved

WINDOW = 4096
OPEN_WINDOWS = 64
MIN_FRAGMENT = 32  # a gap below this is padded; no piece is cut for it
FLUSH_IDS = 500_000  # ids in an output batch
_MERGED = 1 << 62  # sequence ids of merged windows begin here

_PIECES = "task long, win long, offset long, doc_id {}, start long, length long, doc_tokens long, ids array<int>, ids_crc32 long, closed boolean"


class Packer:
    """The open windows of one task.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int, open_windows: int, min_fragment: int):
        self.window, self.most, self.min_fragment = window, open_windows, min_fragment
        self.gaps: list[tuple[int, int]] = []  # (gap, window number), ascending
        self.open: dict[int, list] = {}
        self.opened = 0

    def _place(self, piece, gap: int, k: int) -> None:
        self.open.setdefault(k, []).append(piece)
        insort(self.gaps, (gap - len(piece[2]), k))

    def add(self, doc_id, ids: np.ndarray):
        """Place a document; yields (window number, pieces) of each window that is closed."""
        n, at = len(ids), 0
        while n - at >= self.window:
            self.opened += 1
            yield self.opened - 1, [(doc_id, at, ids[at:at + self.window].copy(), n)]
            at += self.window
        while at < n:
            piece = (doc_id, at, ids[at:].copy(), n)  # a copy: a window must not keep its batch's ids in memory
            best = bisect_left(self.gaps, (n - at, -1))
            if best < len(self.gaps):
                self._place(piece, *self.gaps.pop(best))
                return
            if len(self.gaps) == self.most:
                gap, k = self.gaps.pop(0)
                full = self.open.pop(k)
                if gap >= self.min_fragment:
                    full.append((doc_id, at, ids[at:at + gap].copy(), n))
                    at += gap
                yield k, full
            else:
                self.opened += 1
                self._place(piece, self.window, self.opened - 1)
                return

    def rest(self):
        yield from sorted(self.open.items())


def _batch(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    """rows: (task, window number, offset, piece, closed)."""
    task, win, offset, pieces, closed = zip(*rows)
    doc, start, ids, total = zip(*pieces)
    n = np.array([len(x) for x in ids])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()),
                                     pa.array(np.concatenate(ids).astype(np.int32)))
    long = [pa.array(x, pa.int64()) for x in (task, win, offset, start, n, total, [_crc(x) for x in ids])]
    return pa.RecordBatch.from_arrays([*long[:3], pa.array(doc, kind), *long[3:6], lists, long[6], pa.array(closed)],
                                      "task win offset doc_id start length doc_tokens ids ids_crc32 closed".split())


def _crc(ids: np.ndarray) -> int:
    """Over the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def _windows(docs: DataFrame, path: str, end_id: int, window: int, open_windows: int, min_fragment: int) -> DataFrame:
    def run(batches):
        bpe, packer, task = encoder(path), Packer(window, open_windows, min_fragment), TaskContext.get().partitionId()
        rows, waiting, kind = [], 0, pa.int64()

        def laid(k, pieces, closed):
            offset = 0
            for piece in pieces:
                rows.append((task, k, offset, piece, closed))
                offset += len(piece[2])
            return offset

        for batch in batches:
            kind = batch.schema.field(0).type
            for first, texts in slices(batch.column(1)):
                ids, at = bpe.encode(texts)
                ids = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
                for doc_id, a, b in zip(batch.column(0).slice(first, len(texts)).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    for k, pieces in packer.add(doc_id, ids[a:b]):
                        waiting += laid(k, pieces, True)
                        if waiting >= FLUSH_IDS:
                            yield _batch(rows, kind)
                            rows, waiting = [], 0
        bpe.forget()
        for k, pieces in packer.rest():
            laid(k, pieces, False)
        if rows:
            yield _batch(rows, kind)

    rows = docs.select(F.col("doc_id"), F.col("text"))
    return rows.mapInArrow(freeing(run), _PIECES.format(rows.schema["doc_id"].dataType.simpleString()))


def tail_sizes(ids: int) -> list[int]:
    """``ids`` as falling powers of two."""
    return [1 << k for k in range(ids.bit_length() - 1, -1, -1) if ids >> k & 1]


def pack(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         min_fragment: int = MIN_FRAGMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids, ids_crc32 (little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset."""
    pieces = saved(_windows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                            path, end_id, window, open_windows, min_fragment), "packing")
    columns = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    closed = pieces.where("closed").withColumn("sequence_id", F.expr("shiftleft(task, 32) + win")).select(columns)

    # leftovers laid end to end: tasks in order (one row per task), then the windows of each task
    left = pieces.where("NOT closed")
    wins = left.groupBy("task", "win").agg(F.sum("length").alias("used"))
    tasks = wins.groupBy("task").agg(F.sum("used").alias("used"))
    before = lambda w: F.coalesce(F.sum("used").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = tasks.select("task", before(Window.orderBy("task")).alias("task_at"))
    wins = wins.select("task", "win", before(Window.partitionBy("task").orderBy("win")).alias("win_at"))
    at = wins.join(tasks, "task").select("task", "win", (F.col("task_at") + F.col("win_at")).alias("win_at"))
    total = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    full, rest = divmod(total, window)
    tail, begin = [], full * window
    for k, size in enumerate(tail_sizes(rest)):
        tail.append(F.struct(F.lit(full + k).cast("long").alias("seq"), F.lit(begin).cast("long").alias("b"),
                             F.lit(begin + size).cast("long").alias("e")))
        begin += size
    # the merged windows that a piece (from a to z) reaches into
    left = left.join(at, ["task", "win"]).withColumn("a", F.col("win_at") + F.col("offset")).withColumn(
        "z", F.col("a") + F.col("length"))
    whole = F.transform(F.sequence(F.expr(f"a div {window}"), F.expr(f"(z - 1) div {window}")),
                        lambda k: F.struct(k.alias("seq"), (k * window).alias("b"), ((k + 1) * window).alias("e")))
    parts = F.filter(whole, lambda s: s["seq"] < full)
    if tail:
        parts = F.concat(parts, F.filter(F.array(*tail), lambda s: (s["e"] > F.col("a")) & (s["b"] < F.col("z"))))
    cut = left.withColumn("part", F.explode(parts)).withColumns(
        {"lo": F.greatest("a", "part.b"), "hi": F.least("z", "part.e")})
    merged = cut.select("doc_id", (F.col("start") + F.col("lo") - F.col("a")).alias("start"),
                        (F.col("hi") - F.col("lo")).alias("length"),
                        F.slice("ids", (F.col("lo") - F.col("a") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("ids"),
                        "doc_tokens", (F.lit(_MERGED) + F.col("part.seq")).alias("sequence_id"),
                        (F.col("lo") - F.col("part.b")).alias("offset"))
    return closed.unionByName(_with_crc(merged))


def _with_crc(pieces: DataFrame) -> DataFrame:
    """The pieces that the merge has cut, and their checksums."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            at, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            crc = [_crc(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield batch.append_column("ids_crc32", pa.array(crc, pa.int64()))

    return pieces.mapInArrow(freeing(run), StructType([*pieces.schema.fields, StructField("ids_crc32", LongType())]))
