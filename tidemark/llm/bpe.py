"""BPE encoding and decoding in batched numpy merge rounds.

For vocabularies with word ends (white space dropped, lower case).  White space
separates the text into chunks that are encoded independently, so each batch of
texts is encoded as its distinct chunks: the symbols of all their words lie in
one flat array, and each round finds the rank of every neighbouring pair by
binary search over the sorted pair keys, and merges in each word all
occurrences of its lowest-ranked pair.  Words without a mergeable pair leave
the array.  Chunks met before are served from a bounded cache, which keeps the
chunks met most often when it is full.

The tables are read from the tokenizer's JSON file.  Normalisation and word
splitting of plain Latin chunks is done here; all other chunks go through the
tokenizer's own normaliser and pre-tokenizer, so that ids agree with the
library for any Unicode text.

Defined results: a null text counts as empty; an empty one, or one of white
space only, has no ids and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeing

# texts are encoded in groups of about so many characters, which bounds a task's memory
GROUP_CHARS = 1_000_000
SLICE_BYTES = 1_000_000
CACHE_CHUNKS = 300_000
LONG_WORD = 2_000  # bytes
_NO_RANK = np.iinfo(np.int32).max
# Latin-1 chunks, one a line: lower-casing is all of their normalisation
_PLAIN = re.compile(r"[\x21-\x7e\xa1-\xff\n]*")
_LATIN, _NUMERAL = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"  # of Latin-1, in lower case
_WORDS = re.compile(rf"[{_LATIN}]+|[{_NUMERAL}]|\n|'(?:s|t|re|ve|m|ll|d)|[^\n{_LATIN}{_NUMERAL}]+")
_ODD_SPACE = "[\x1c-\x1f]"  # splitting at white space takes these as such, the tokenizer does not


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if visible, else 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.special.items()}}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self._byte_of = {c: b for b, c in enumerate(letters)}
        # ids of each byte inside a word, and as a word's last byte
        self._start = np.array([[vocab[c] for c in letters], [vocab[c + end] for c in letters]], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        self._merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        # every word begins with its bytes' pairs: the ranks of all of those are searched once
        single = np.arange(self._start.max() + 1)
        left, right = np.repeat(single, len(single)), np.tile(single, len(single))
        self._byte_pairs = self._rank(left, right, np.ones(len(left), bool)).reshape(len(single), -1)
        tokenizer = Tokenizer.from_file(path)
        self._normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self._split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.forget()

    def forget(self) -> None:
        """Empty the cache; at the end of each task, as the worker may go on to other work."""
        self._index: dict[str, int] = {}
        # where each chunk's ids begin (one more than chunks), the ids, and how often each chunk was met; with room to grow
        self._begin, self._flat, self._met = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _keep_frequent(self) -> None:
        """Drop the half of the cache that was met least."""
        size = len(self._index)
        keep = np.sort(np.argsort(-self._met[:size], kind="stable")[:size // 2])
        chunks = list(self._index)
        lens, begin = np.diff(self._begin[:size + 1])[keep], self._begin[keep]
        ends = np.append(0, np.cumsum(lens))
        self._flat = self._flat[np.repeat(begin - ends[:-1], lens) + np.arange(ends[-1])]
        self._begin, self._met = ends, self._met[keep] // 2  # halved, so that what was frequent once goes in the end
        self._index = {chunks[k]: i for i, k in enumerate(keep.tolist())}

    def _plain_words(self, chunks: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Of Latin-1 chunks: all words' bytes, the size of each word, the number of words of each chunk."""
        text = "\n".join(chunks).lower()
        words = _WORDS.findall(text)  # with the line ends they make up the whole text
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.fromiter(map("\n".__eq__, words), bool, len(words))
        wide = np.append(0, np.cumsum(np.frombuffer(text.encode("latin-1"), np.uint8) >= 128))
        at = np.append(0, np.cumsum(size))
        size = (size + wide[at[1:]] - wide[at[:-1]])[~end]  # bytes: letters from 128 take two
        line = np.cumsum(end)[~end]
        return text.replace("\n", "").encode(), size, np.bincount(line, minlength=len(chunks))

    def words(self, chunk: str) -> list[bytes | int]:
        """Any chunk's words as bytes, and the ids of special tokens in it."""
        if "<" in chunk and self._special and self._special.search(chunk):
            parts = self._special.split(chunk)
            return [w for k, p in enumerate(parts) for w in ([self.special[p]] if k % 2 else self.words(p) if p else [])]
        return [bytes(map(self._byte_of.__getitem__, w)) for w, _ in self._split(self._normalize(chunk))]

    def _rank(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """Ranks of symbol pairs, by binary search; a pair that is not joined or never merged has none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & joined, self._ranks[at], _NO_RANK)

    def merge(self, data: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words of so many bytes: the ids of all in one flat array, and each word's number of ids."""
        word = np.repeat(np.arange(len(size)), size)
        data = np.frombuffer(data, np.uint8)
        last = np.zeros(len(data), np.int64)
        last[np.cumsum(size) - 1] = 1
        sym = self._start[last, data]
        done_w, done_s = [], []
        for k in np.flatnonzero(size > LONG_WORD):  # rounds over a word of many symbols are quadratic
            ids = self._merge_long(sym[word == k])
            done_w.append(np.full(len(ids), k))
            done_s.append(ids)
        if done_w:
            short = size[word] <= LONG_WORD
            sym, word = sym[short], word[short]
        # the rank of each symbol's pair with the next one of its word
        rank = np.append(np.where(word[:-1] == word[1:], self._byte_pairs[sym[:-1], sym[1:]], _NO_RANK), _NO_RANK) if len(sym) else sym
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            open_ = lowest != _NO_RANK
            if not open_.all():
                done_w.append(word[~open_])
                done_s.append(sym[~open_])
                sym, word, rank, lowest = sym[open_], word[open_], rank[open_], lowest[open_]
                if not len(sym):
                    break
            pos = np.flatnonzero(rank == lowest)
            # of overlapping occurrences (a a a) every second one, from the left
            new = np.append(True, (pos[1:] != pos[:-1] + 1) | (word[pos[1:]] != word[pos[:-1]]))
            if not new.all():
                begin = np.maximum.accumulate(np.where(new, np.arange(len(pos)), 0))
                pos = pos[(np.arange(len(pos)) - begin) % 2 == 0]
            sym[pos] = self._merged[rank[pos]]
            keep = np.ones(len(sym), bool)
            keep[pos + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            at = pos - np.arange(len(pos))
            for changed in (at, at[at > 0] - 1):
                nxt = np.minimum(changed + 1, len(sym) - 1)
                rank[changed] = self._rank(sym[changed], sym[nxt], (word[changed] == word[nxt]) & (nxt > changed))
        if not done_w:
            return np.zeros(0, np.int32), np.zeros(len(size), np.int64)
        w, s = np.concatenate(done_w), np.concatenate(done_s)
        order = np.argsort(w, kind="stable")
        return s[order].astype(np.int32), np.bincount(w, minlength=len(size))

    def _merge_long(self, sym: np.ndarray) -> np.ndarray:
        """The ids of one long word: its pairs wait in a heap, by rank and place."""
        n = len(sym)
        ids, nxt, prev = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self._rank(sym[:-1], sym[1:], np.ones(n - 1, bool)).tolist()
        heap = [(r, k) for k, r in enumerate(rank) if r != _NO_RANK]
        heapq.heapify(heap)
        pair = {}

        def ranked(k: int) -> int:
            key = ids[k], ids[nxt[k]]
            if key not in pair:
                a, b = np.array([key[0]]), np.array([key[1]])
                pair[key] = int(self._rank(a, b, np.array([True]))[0])
            return pair[key]

        rank.append(_NO_RANK)
        while heap:
            r, k = heapq.heappop(heap)
            if rank[k] != r:
                continue
            gone = nxt[k]
            ids[k], nxt[k], rank[gone] = int(self._merged[r]), nxt[gone], -1
            if nxt[k] < n:
                prev[nxt[k]] = k
            for j in (k, prev[k]):
                if j >= 0:
                    rank[j] = ranked(j) if nxt[j] < n else _NO_RANK
                    if rank[j] != _NO_RANK:
                        heapq.heappush(heap, (rank[j], j))
        out, k = [], 0
        while k < n:
            out.append(ids[k])
            k = nxt[k]
        return np.array(out, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks into the cache."""
        odd = []
        text = "\n".join(chunks)
        if not _PLAIN.fullmatch(text) or self._special and self._special.search(text):
            odd = [c for c in chunks if not _PLAIN.fullmatch(c) or self._special and self._special.search(c)]
            chunks = [*set(chunks).difference(odd), *odd]
        data, size, of = self._plain_words(chunks[:len(chunks) - len(odd)]) if len(odd) < len(chunks) else (b"", [], [])
        words: list[bytes] = []
        fixed: list[tuple[int, int]] = []  # (place among words, id) of special tokens
        n_odd = []
        for chunk in odd:
            found = self.words(chunk)
            n_odd.append(len(found))
            for w in found:
                if isinstance(w, int):
                    fixed.append((len(size) + len(words), w))
                    w = b"\x00"
                words.append(w)
        of = np.concatenate([of, n_odd]).astype(np.int64)
        ids, n = self.merge(data + b"".join(words), np.concatenate([size, [len(w) for w in words]]).astype(np.int64))
        if fixed:
            ids[(np.cumsum(n) - n)[[p for p, _ in fixed]]] = [i for _, i in fixed]
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(of))]
        first, used = len(self._index), self._begin[len(self._index)]
        self._index.update(zip(chunks, range(first, first + len(chunks))))
        self._begin = _room(self._begin, first + len(chunks) + 1)
        self._begin[first + 1:first + len(chunks) + 1] = used + ends[1:]
        self._flat = _room(self._flat, used + len(ids))
        self._flat[used:used + len(ids)] = ids
        self._met = _room(self._met, first + len(chunks))
        self._met[first:first + len(chunks)] = 0

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none null) in one flat array, and where each text begins (one more entry than texts)."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        if pc.any(pc.match_substring_regex(texts, _ODD_SPACE)).as_py():
            parts = pa.array([regex.split(r"[\s--[\x1c-\x1f]]+", t, flags=regex.V1) for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            parts = pc.utf8_split_whitespace(texts)
        chunks = parts.flatten().dictionary_encode()
        met = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist()
        if len(self._index) > CACHE_CHUNKS:
            self._keep_frequent()
        at = np.fromiter(map(self._index.get, met, repeat(-1)), np.int64, len(met))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            found = list(map(met.__getitem__, new))
            self._learn(found)
            at[new] = list(map(self._index.__getitem__, found))
        of = chunks.indices.to_numpy()
        self._met[at] += np.bincount(of, minlength=len(met))
        rows = at[of]
        n = self._begin[rows + 1] - self._begin[rows]
        out = np.append(0, np.cumsum(n))
        ids = self._flat[np.repeat(self._begin[rows] - out[:-1], n) + np.arange(out[-1])]
        return ids, out[np.append(0, np.cumsum(pc.list_value_length(parts).to_numpy()))]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' own strings, joined by blanks, as the library does for a file without a decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` values, and as much again when it has to grow."""
    if len(values) >= size:
        return values
    more = np.empty(2 * size, values.dtype)
    more[:len(values)] = values
    return more


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder per Python worker."""
    return WordBpe(path)


def groups(texts: pa.Array, chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) in groups of about ``chars`` bytes; nulls become empty."""
    first, group, size = 0, [], 0
    for k, t in enumerate(texts):
        t = t.as_py() or ""
        group.append(t)
        size += len(t)
        if size >= chars:
            yield first, group
            first, group, size = k + 1, [], 0
    if group:
        yield first, group


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(place of the first, texts) in slices of about ``size`` bytes; nulls become empty."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + size, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def _encoded(path: str):
    """Batches of (id, text) to batches of (id, ids, decoded)."""

    def run(batches):
        bpe = encoder(path)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                ids, at = bpe.encode(texts)
                decoded = [bpe.decode(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)),
                     pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])
        bpe.forget()

    return run


def _digested(batches):
    """Batches of (id, ids, decoded) to batches of (id, n_tokens, ids_sha256, decoded_sha256)."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    for batch in batches:
        lists = batch.column(1)
        at, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
        name = list(map(str, range(int(ids.max()) + 1))) if len(ids) else []
        shas = [sha(" ".join(map(name.__getitem__, ids[a:b].tolist()))) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(shas, pa.string()),
             pa.array([sha(t) for t in batch.column(2).to_pylist()], pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded (text)."""
    rows, first = _rows(docs, id_col, text_col)
    return rows.mapInArrow(freeing(_encoded(path)), f"{first}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256 of what ``encode`` gives.

    The batches of ``encode`` are digested in the same tasks, and their texts stay there.
    """
    rows, first = _rows(docs, id_col, text_col)
    run = _encoded(path)
    return rows.mapInArrow(freeing(lambda batches: _digested(run(batches))),
                           f"{first}, n_tokens long, ids_sha256 string, decoded_sha256 string")
