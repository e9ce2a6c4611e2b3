import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, registry
from tidemark.llm.common import tokenizer_path

ODD = ["", "  ", None, "Hello world's  café <|endoftext|>x 123 aaa!!! Σΐσ İ", "a\x1cb\x85c​d", "a" * 50 + " " + "ab" * 40,
       "ＡＢ １２ ½²³ ªµ ẞ ﬁ 日本語テスト 한국어 é ́x \xa0y　z", "don't I'LL we'Ve 'S", "<|startoftext|><|endoftext|>",
       "<|x <|endoftext", "====" * 30 + "!?#", "\n\t a\r\n", "xyz" * 3000, "word " * 6000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_and_text_as_the_library(library):
    own = bpe.WordBpe(tokenizer_path())
    rng = random.Random(1)
    letters = "abcdefgh ABé'ß́日ﬁ½!?.\n\t\x1f\xa0<|endoftext|>Σς０"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    ids, at = own.encode(texts)
    for t, a, b in zip(texts, at[:-1], at[1:]):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want
        assert own.decode(ids[a:b]) == library.decode(want, skip_special_tokens=False)


def test_bounded_cache_gives_the_same_ids(monkeypatch):
    texts = [f"w{k} x{k % 7}" for k in range(500)]
    whole, _ = bpe.WordBpe(tokenizer_path()).encode(texts)
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 10)
    own = bpe.WordBpe(tokenizer_path())
    found = []
    for k in range(0, 500, 9):
        found.append(own.encode(texts[k:k + 9])[0])
        assert len(own._index) <= 10 // 2 + 1 + 18 and list(own._index.values()) == list(range(len(own._index)))
    assert np.concatenate(found).tolist() == whole.tolist()
    assert {f"x{k}" for k in range(7)} <= set(own._index)  # met more often than any other


def test_slices():
    texts = pa.array(["abc", None, "", "é" * 5, "x", "y" * 30, None])
    for size in (1, 4, 11, 1000):
        parts = list(bpe.slices(texts, size))
        assert [t for _, p in parts for t in p.to_pylist()] == ["abc", "", "", "é" * 5, "x", "y" * 30, ""]
        assert all(p.nbytes and (len(p) == 1 or sum(len(t.encode()) for t in p.to_pylist()) <= size) for _, p in parts)
        assert [a for a, _ in parts] == np.cumsum([0] + [len(p) for _, p in parts])[:-1].tolist()
    assert list(bpe.slices(pa.array([], pa.string()))) == []


def test_op8_on_whole_table(spark, sf_small, library):
    got = {r.doc_id: r for r in registry.QUERIES["op8_bpe"](spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert len(got) == len(docs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        g = got[d.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def check_pack(rows, docs, library, window=4096):
    """Every id lies in one piece, sequences are gapless; returns the share of padding."""
    want = {k: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for k, t in docs}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length])
        assert r.doc_tokens == len(want[r.doc_id]) and r.length > 0
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(want)
    for pieces, end in [(p, len(want[k])) for k, p in by_doc.items()] + [(p, None) for p in by_seq.values()]:
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at == end if end is not None else at <= window
    used = [sum(n for _, n in p) for p in by_seq.values()]
    padding = sum(window - u for u in used if u & (u - 1))
    return padding / sum(used)


def test_packing_odd_texts_and_whole_table(spark, sf_small, docs_of, library):
    docs = list(enumerate(ODD))
    rows = packing.pack(docs_of(docs), tokenizer_path(), open_windows=2).collect()
    check_pack(rows, docs, library)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert check_pack(registry.QUERIES["op1_packing"](spark, sf_small).collect(), docs, library) < 0.01


def test_packing_empty_table_and_null_or_repeated_ids(docs_of):
    assert packing.pack(docs_of([]), tokenizer_path()).count() == 0
    rows = packing.pack(docs_of([(None, "a"), (1, "b"), (1, "b"), (1, None)]), tokenizer_path()).collect()
    total = {}
    for r in rows:  # the last windows, of powers of two, may cut a piece
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {None: 2, 1: 5} and sum(r.start == 0 for r in rows) == 4


def test_packer_keeps_few_windows_open_and_pads_little():
    rng = random.Random(2)
    p, closed, most = packing.Packer(4096, 16, 32), [], 0
    for k in range(3000):
        closed += p.add(k, np.zeros(int(rng.lognormvariate(6.3, 1)) + 1, np.int32))
        most = max(most, len(p.open))
    assert most == 16
    fill = [sum(len(x[2]) for x in pieces) for _, pieces in closed]
    assert max(fill) <= 4096 and min(fill) > 4096 - 32


def brute_pack(sizes, window, most, min_fragment):
    """Closed windows in order and those left open, as lists of (document, start, length), by plain search."""
    open_, closed, opened = {}, [], 0
    free = lambda k: window - sum(n for *_, n in open_[k])
    for doc, size in enumerate(sizes):
        at = 0
        while size - at >= window:
            closed.append([(doc, at, window)])
            opened, at = opened + 1, at + window
        while at < size:
            fits = [k for k in open_ if free(k) >= size - at]
            if fits:
                open_[min(fits, key=lambda k: (free(k), k))].append((doc, at, size - at))
                at = size
            elif len(open_) < most:
                open_[opened] = [(doc, at, size - at)]
                opened, at = opened + 1, size
            else:
                fullest = min(open_, key=lambda k: (free(k), k))
                gap = free(fullest)
                pieces = open_.pop(fullest)
                if gap >= min_fragment:
                    pieces.append((doc, at, gap))
                    at += gap
                closed.append(pieces)
    return closed, [open_[k] for k in sorted(open_)]


@pytest.mark.parametrize("window, most, min_fragment", [(64, 1, 8), (64, 4, 8), (100, 7, 1), (50, 16, 51)])
def test_packer_equals_brute_force(window, most, min_fragment):
    rng = random.Random(window)
    sizes = [rng.choice((1, 5, rng.randint(1, window), rng.randint(1, 3 * window), window)) for _ in range(600)]
    packer = packing.Packer(window, most, min_fragment)
    told = lambda pieces: [(d, a, len(ids)) for d, a, ids, _ in pieces]
    closed = [told(p) for k, n in enumerate(sizes) for _, p in packer.add(k, np.arange(n))]
    assert (closed, [told(p) for _, p in packer.rest()]) == brute_pack(sizes, window, most, min_fragment)
    assert all(ids.tolist() == list(range(a, a + len(ids))) for _, pieces in packer.rest() for _, a, ids, _ in pieces)
