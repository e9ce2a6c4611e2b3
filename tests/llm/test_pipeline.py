import json
from collections import defaultdict

import numpy as np
import corpus_pipeline
from tidemark.llm import language_id, line_dedup, packing, pii
from tidemark.llm.common import table, tokenizer_path

from .test_line_dedup import kept_lines
from .test_simhash import brute_components, brute_fingerprint, near_pairs


def brute(rows, identifier, min_words=50):
    """The stages before packing, row by row: (doc_id, text) -> the same."""
    rows = [r for r, j in zip(rows, identifier.judge([t or "" for _, t in rows])) if j[-1]]
    # line dedup
    seen, out = set(), []
    for k, t in sorted(rows):
        lines, gone = kept_lines(t), set()
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b].split())
                if words >= min_words:
                    run = tuple(lines[a:b + 1])
                    if run in seen:
                        gone |= set(range(a, b + 1))
                    seen.add(run)
        out.append((k, line_dedup.without(t, [(g, g) for g in gone]) if gone else t))
    fps = {k: brute_fingerprint(t) for k, t in out}
    roots = brute_components(near_pairs(set(fps.values())), set(fps.values()))
    first = {}
    for k, _ in out:
        first.setdefault(roots[fps[k]], k)
    return {k: pii.redacted(t) for k, t in out if first[roots[fps[k]]] == k}


def test_stages_against_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, language_id.learn(docs))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_small)
        assert kept.columns == docs.columns, name
    kept = kept.collect()
    assert {r.doc_id: r.text for r in kept} == want and len(kept) == len(want) < len(rows)
    assert all(r.n_chars == len(r.text) for r in kept if r.text != dict(rows)[r.doc_id])

    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    ids, sequences = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_small).collect():
        ids[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(ids) == set(want)
    for k, pieces in ids.items():
        assert [i for _, p in sorted(pieces) for i in p] == library.encode(want[k], add_special_tokens=False).ids + [2]
    for pieces in sequences.values():
        assert [o for o, _ in sorted(pieces)] == [0, *np.cumsum([n for _, n in sorted(pieces)])[:-1].tolist()]


def test_odd_rows_in_every_stage(spark, docs_of, sf_small):
    docs = docs_of([(1, None), (2, ""), (3, "12 %% 34"), (None, "the and of is it that with for to"), (4, "word " * 40_000),
                    (4, "word " * 40_000), (4, "another text")])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_small)
        assert name == "packing" or out.columns == docs.columns
        json.dumps([r.asDict() for r in out.collect()])
        assert stage(spark, docs_of([]), sf_small).count() == 0


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "pii", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and packing.WINDOW == 4096
