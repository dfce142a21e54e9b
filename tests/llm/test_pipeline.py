"""The pipeline against a plain version of every stage, each on what its predecessor kept."""

import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from clickloom.llm import queries, secret_scan
from clickloom.llm.common import read, written
from tests.llm.test_near_dedup import least_ids
from tests.llm.test_queries import base_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(text, windows):
    found = words(text)
    hit = np.zeros(len(found), bool)
    for n in {len(w) for w in windows}:
        for i in range(len(found) - n + 1):
            if tuple(found[i:i + n]) in windows:
                hit[i:i + n] = True
    return hit.sum() > 0 and 20 * hit.sum() >= len(found)


def test_stages(spark, tables):
    folder = "/root/testdata/sf0.001"
    docs = read(spark, folder, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name)
        assert docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
    good, single, clean, hidden = kept
    start = {r["doc_id"]: r for r in tables(folder, "documents")}
    model = queries.fitted_quality(spark, folder, read(spark, folder, "documents"))
    scores = model.scores([r["text"] for r in start.values()])
    assert set(good) == {d for d, s in zip(start, scores) if s >= 0.5}
    labels = {r["doc_id"]: r["quality"] for r in tables(folder, "labels")}
    assert np.mean([(d in good) == (q == 1) for d, q in labels.items()]) > 0.9

    wanted, _ = least_ids(list(good), [r.text for r in good.values()])
    assert set(single) == wanted

    items = [words(r["text"]) for r in tables(folder, "benchmark")]
    windows = {tuple(item[j:j + 13]) for item in items if item for j in range(max(1, len(item) - 12))}
    assert set(clean) == {d for d, r in single.items() if not contaminated(r.text, windows)}

    assert set(hidden) == set(clean)
    for d, row in hidden.items():
        assert base_spans(row.text) == []
        if row.text != clean[d].text:
            assert "[SECRET]" in row.text and row.n_chars == len(row.text)

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p.doc_id for p in pieces} == set(hidden)
    assert all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length for p in pieces)
    again = corpus_pipeline.run(spark, folder).collect()
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32, p.sequence_id, p.offset)
    assert Counter(map(key, again)) == Counter(map(key, pieces))


def test_awkward_tables(spark, edge_dir, empty_dir):
    for folder in (edge_dir, empty_dir):
        docs = read(spark, folder, "documents")
        for name, stage in corpus_pipeline.STAGES:
            after = written(stage(spark, docs, folder), name)
            assert name == "packing" or after.columns == docs.columns
            docs = after
        if folder == empty_dir:
            assert docs.count() == 0
