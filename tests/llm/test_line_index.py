"""Reversible line removal: the filter, the index as documents come and go, and hot lines."""

import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from clickloom.llm import line_index
from clickloom.llm.common import written as common_written
from clickloom.llm.cuckoo import CuckooFilter
from clickloom.llm.line_index import LineIndex

SCHEMA = "doc_id long, text string, keys string"


def plain(rows, asked=None):
    """What is left of each text, by keys counted in a dictionary."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip("\x20\t\n\x0b\x0c\r"))
    holders = {}
    for n, (doc, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(doc)
    least = -1 << 62
    keeper = {k: max(least if d is None else d for d in docs) for k, docs in holders.items() if len(docs) >= 3}
    out = []
    for doc, text in rows if asked is None else asked:
        lines = (text or "").split("\n")
        kept = [line for line in lines if (least if doc is None else doc) >= keeper.get(key(line), least)]
        out.append((str(doc), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def shown(df):
    return sorted((str(r.doc_id), r.line_dedup.n_lines, r.line_dedup.n_dropped, r.line_dedup.kept) for r in df.collect())


def some_rows(rng, ids, common):
    line = lambda: rng.choice([rng.choice(common), rng.choice(common).upper(), "  " + rng.choice(common) + "\t\r", "short",
                               "", "only here " + "".join(rng.choice("abcdé") for _ in range(15))])
    return [(d, "\n".join(line() for _ in range(rng.randint(0, 8)))) for d in ids]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), unique=True, max_size=300), st.data())
def test_filter_holds_members_until_removed(members, data):
    held = CuckooFilter.sized(len(members))
    hashes = np.array(members, np.uint64)
    assert held.insert(hashes[:100]) and held.insert(hashes[100:])
    assert held.contains(hashes).all()
    gone = np.array(data.draw(st.lists(st.booleans(), min_size=len(members), max_size=len(members))), bool)
    held.remove(hashes[gone])
    held = CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(hashes[~gone]).all()
    held.remove(hashes[~gone])
    assert not held.table.any()


def test_filter_load_and_false_answers():
    hashes = np.random.default_rng(1).integers(0, 1 << 64, 300_000, np.uint64)
    held = CuckooFilter.sized(100_000)
    assert held.insert(hashes[:100_000]) and held.contains(hashes[:100_000]).all()
    assert held.contains(hashes[100_000:]).mean() < 3e-4
    assert not CuckooFilter.sized(10).insert(hashes[:1000])


def test_documents_come_and_go(spark):
    rng = random.Random(6)
    common = [f"a line that many documents have, number {i}" for i in range(12)] + ["é" * 19, "é" * 20, "x" * 19, "x" * 20]
    first = some_rows(rng, [*range(40), None, None, 5, 5], common)
    more = some_rows(rng, [*range(40, 60), None, 7], common)
    frame = lambda rows: spark.createDataFrame([(*r, "z") for r in rows], SCHEMA)
    index = LineIndex.build(frame(first))
    found = index.apply(frame(first))
    assert found.columns == ["doc_id", "text", "keys", "line_dedup"] and shown(found) == plain(first)
    grown = index.insert(frame(more))
    assert shown(grown.apply(frame(first + more))) == plain(first + more)
    ids = [d for d, _ in first + more if d is None or d % 3] + [999]
    shrunk = grown.delete(spark.createDataFrame([(d,) for d in ids], "doc_id long"))
    left = [r for r in first + more if r[0] not in ids]
    assert shown(shrunk.apply(frame(left))) == plain(left)
    back = grown.delete(frame(more).select("doc_id").where("doc_id >= 40"))
    rest = first + [r for r in more if r[0] is None or r[0] < 40]
    assert shown(back.apply(frame(rest))) == plain(rest)
    # The filters hold exactly the marks of the common keys, and the counts are those of a fresh index.
    anew = LineIndex.build(frame(rest))
    key = lambda r: (bytes(r.key), r.docs, r.keeper)
    assert sorted(map(key, back.counts.collect()), key=str) == sorted(map(key, anew.counts.collect()), key=str)
    marks = lambda i: sorted(m for r in i.filters.collect() for m in CuckooFilter.from_bytes(r.filter).table.ravel() if m)
    assert marks(back) == marks(anew)


def test_shards_groups_and_full_filters(spark, monkeypatch):
    monkeypatch.setattr(line_index, "SHARD_KEYS", 8)
    monkeypatch.setattr(line_index, "GROUP_ROWS", 50)
    rng = random.Random(3)
    common = [f"a line that many documents have, number {i}" for i in range(60)]
    rows = [(d, "\n".join([common[0], *rng.sample(common, 5)])) for d in range(300)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA)
    index = LineIndex.build(docs)
    assert index.shards > 4 and shown(index.apply(docs)) == plain(rows)
    tables = {}
    monkeypatch.setattr(line_index, "written", lambda df, name: tables.setdefault(name, common_written(df, name)))
    assert index.suspects().count() >= 300
    assert max(r["groups"] for r in tables["groups"].collect()) >= 300 // 50
    monkeypatch.undo()
    fresh = [(1000 + d, "\n".join(f"lines that came later, {d % 700}, {k}" for k in range(40))) for d in range(2100)]
    more = spark.createDataFrame([(*r, "z") for r in fresh], SCHEMA)
    grown = index.insert(more)
    assert shown(grown.apply(more)) == plain(rows + fresh, fresh)
