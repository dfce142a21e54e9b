"""Every registered query against its SQL or a brute-force version, on a small scale and on the awkward tables."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from clickloom.llm import queries
from tests.compare import differences

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def connect(folder):
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        path = f"{folder}/{name}.parquet"
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("where", ["sf", "edges"])
def test_sql(spark, sf_dir, edge_dir, name, where):
    if name == "op4_warc_zip" and where == "edges":
        pytest.skip("null and repeated page ids are tested in test_operators")
    folder = sf_dir if where == "sf" else edge_dir
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    rows = queries.QUERIES[name](spark, empty_dir).collect()
    assert [r.conv_id for r in rows] == [-7] if name == "op6_chat_format" else rows == []


def by_id(rows):
    out = {}
    for row in rows:
        out.setdefault(row["doc_id"], []).append(row)
    return out


@pytest.mark.parametrize("where", ["sf", "edges"])
def test_packing(spark, sf_dir, edge_dir, tables, where):
    import public_tokenizers
    from tokenizers import Tokenizer
    folder = sf_dir if where == "sf" else edge_dir
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = queries.op1_packing(spark, folder).collect()
    wanted, found = Counter(), Counter()
    for row in tables(folder, "documents"):
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [2]
        wanted[row["doc_id"], len(ids)] += len(ids)
        if where == "sf":
            data = np.array(ids, "<u4")
            for p in (p for p in pieces if p.doc_id == row["doc_id"]):
                assert zlib.crc32(data[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    sequences = {}
    for p in pieces:
        found[p.doc_id, p.doc_tokens] += p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert found == wanted
    ends = []
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        ends.append(end)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(end == 4096 for end in sorted(ends)[1:]) and max(ends) <= 4096


def cut(docs, length):
    """Brute force: the removed bytes of each text, by every string of ``length`` bytes."""
    bodies = [(row["text"] or "").encode() for row in docs]
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for row, b in zip(docs, bodies):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((row["doc_id"], len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("where", ["sf", "edges"])
def test_suffix_dedup(spark, sf_dir, edge_dir, tables, where):
    folder = sf_dir if where == "sf" else edge_dir
    found = [tuple(r) for r in queries.op3_suffix_dedup(spark, folder).collect()]
    wanted = cut(tables(folder, "documents"), 200)
    assert Counter(found) == Counter(wanted)
    assert sum(r[2] for r in wanted) > 0


KINDS = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I), 2, 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    found = sorted((m.start(), i, kind, m.end()) for i, (kind, pattern, group, least) in enumerate(KINDS)
                   for m in pattern.finditer(text) if len(m[group]) >= least)
    return [f"{kind}:{start}:{end}" for start, _, kind, end in found]


@pytest.mark.parametrize("where", ["sf", "edges"])
def test_secret_scan(spark, sf_dir, edge_dir, tables, where):
    folder = sf_dir if where == "sf" else edge_dir
    found = queries.op5_secret_scan(spark, folder).collect()
    wanted = Counter()
    for row in tables(folder, "documents"):
        spans = base_spans(row["text"] or "")
        wanted[row["doc_id"], hashlib.sha256(",".join(spans).encode()).hexdigest(),
               *(sum(s.startswith(kind) for s in spans) for kind, *_ in KINDS)] += 1
    assert Counter((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in found) == wanted
    for r in found:
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == [] or r.n_assign + r.n_access + r.n_hex


def simhash(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in SPACES.split(lower) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """For each (doc_id, fingerprint): the smallest id reachable over links of at most 2 bits."""
    values = sorted({f for _, f in prints})
    parent = {f: f for f in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for doc, f in prints:
        if doc is not None:
            least[find(f)] = min(doc, least.get(find(f), doc))
    return Counter((doc, f"{f:016x}", least.get(find(f))) for doc, f in prints)


@pytest.mark.parametrize("where", ["sf", "edges"])
def test_simhash(spark, sf_dir, edge_dir, tables, where):
    folder = sf_dir if where == "sf" else edge_dir
    found = queries.op8_simhash(spark, folder).collect()
    prints = [(row["doc_id"], simhash(row["text"])) for row in tables(folder, "documents")]
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == grouped(prints)


def test_quality_on_held_out_rows(spark, tables):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.op7_quality(spark, folder).collect()}
    assert len(found) == len(tables(folder, "documents"))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found.values())
    judged = [(found[row["doc_id"]], row["quality"]) for row in tables(folder, "labels") if found[row["doc_id"]].held_out]
    assert np.mean([r.predicted == quality for r, quality in judged]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())


def test_quality_on_edges(spark, edge_dir, tables):
    rows = queries.op7_quality(spark, edge_dir).collect()
    assert len(rows) == len(tables(edge_dir, "documents"))
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) <= 2 and all(0 <= r.score <= 1 for r in rows)


def test_language_on_held_out_rows(spark, tables):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.op10_language(spark, folder).collect()}
    docs = tables(folder, "documents")
    assert np.mean([found[d["doc_id"]].lang_pred == d["lang"] for d in docs
                    if found[d["doc_id"]].held_out and d["lang"]]) > 0.97


def test_language_on_edges(spark, edge_dir, tables):
    rows = queries.op10_language(spark, edge_dir).collect()
    docs = tables(edge_dir, "documents")
    assert len(rows) == len(docs)
    blank = [d["doc_id"] for d in docs if not any(c.isalpha() for c in d["text"] or "")]
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.lang_pred == "und") == sorted(
        (d is None, d) for d in blank)


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "clickloom")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    assert "clickloom.llm" not in open(os.path.join(folder, name)).read()
