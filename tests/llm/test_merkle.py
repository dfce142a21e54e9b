"""The Merkle manifest against a plain tree, and on groups of many shapes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clickloom.llm import common, merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """The root, and for each leaf its siblings from below."""
    level, paths, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            if i ^ 1 < len(level):
                paths[k].append(level[i ^ 1])
        level = [sha(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def wanted(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for doc, source, lang, n, text in rows:
        leaf = sha(*map(field, (doc, source, lang, n, text)))
        groups.setdefault("" if lang is None else "=" + lang, []).append((doc, leaf))
    names = sorted(groups, key=str.encode)
    trees = {g: plain_tree([leaf for _, leaf in sorted(groups[g])]) for g in names}
    root, upper = plain_tree([trees[g][0] for g in names])
    return {(doc, leaf): (trees[g][0], root, sha(*path, *upper[k])) for k, g in enumerate(names)
            for (doc, leaf), path in zip(sorted(groups[g]), trees[g][1])}


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 1, None: 1}, {"a": 2, "b": 3, "é": 5, "": 7}, {"x": 1025, "y": 33},
                                   {"big": 2500, None: 1024}, {str(i): 1 for i in range(1100)}])
def test_against_a_plain_tree(spark, sizes):
    rows, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 10007, "s" if n % 5 else None, lang, None if n % 3 == 0 else n, f"tëxt {n}" if n % 4 else None))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.manifest(docs, F.col("n_chars") + (F.col("doc_id") % 2), width=4).select(
        "doc_id", merkle.hex_text(F.col("leaf")).alias("leaf"), merkle.hex_text(F.col("subroot")).alias("subroot"),
        merkle.hex_text(F.col("root")).alias("root"), merkle.proof_digest(F.col("path")).alias("proof"),
        merkle.folded(merkle.hex_text(F.col("leaf")), F.col("path")).alias("folded"),
        merkle.folded(merkle.hex_text(F.col("shown")), F.col("path")).alias("shown_root"), "path").collect()
    assert {(r.doc_id, r.leaf): (r.subroot, r.root, r.proof) for r in found} == wanted(rows) and len(found) == len(rows)
    counts = {doc: n for doc, _, _, n, _ in rows}
    for r in found:
        assert r.folded == r.root
        assert (r.shown_root == r.root) == (counts[r.doc_id] is None or r.doc_id % 2 == 0)
        assert all((s.digest is None) == (s.lo == s.hi) for s in r.path)


def test_equal_rows_are_dealt_over_ranges(spark, monkeypatch):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"),
                                    F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    found = merkle.manifest(docs)
    assert found.count() == 4000 and found.select("root").distinct().count() == 1
    leaf = "".join(f"{v}" for v in ("-", "1:s", "2:en", "1:1", "1:t"))
    root, _ = plain_tree([sha(leaf)] * 4000)
    assert found.select(merkle.hex_text(F.col("root"))).first()[0] == root
    tables, name = {}, "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(merkle, "written", lambda df, name: tables.setdefault(name, common.written(df, name)))
    spark.conf.set(name, "false")
    try:
        ranks = merkle.ranked(docs.select(F.lit("g").alias("g"), "doc_id"), "doc_id")
        assert sorted(r.lo for r in ranks.collect()) == list(range(4000))
    finally:
        spark.conf.set(name, "true")
    assert max(r["count"] for r in tables["ranged"].groupBy("part").count().collect()) < 2000
