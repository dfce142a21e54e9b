"""Tokenizer alignment against a plain walk over both token lists, and the merging of runs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickloom.llm import alignment, pair_runs, queries


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text, both):
    """The ids and byte lengths of both sides of a whole text, or none."""
    if not text:
        return None
    a, b = both
    byte = {c: v for c, v in alignment.byte_rule().items()}
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in b_ids]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    return (a_ids, np.cumsum([len(t) for t in a_bytes]).tolist()), (b_ids, np.cumsum([len(t) for t in b_bytes]).tolist())


def walk(found):
    (a_ids, a_at), (b_ids, b_at) = found
    links, groups, i, j, first = [], [], 0, 0, (0, 0)
    while i < len(a_ids):
        links.append((a_ids[i], b_ids[j]))
        if a_at[i] == b_at[j]:
            groups.append(",".join(map(str, a_ids[first[0]:i + 1])) + "|" + ",".join(map(str, b_ids[first[1]:j + 1])))
            i, j = i + 1, j + 1
            first = i, j
        elif a_at[i] < b_at[j]:
            i += 1
        else:
            j += 1
    return links, ";".join(groups)


def plain(texts, both):
    walks = [found and (found, *walk(found)) for found in (tokens(t, both) for t in texts)]
    counts = Counter(link for w in walks if w for link in w[1])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    rows = []
    for w in walks:
        if w is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        found, links, groups = w
        rows.append((len(found[0][0]), len(found[1][0]), groups.count(";") + 1, len(links),
                     sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
                     hashlib.sha256(groups.encode()).hexdigest()))
    return rows, counts, best


@pytest.mark.parametrize("where", ["sf", "edges"])
def test_query(spark, sf_dir, edge_dir, tables, both, where):
    folder = sf_dir if where == "sf" else edge_dir
    docs = tables(folder, "documents")
    rows, _, _ = plain([d["text"] for d in docs], both)
    found = queries.op12_alignment(spark, folder).collect()
    assert Counter(map(tuple, found)) == Counter((d["doc_id"], *row) for d, row in zip(docs, rows))


def test_many_blocks_and_rounds(spark, both):
    rng = random.Random(8)
    parts = ["word", "The", " ", "  ", "\n", "\t", "▁", "<s>", "</s>", "<0x0A>", "<|endoftext|>", "<unk>", "é",
             "é", "漢字", "\U0001f642", "don't", "12345", " ", "　", "x" * 70, "a.b", "\x00", "\x7f"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    texts += [None, "", " ", " x", "x ", "the same text"] + ["the same text"] * 40
    docs = spark.createDataFrame([(i % 50, t, "z") for i, t in enumerate(texts)], "doc_id int, text string, pairs string")
    rows, counts, best = plain(texts, both)
    found = alignment.align(docs, block_chars=400, fan_in=3, part_blocks=2).collect()
    assert Counter((*r[:-1],) for r in found) == Counter((i % 50, *row) for i, row in enumerate(rows))
    assert all(r.groups_sha256 == (r.groups and hashlib.sha256(r.groups.encode()).hexdigest()) for r in found)
    mapped = alignment.mapping(docs, block_chars=400, fan_in=3).collect()
    assert {((r.a_id, r.b_id), r.links) for r in mapped} == set(counts.items()) and len(mapped) == len(counts)
    assert all(r.best == (r.links == best[r.b_id]) for r in mapped)
    assert any(row[0] == 0 for row, t in zip(rows, texts) if t)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 60).map(lambda i: i << 15), st.integers(1, 9), min_size=1), max_size=6),
       st.integers(1, 5))
def test_merging_runs(found, frame):
    kept, pair_runs.FRAME = pair_runs.FRAME, frame
    try:
        runs = [pair_runs.run_of(np.array(sorted(f), np.uint32), np.array([f[k] for k in sorted(f)])) for f in found]
        wanted = sum((Counter(f) for f in found), Counter())
        steps = list(pair_runs.frames(pair_runs.merged_run(runs)))
        pairs = [int(p) for frame_pairs, _ in steps for p in frame_pairs]
        assert pairs == sorted(wanted) and [int(t) for _, ts in steps for t in ts] == [wanted[p] for p in pairs]
    finally:
        pair_runs.FRAME = kept
