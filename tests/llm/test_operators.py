"""Parts of the operators: exactness of each method, round trips, and the paths that small tables do not take."""

import io
import random
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickloom.llm import (
    chat_format, common, components, decontaminate, packing, quality_model, rule_ledger, secret_scan, simhash,
    suffix_dedup, warc_zip)
from clickloom.llm.lyndon import suffix_array
from tests.llm.test_queries import cut


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 5))
def test_suffix_array(symbols, times):
    symbols = symbols * times
    assert suffix_array(np.array(symbols, int)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_hilbert_is_a_path():
    grid = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)], np.uint32)
    key = packing.hilbert(grid, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(key)].astype(int), axis=0)).sum(1) == 1).all()


def test_tokens_of_words_are_tokens_of_the_text():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, rng = Tokenizer.from_file(path), random.Random(3)
    parts = ["don't", "<|endoftext|>", "É", "é", "́x", "12ab", "ΟΔΟΣ", "漢字", " ", "'re", "'S", "--", "🙂", "\x1c",
             "\x85", "İ", "a_b", "\x00", "‍"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "\n", "\t", "\x0b"]) for _ in range(rng.randint(0, 9)))
             for _ in range(500)]
    latin = [chr(i) for i in range(256)] + ["'s", "'LL", "the", "É", "12"]
    texts += ["".join(rng.choice(latin) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    for text, ids in zip(texts, packing.encode(texts, path)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_hot_curve_key_is_split(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same few words").alias("text"))
    path = __import__("public_tokenizers").path("word_bpe_49k.json")
    rows = packing.placed(packing.tokenized(docs, path)).collect()
    at = sorted((r.place, r.n) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(at, at[1:])) and at[0][0] == 0


def test_ablations(spark):
    texts = ["one two", "a " * 40, "# $ % & * a b c d e f g h i j k", "The usual text of a plain document with ten words.",
             "x y z w v u t s r q p o"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    book = rule_ledger.ledger(docs)
    masks = {r.doc_id: r.failures for r in book.collect()}
    names = [rule.name for rule in rule_ledger.RULES]
    for row in rule_ledger.ablations(book).collect():
        mask = rule_ledger.mask(rule_ledger.POLICIES[row.policy])
        bit = 1 << names.index(row.rule)
        assert row.failed == sum(m & bit > 0 for m in masks.values())
        assert row.only_this == sum(m & mask == bit for m in masks.values())
        assert row.kept == sum(m & mask == 0 for m in masks.values())
        assert row.kept_without == sum(m & mask & ~bit == 0 for m in masks.values())


def test_chat_segments_and_states(spark, edge_dir):
    turns = common.read(spark, edge_dir, "conversations")
    chats = {r.conv_id: r for r in chat_format.format_chats(turns).collect()}
    assert all("".join(s.text for s in r.segments) == r.formatted for r in chats.values())
    assert {k: r.valid for k, r in chats.items()} == {1: False, 2: False, 3: False, 4: False, None: False, 5: True}
    assert chats[1].final_state == "user" and chats[2].final_state == "error"
    assert [s.text for s in chats[5].segments if s.loss] == ["a" * 5000]


def test_pigeonring_finds_every_link(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(300)]
    for f in list(values):
        for flips in (1, 2, 2, 3):
            values.append(f ^ sum(1 << b for b in rng.sample(range(64), flips)))
    values = sorted({f - (1 << 64) if f >> 63 else f for f in values})
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fingerprint long")).collect()
    mask = (1 << 64) - 1
    wanted = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if ((a ^ b) & mask).bit_count() <= 2}
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_components_of_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    found = dict(map(tuple, components.components(spark.createDataFrame(pairs, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}


def test_keep_one_of_each_group(spark, edge_dir, tables):
    docs = common.read(spark, edge_dir, "documents")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {r.root for r in simhash.near_duplicates(docs).collect()}
    assert kept.count() == len(groups)


def test_decontamination_in_blocks(spark, edge_dir):
    docs, benchmark = (common.read(spark, edge_dir, name) for name in ("documents", "benchmark"))
    whole = decontaminate.annotate(docs, benchmark).select("doc_id", "text", "contamination").collect()
    parts = decontaminate.annotate(docs, benchmark, block_bytes=5).select("doc_id", "text", "contamination").collect()
    key = lambda r: (str(r.doc_id), r.text or "", str(r.contamination))
    assert sorted(map(key, whole)) == sorted(map(key, parts))
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {13, 14, 4} & {r.doc_id for r in kept.collect()} == set()


@pytest.mark.parametrize("most", [0, 1, 50_000])
def test_repeats_on_both_paths(spark, tables, most):
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    shared = [letters(rng.randint(20, 120)) for _ in range(6)]
    rows = [(i, "".join(rng.choice([*shared, letters(rng.randint(0, 60))]) for _ in range(rng.randint(0, 9))))
            for i in range(60)] + [(61, "ab" * 300), (62, None), (63, shared[0] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    length, gram = 40, 8
    found = suffix_dedup.remove_repeats(docs, length, gram, most).withColumn("kept", F.sha2("kept", 256)).collect()
    wanted = cut([{"doc_id": d, "text": t} for d, t in rows], length)
    assert sorted(map(tuple, found)) == sorted(wanted)


def test_long_texts_are_cut_in_pieces():
    rng = random.Random(2)
    body = "".join(rng.choice("ab") for _ in range(5000)).encode()
    def rows(limit):
        out = set()
        for data, ends, owner, begin in suffix_dedup.pieces([b"short", body, body[:300]], 40, limit):
            at, first, last, grams, _ = suffix_dedup.anchors(data, ends, 40, 8)
            for a, f, l, g in zip(at, first, last, grams):
                out |= {(int(owner[a]), int(p - begin[a]), int(a - begin[a]), int(g)) for p in range(f, l + 1)}
        return out
    assert rows(1 << 20) == rows(500)
    pieces = list(quality_model.parts(["x" * 100, "y" * 5000, None, "z"], 1000))
    assert sum(len(b) for _, group in pieces for b in group) >= 5101


def test_markov_model_tells_random_from_ordinary(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    samples = secret_scan.random_samples(spark).unionByName(secret_scan.identifier_samples(docs))
    model = secret_scan.fit(samples)
    texts = ["key Zk3pQ9xLw7RtYb2NcVf8HsJd1Gm4Ea done", "path theseothersandthings_and_thentheothers end",
             "id 9f8b7c6d5e4f3a2b1c0d9e8f7a6b5c4d", "token=abcdef", None]
    found = {r.doc_id: r for r in secret_scan.scan(
        spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()}
    kinds = {k: [s.kind for s in r.spans] for k, r in found.items()}
    assert kinds == {0: ["markov"], 1: [], 2: ["hex"], 3: ["assign"], 4: []}
    clean = secret_scan.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).collect()
    assert {r.doc_id: r.text for r in clean} == {
        0: "key [SECRET] done", 1: texts[1], 2: "id [SECRET]", 3: "[SECRET]", 4: None}
    untaught = secret_scan.fit(samples.limit(0))
    assert set(untaught.ratios) == {0.0}


@pytest.mark.parametrize("force64", [False, True])
def test_zip_directories(force64):
    stream = io.BytesIO()
    package = warc_zip.Package(stream, force64)
    members = {"archive/data.warc.gz": [b"abc", b"", b"d" * 3000], "indexes/index.cdx": [b"0 3\n"], "empty": []}
    for name, parts in members.items():
        package.open(name)
        for part in parts:
            package.write(part)
        package.end()
    package.close()
    data = stream.getvalue()
    with zipfile.ZipFile(stream) as other:
        assert other.testzip() is None
        assert {n: other.read(n) for n in other.namelist()} == {n: b"".join(p) for n, p in members.items()}
    reader = warc_zip.Reader(len(data), lambda at, n: data[at:at + n])
    for name, parts in members.items():
        at, size = reader.stored(name)
        assert data[at:at + size] == b"".join(parts)
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w", zipfile.ZIP_STORED) as made:
        made.writestr("a", b"text")
        made.comment = b"a comment"
    data = other.getvalue()
    at, size = warc_zip.Reader(len(data), lambda at, n: data[at:at + n]).stored("a")
    assert data[at:at + size] == b"text"


def test_warc_round_trip(spark, edge_dir, tables):
    import base64
    import hashlib
    pages = common.read(spark, edge_dir, "pages")
    found = warc_zip.round_trip(pages).collect()
    told = lambda x: None if x is None else str(x)
    digest = lambda h: base64.b32encode(hashlib.sha1(h).digest()).decode()
    wanted = []
    rows = tables(edge_dir, "pages")
    for row in rows:
        body = (row["html"] or "").encode()
        first = min((r["page_id"] for r in rows if (r["html"] or "").encode() == body and r["page_id"] is not None),
                    default=None)
        revisit = first is not None and row["page_id"] != first
        wanted.append((told(row["page_id"]), "revisit" if revisit else "response", told(first) if revisit else None,
                       digest(body), len(body), None if revisit else body))
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes,
                    None if r.payload is None else bytes(r.payload)) for r in found), key=key) == sorted(wanted, key=key)
    large = warc_zip.typed(pages, least=100)
    assert large.where("record_type = 'revisit'").count() == 0


def test_small_packages_and_ranges(spark, sf_dir, tmp_path):
    pages = common.read(spark, sf_dir, "pages")
    packages = warc_zip.write(warc_zip.typed(pages), f"file://{tmp_path}", package_bytes=20_000, force64=True)
    assert packages.count() > 3
    found = {r.page_id: bytes(r.payload) for r in warc_zip.read(packages, 3).where("payload is not null").collect()}
    assert found == {str(r.page_id): r.html.encode() for r in pages.collect()}


def test_samples_are_bounded(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    some = common.bounded_sample(rows, 500, "doc_id")
    again = {r.doc_id for r in common.bounded_sample(rows, 500, "doc_id").collect()}
    assert 400 < some.count() < 600 and {r.doc_id for r in some.collect()} == again
    assert common.bounded_sample(rows.limit(7), 500, "doc_id").count() == 7
    assert common.bounded_sample(rows.limit(0), 500, "doc_id").count() == 0
    same = spark.range(5000).select(F.lit(1).alias("doc_id"))
    assert common.bounded_sample(same, 100, "doc_id").count() <= 200


def test_classifier_without_labels(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents")
    labels = spark.createDataFrame([], "doc_id long, label int")
    scored = quality_model.score(docs, quality_model.fit(docs, labels)).select("quality_score").distinct().collect()
    assert [r[0] for r in scored] == [0.5]
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, label int")
    assert quality_model.fit(docs, one).bias == 0.0
