"""Alignment of two tokenizers by external spill counting.

Both tokenizers cut the same bytes (a space and the text). Where tokens of both end, a group ends; an A token and a B token
whose byte ranges overlap are linked; a pair of ids is counted by its links in all documents.

1. A block of documents is cut by both tokenizers. Its (pair, document, links) records are radix-partitioned by the B id,
   sorted, and spilled as zstd runs: the pairs with their totals, and the records.
2. The runs of totals of each partition are merged by a heap, ``fan_in`` at a time, in as many rounds as it takes. Pairs come
   out ordered by B id first, so the highest count of each B id is known where its pairs end.
3. The runs of records stream past the merged counts of their partition and hand back what each document gains: links whose
   pair has the highest count of its B id, and the sum of the counts. A block's parts are added up.

Scale: a record run belongs to one block, so a pair that a third of all documents hold is one entry of each run. Runs and
counts lie in written tables. A partition's merged counts hold at most 2 ** 31 / RADIX pairs, in practice thousands, and are
copied once for every ``part_blocks`` blocks.

Words between ASCII spaces repeat, and no token of either vocabulary crosses the start of one, so a worker keeps the ids of
the words it has met (``KEPT`` at most).

Defined cases: null and empty texts, and texts whose bytes a tokenizer does not give back, have no tokens and zeros; strings
of special tokens are plain text; repeated rows count each; ids may be null or repeated; other columns are ignored. A long
text is a block of its own and takes memory in proportion to its length.
"""

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from clickloom.llm.common import written
from clickloom.llm.pair_runs import best_of_each, frames, merged_run, packed, run_of, unpacked

RADIX = 64
FAN_IN = 64
PART_BLOCKS = 64
BLOCK_CHARS, BLOCK_DOCS = 2 << 20, 1 << 14
KEPT, KEPT_CHARS = 400_000, 64
# A word starts at a space between visible ASCII characters: neither vocabulary has a token across such a place.
START = re.compile(r"(?<=[!-~]) (?=[!-~])")
VISIBLE = re.compile(r"[!-~](?s:.*[!-~])?")
TOGETHER = 4000
SEPARATORS = (",", "|", ";", "")
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def byte_rule() -> dict[str, int]:
    """Visible Latin-1 characters stand for themselves, the other bytes for the characters from 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Words(dict):
    """For words: the ids of both tokenizers (16-bit) and whether both give back the word's bytes."""

    def __init__(self, a: Tokenizer, b: sentencepiece.SentencePieceProcessor, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.a, self.b, self.a_bytes, self.b_bytes = a, b, a_bytes, b_bytes

    def of(self, words: list[str]) -> list[tuple[bytes, bytes, bool]]:
        new = [w for w in dict.fromkeys(words) if w not in self]
        fresh = {}
        for at in range(0, len(new), TOGETHER):
            fresh |= self.encoded(new[at:at + TOGETHER])
        for word, found in fresh.items():
            if len(self) < KEPT and len(word) <= KEPT_CHARS:
                self[word] = found
        return [fresh.get(w) or self[w] for w in words]

    def encoded(self, words: list[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """Words that start and end in visible ASCII are encoded as one text and cut apart; the others one by one."""
        many = [w for w in words if VISIBLE.fullmatch(w)]
        text = " ".join(many)
        sides = [self.cut(ids, side, text, many) for ids, side in (
            (self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes),
            (self.b.encode(text, num_threads=1), self.b_bytes))] if many else [[], []]
        if None in sides:
            many, sides = [], [[], []]
        found = {w: (a, b, True) for w, a, b in zip(many, *sides)}
        for word in words:
            if word not in found:
                a, b = self.a.encode(" " + word, add_special_tokens=False).ids, self.b.encode(word, num_threads=1)
                body = (" " + word).encode()
                same = (b"".join(map(self.a_bytes.__getitem__, a)) == body
                        and b"".join(map(self.b_bytes.__getitem__, b)) == body)
                found[word] = np.array(a, "<u2").tobytes(), np.array(b, "<u2").tobytes(), same
        return found

    @staticmethod
    def cut(ids: list[int], side: list[bytes], text: str, words: list[str]) -> list[bytes] | None:
        """The ids of each word, as 16-bit numbers; none if the tokens do not end where the words do."""
        tokens = list(map(side.__getitem__, ids))
        if b"".join(tokens) != (" " + text).encode():
            return None
        ends = np.cumsum(list(map(len, tokens)))
        wanted = np.cumsum([len(w.encode()) + 1 for w in words])
        last = np.searchsorted(ends, wanted)
        if (ends[last] != wanted).any():
            return None
        body, stops = np.array(ids, "<u2").tobytes(), (2 * (last + 1)).tolist()
        return [body[a:b] for a, b in zip([0, *stops], stops)]


@lru_cache(maxsize=1)
def words_of(a_path: str, b_path: str) -> Words:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    to_byte = byte_rule()
    shown = [a.id_to_token(i) or "" for i in range(a.get_vocab_size())]
    a_bytes = [bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode() for t in shown]
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Words(a, b, a_bytes, b_bytes)


@lru_cache(maxsize=1)
def numerals() -> np.ndarray:
    """Each 16-bit id with each separator, as text."""
    return np.array([f"{i}{s}" for s in SEPARATORS for i in range(1 << 16)], object)


@lru_cache(maxsize=1)
def lengths(a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray]:
    known = words_of(a_path, b_path)
    return tuple(np.array([len(t) for t in side]) for side in (known.a_bytes, known.b_bytes))


@dataclass
class Aligned:
    """A block's documents: counts per document, the groups as text, and the links as (pair, document)."""

    counts: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    owner: np.ndarray


def aligned(texts: list[str | None], a_path: str, b_path: str) -> Aligned:
    words = [START.split(text) if text else [] for text in texts]
    flat = [w for ws in words for w in ws]
    found = words_of(a_path, b_path).of(flat)
    ends = np.cumsum([len(ws) for ws in words], dtype=np.int64)
    good = np.concatenate([[0], np.cumsum([not f[2] for f in found], dtype=np.int64)])
    spans = [(e - len(ws), e) for ws, e in zip(words, ends.tolist())]
    whole = [k for k, (a, b) in enumerate(spans) if b > a and good[a] == good[b]]

    sides, docs_end = [], []
    for side, sizes in enumerate(lengths(a_path, b_path)):
        bodies = [b"".join(f[side] for f in found[slice(*spans[k])]) for k in whole]
        ids = np.frombuffer(b"".join(bodies), "<u2")
        at = np.cumsum(sizes[ids])
        sides.append((ids, at))
        docs_end.append(np.cumsum([len(b) // 2 for b in bodies], dtype=np.int64))
    (a_ids, a_at), (b_ids, b_at) = sides
    counts = np.zeros((len(texts), len(COUNTS)), np.int64)
    if not len(a_ids):
        return Aligned(counts, [""] * len(texts), np.zeros(0, np.uint32), np.zeros(0, np.int64))
    ends_here = np.zeros((2, int(a_at[-1]) + 1), bool)
    ends_here[0, a_at] = ends_here[1, b_at] = True
    # Between neighbouring ends lies one token of either side: a link.
    at = np.flatnonzero(ends_here.any(0))
    ends_a, ends_b = ends_here[:, at]
    both = ends_a & ends_b
    a_of, b_of = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    group = np.cumsum(both) - both
    link_end = np.searchsorted(at, a_at[docs_end[0] - 1]) + 1
    owner = np.repeat(np.array(whole), np.diff(link_end, prepend=0))
    pairs = b_ids[b_of].astype(np.uint32) << np.uint32(16) | a_ids[a_of]
    group_end = group[link_end - 1] + 1
    counts[whole] = np.stack([np.diff(e, prepend=0) for e in (*docs_end, group_end, link_end)], 1)

    a_group, b_group = group[ends_a], group[ends_b]
    n_a, n_b = np.bincount(a_group), np.bincount(b_group)
    start = np.cumsum(n_a + n_b) - n_a - n_b
    shown = np.empty(len(a_ids) + len(b_ids), np.int64)
    shown[start[a_group] + np.arange(len(a_ids)) - (np.cumsum(n_a) - n_a)[a_group]] = a_ids
    shown[(start + n_a)[b_group] + np.arange(len(b_ids)) - (np.cumsum(n_b) - n_b)[b_group]] = b_ids
    shown[start + n_a - 1] += 1 << 16
    shown[start + n_a + n_b - 1] += 2 << 16
    token_end = docs_end[0] + docs_end[1]
    shown[token_end - 1] += 1 << 16
    text = numerals()[shown]
    groups = [""] * len(texts)
    for k, a, b in zip(whole, [0, *token_end[:-1].tolist()], token_end.tolist()):
        groups[k] = "".join(text[a:b].tolist())
    return Aligned(counts, groups, pairs, owner)


def spilled(block: Aligned) -> Iterator[tuple[int, bytes, bytes]]:
    """The runs of a block: partition, pairs with their totals, and records."""
    side = block.pairs.astype(np.int64)
    # By partition of the B id, then B id, A id, document.
    order = np.sort((side >> 16) % RADIX << 45 | side << 14 | block.owner)
    first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if len(order) else np.zeros(0, np.int64)
    links = np.diff(np.append(first, len(order)))
    records = order[first]
    cuts = np.searchsorted(records, np.arange(RADIX + 1) << 45)
    for radix, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            pairs = (records[a:b] >> 14 & 0x7FFFFFFF).astype(np.uint32)
            begins = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            held = np.diff(np.append(begins, b - a))
            yield (radix, run_of(pairs[begins], np.add.reduceat(links[a:b], begins)),
                   packed(pairs[begins].astype("<u4"), held.astype("<u4"), (records[a:b] & BLOCK_DOCS - 1).astype("<u2"),
                          links[a:b].astype("<u4")))


def blocks(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= most or k + 1 - start == BLOCK_DOCS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def spill(docs: DataFrame, a_path: str, b_path: str, with_groups: bool, block_chars: int) -> DataFrame:
    """One row per document (``place`` in its ``block``, counts, groups) and one per run (``block``, ``radix``, blobs)."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"]
    rest = [StructField("block", LongType()), StructField("place", IntegerType()),
            *[StructField(c, LongType()) for c in COUNTS], StructField("groups_sha256", StringType()),
            StructField("groups", StringType()), StructField("radix", IntegerType()), StructField("pairs", BinaryType()),
            StructField("records", BinaryType())]
    schema = StructType([StructField("doc_id", kind.dataType), *rest])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            none = lambda n, t: pa.nulls(n, t)
            for a, b in blocks(texts, block_chars):
                found, n = aligned(texts[a:b], a_path, b_path), b - a
                groups = pa.array(found.groups if with_groups else [None] * n, pa.string())
                digests = [g and hashlib.sha256(g.encode()).hexdigest() for g in found.groups]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, n), pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     *[pa.array(c) for c in found.counts.T], pa.array(digests, pa.string()), groups,
                     none(n, pa.int32()), none(n, pa.binary()), none(n, pa.binary())], names)
                runs = list(spilled(found))
                if runs:
                    radix, pairs, records = zip(*runs)
                    n = len(runs)
                    yield pa.RecordBatch.from_arrays(
                        [none(n, ids.type), pa.array([number] * n, pa.int64()), none(n, pa.int32()),
                         *[none(n, pa.int64())] * len(COUNTS), none(n, pa.string()), none(n, pa.string()),
                         pa.array(radix, pa.int32()), pa.array(pairs, pa.binary()), pa.array(records, pa.binary())], names)
                number += 1

    return docs.mapInArrow(run, schema)


def grouped(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[bool, dict]]:
    """Rows in order, each with whether it is the first with its values of ``names``."""
    last = None
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            for row in batch.slice(at, 16).to_pylist():
                key = tuple(row[n] for n in names)
                yield key != last, row
                last = key


def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run from all runs of each (radix, block)."""
    held, key = [], None

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"radix": key[0], "block": key[1], "pairs": merged_run(held)}], pa.schema(
            [("radix", pa.int32()), ("block", pa.int64()), ("pairs", pa.binary())]))

    for first, row in grouped(batches, "radix", "block"):
        if first:
            if held:
                yield result()
            held, key = [], (row["radix"], row["block"])
        held.append(row["pairs"])
    if held:
        yield result()


def counted(runs: DataFrame, count: int, fan_in: int) -> DataFrame:
    """(radix, ``pairs``): one run of all pairs and their counts for each partition, from the runs of ``count`` blocks."""
    runs = runs.select("radix", "block", "pairs")
    while True:
        count = -(-count // fan_in)
        runs = runs.withColumn("block", F.pmod(F.xxhash64("block", F.lit(count)), F.lit(count)).cast("long"))
        runs = written(runs.repartition("radix", "block").sortWithinPartitions("radix", "block").mapInArrow(
            merge_runs, "radix int, block long, pairs binary"), "merged")
        if count <= 1:
            return runs.select("radix", "pairs")


def contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each run of records gives its documents, by the counts that come before it."""
    pairs = totals = best = None
    for first, row in grouped(batches, "radix", "part"):
        if first:
            assert row["records"] is None
            parts = list(frames(row["pairs"]))
            pairs, totals = (np.concatenate(p) for p in zip(*parts))
            best = best_of_each(pairs, totals)
            continue
        mine, held, place, links = unpacked(row["records"])
        at = np.repeat(np.searchsorted(pairs, mine), held)
        order = np.argsort(place, kind="stable")
        place, at, links = place[order], at[order], links[order].astype(np.int64)
        begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        gain = packed(place[begins], np.add.reduceat(links * best[at], begins).astype("<u4"),
                      np.add.reduceat(links * totals[at].astype(np.int64), begins).astype("<i8"))
        yield pa.RecordBatch.from_pylist([{"block": row["block"], "gain": gain}],
                                         pa.schema([("block", pa.int64()), ("gain", pa.binary())]))


def settled(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The documents of each block with the sums of the gains that come before them."""
    last, sums = None, None
    for batch in batches:
        whose, gains = batch.column("block").to_pylist(), batch.column("gain")
        told = batch.column("gain").is_valid().to_pylist()
        best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        places = batch.column("place").to_pylist()
        for k, block in enumerate(whose):
            if block != last:
                last, sums = block, np.zeros((2, BLOCK_DOCS), np.int64)
            if told[k]:
                place, more, count = unpacked(gains[k].as_py())
                sums[0, place] += more
                sums[1, place] += count
            else:
                best[k], total[k] = sums[:, places[k]]
        batch = batch.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))
        yield batch.filter(pa.array([not t for t in told])).select(names)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, with_groups: bool = True,
          block_chars: int = BLOCK_CHARS, fan_in: int = FAN_IN, part_blocks: int = PART_BLOCKS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if wanted, ``groups``
    (``a1,a2|b1;a3|b2,b3``: the ids of each group; without tokens empty)."""
    paths = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    found = written(spill(docs, *paths, with_groups, block_chars), "spilled")
    runs = found.where("radix IS NOT NULL")
    count = runs.agg(F.count_distinct("block")).first()[0]
    parts = -(-count // part_blocks) or 1
    counts = counted(runs, count, fan_in)

    none = lambda kind: F.lit(None).cast(kind)
    copies = counts.select("radix", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"),
                           "pairs", none("long").alias("block"), none("binary").alias("records"))
    asked = runs.select("radix", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"),
                        none("binary").alias("pairs"), "block", "records")
    gains = copies.unionByName(asked).repartition("radix", "part").sortWithinPartitions("radix", "part", "kind").mapInArrow(
        contributions, "block long, gain binary")

    mine = found.where("radix IS NULL").drop("radix", "pairs", "records")
    names = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups]
    rows = mine.withColumn("gain", none("binary")).unionByName(gains.select(
        *[none(f.dataType).alias(f.name) if f.name != "block" else F.col("block") for f in mine.schema], "gain"))
    kinds = {f.name: f for f in rows.schema}
    schema = StructType([kinds.get(n) or StructField(n, LongType()) for n in names])
    return rows.repartition("block").sortWithinPartitions("block", F.col("gain").isNull()).mapInArrow(
        partial(settled, names=names), schema)


def mapping(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, block_chars: int = BLOCK_CHARS,
            fan_in: int = FAN_IN) -> DataFrame:
    """The counted pairs of a corpus: ``b_id``, ``a_id``, ``links`` and whether it is the ``best`` of its B id."""
    paths = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    runs = written(spill(docs, *paths, False, block_chars).where("radix IS NOT NULL").select("radix", "block", "pairs"), "spilled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("pairs"):
                pairs, totals = (np.concatenate(p) for p in zip(*frames(blob.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs >> np.uint32(16), pa.int32()), pa.array(pairs & np.uint32(0xFFFF), pa.int32()),
                     pa.array(totals, pa.int64()), pa.array(best_of_each(pairs, totals))], ["b_id", "a_id", "links", "best"])

    count = runs.agg(F.count_distinct("block")).first()[0]
    return counted(runs, count, fan_in).select("pairs").mapInArrow(run, "b_id int, a_id int, links long, best boolean")
