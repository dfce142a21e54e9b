"""Verbatim repeats across documents, found with suffix arrays built by linear grouping (``lyndon``).

Every string of ``length`` bytes holds a smallest k-gram (by hash), its anchor; equal strings have equal anchors at
equal offsets. So strings are dealt to shards by anchor, and one row stands for all strings around one anchor: the
segment from the first of them to the end of the last.

1. Anchors of all texts are counted; those seen once hold no repeat and drop out.
2. Equal segments are one string with a count. Where the segments of an anchor differ, a task sorts the bytes after the
   anchor and, reversed, those before it, each with a suffix array over blocks of bytes, and compares neighbours: the
   string that begins d bytes before the anchor repeats when another segment shares d bytes to the left and the rest to
   the right. An anchor with more than ``most`` different segments goes another exact way: its strings are counted by
   digest.
3. Repeats go back to their documents as ranges; a document's union of ranges is cut out.

Only rows about anchors are shuffled, and each text once. Counting has partial sums, joins are split by Spark where a
key is hot, equal segments are combined before they meet, and an array never holds more than ``most`` segments and one
anchor. Anchor and segment equality is by 64 hash bits each, of different strings.

Defined cases: a null text is empty; texts shorter than ``length`` keep everything; strings never cross documents;
documents are told apart by id and text, so rows equal in both have one result and count as repeats of each other; null
ids are ids; other columns are ignored; an empty table gives no rows. Kept bytes may end inside a character, so they
are binary.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickloom.llm.common import written
from clickloom.llm.lyndon import suffix_array
from clickloom.llm.word_ids import range_hashes, weighted_sums

LENGTH = 200
GRAM = 32
MOST = 50_000
STEP_BYTES = 1 << 20
SHARD_BYTES = 2 << 20
BLOCK = 50


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        more = min(have, width - have)
        out = np.minimum(out[:-more], out[more:])
        have += more
    return out


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For joined texts (``ends`` holds each byte's end of text): anchor, first and last string start that it stands
    for, hash of its k-gram, hash of its segment."""
    n = len(data)
    if n < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = weighted_sums(data)
    place = np.arange(n - gram + 1)
    grams = range_hashes(sums, place, place + gram)
    ranked = (grams >> np.uint64(32) << np.uint64(32)) | place.astype(np.uint64)
    least = (sliding_min(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(place[:n - length + 1] + length <= ends[:n - length + 1])
    if not len(starts):
        return anchors(data[:0], ends[:0], length, gram)
    chosen = least[starts]
    fresh = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    first, last = starts[fresh], starts[np.append(fresh[1:], len(starts)) - 1]
    at = chosen[fresh]
    body = range_hashes(sums, first, last + length)
    # Where the anchor lies in the segment is part of the segment.
    body ^= ((at - first) * (2 * length) + (last - first)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return at, first, last, grams[at], body


def pieces(texts: list[bytes], length: int, limit: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts joined to arrays of about ``limit`` bytes: bytes, end of text of each byte, number of the text of each
    byte, and where in its text the array's part begins. A longer text comes in pieces that share length - 1 bytes."""
    group, size = [], 0

    def flush():
        sizes = np.array([len(b) for _, _, b in group])
        data = np.frombuffer(b"".join(b for _, _, b in group), np.uint8)
        begins = np.cumsum(sizes) - sizes
        return (data, np.repeat(begins + sizes, sizes), np.repeat([i for i, _, _ in group], sizes),
                np.repeat(begins - np.array([at for _, at, _ in group]), sizes))

    for i, body in enumerate(texts):
        at = 0
        while len(body) - at >= length:
            part = body[at:at + limit + length - 1]
            group.append((i, at, part))
            size += len(part)
            if size >= limit:
                yield flush()
                group, size = [], 0
            at += limit
    if group:
        yield flush()


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, print (hash of the text), anchor and segment hashes, ``at`` (place of the anchor), ``low`` and ``high``
    (least and most bytes before the anchor at which its strings begin)."""
    names = ["doc_id", "print", "anchor", "segment", "at", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for data, ends, owner, begin in pieces(texts, length):
                at, first, last, gram_hash, segment = anchors(data, ends, length, gram)
                who = pa.array(owner[at], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(who), batch.column("print").take(who),
                     pa.array(gram_hash.view(np.int64)), pa.array(segment.view(np.int64)),
                     pa.array(at - begin[at]), pa.array((at - last).astype(np.int16)),
                     pa.array((at - first).astype(np.int16))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, print long, anchor long, segment long, at long, low short, high short")


def order_and_shared(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows (bytes) by a suffix array over their blocks, and the bytes that each shares with the one
    before it in that order."""
    m, width = rows.shape
    # Equal-length blocks named by rank keep the order of bytes.
    blocks = np.ascontiguousarray(rows).reshape(m * (width // BLOCK), BLOCK).view(f"S{BLOCK}").ravel()
    ranks = np.unique(blocks, return_inverse=True)[1].ravel()
    suffixes = suffix_array(ranks)
    order = suffixes[suffixes % (width // BLOCK) == 0] // (width // BLOCK)
    sorted_rows = rows[order]
    differ = sorted_rows[1:] != sorted_rows[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), width)
    return order, np.concatenate([[0], shared])


def covers(repeated: np.ndarray, length: int) -> list[int]:
    """Ranges of bytes relative to the anchor (start, end by turns) of strings that begin d bytes before it."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    out: list[int] = []
    for a, b in zip(edge[-2::-2], edge[::-2]):
        low, high = -(int(b) - 1), length - int(a)
        if out and low <= out[-1]:
            out[-1] = high
        else:
            out += [low, high]
    return out


def resolve(bodies: list[bytes], before: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray,
            length: int, gram: int) -> list[list[int]]:
    """Of each segment (``before`` bytes of it lie before the anchor; strings begin ``low`` to ``high`` bytes before
    it): the ranges of strings that another segment has, too, or that its ``count`` repeats."""
    m = len(bodies)
    room = -(-length // BLOCK) * BLOCK
    right, left = np.zeros((m, room), np.uint8), np.zeros((m, room), np.uint8)
    for i, body in enumerate(bodies):
        data = np.frombuffer(body, np.uint8)
        after = data[before[i]:before[i] + length]
        right[i, :len(after)] = after
        left[i, :before[i]] = data[:before[i]][::-1]
    right_order, right_shared = order_and_shared(right)
    left_order, left_shared = order_and_shared(left)
    repeated = np.zeros((m, length - gram + 1), bool)
    right_class, left_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(length - gram + 1):
        here = np.flatnonzero((low <= d) & (d <= high))
        if not len(here):
            continue
        right_class[right_order] = np.cumsum(right_shared < length - d)
        left_class[left_order] = np.cumsum(left_shared < d)
        keys = right_class[here] * (m + 1) + left_class[here]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twin = np.zeros(len(here), bool)
        twin[order[1:][same]] = True
        twin[order[:-1][same]] = True
        repeated[here, d] = twin | (count[here] > 1)
    return [covers(row, length) for row in repeated]


def shard_covers(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, print, at, cover) of the segments that occur once, from rows of ``segments`` with ``body``; whole
    anchors are solved together."""
    names = ["doc_id", "print", "at", "cover"]
    kind = rows.schema["doc_id"].dataType

    def solved(held):
        low, high, count = (np.array([row[c] for row in held], np.int64) for c in ("low", "high", "n"))
        found = resolve([row["body"] for row in held], high, low, high, count, length, gram)
        out = [(row["doc_id"], row["print"], row["at"], cover) for row, cover in zip(held, found)
               if cover and row["n"] == 1]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4,
                                            (to_arrow_type(kind), pa.int64(), pa.int64(), pa.list_(pa.int32())))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if group and row["anchor"] != group[-1]["anchor"]:
                    held += group
                    size += sum(len(r["body"]) for r in group)
                    group = []
                    if size >= SHARD_BYTES:
                        yield solved(held)
                        held, size = [], 0
                # Documents equal in id and text bring a segment more than once.
                if not group or row["segment"] != group[-1]["segment"]:
                    group.append(row)
        if held or group:
            yield solved(held + group)

    return (rows.repartition("anchor").sortWithinPartitions("anchor", "segment")
            .mapInArrow(run, f"doc_id {kind.simpleString()}, print long, at long, cover array<int>"))


def digest_covers(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many segments: every string is counted by its digest, nothing is gathered."""
    starts = F.transform(F.sequence(F.col("low").cast("int"), F.col("high").cast("int")), lambda d: F.struct(
        d.alias("d"), F.md5(F.substr("body", F.col("high").cast("int") - d + 1, F.lit(length))).alias("string")))
    strings = rows.dropDuplicates(["anchor", "segment"]).select("doc_id", "print", "at", "anchor", "n", F.inline(starts))
    often = strings.groupBy("anchor", "string").agg(F.sum("n").alias("all")).where("all > 1").select("anchor", "string")
    return (strings.where("n = 1").join(often, ["anchor", "string"], "left_semi")
            .select("doc_id", "print", "at", F.array(-F.col("d"), length - F.col("d")).alias("cover")))


def with_text(rows: DataFrame, docs: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of documents' ids and prints beside the documents (doc_id, text, print)."""
    r, d = rows.alias("r"), docs.alias("d")
    return d.join(r, (F.col("d.print") == F.col("r.print")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), how)


def printed(docs: DataFrame) -> DataFrame:
    """doc_id, text (not null) and ``print``, a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("print"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(doc_id, print, ranges) from ``printed`` documents: the byte ranges (start, end) that repeat; documents without
    any are left out."""
    found = anchor_rows(docs, length, gram)
    # What is grouped by a join's key is written first, so that the join can split a hot one.
    often = written(found.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "often")
    rows = written(found.join(often, "anchor", "left_semi"), "anchors")
    one = F.min(F.struct("doc_id", "print", "at", "low", "high")).alias("one")
    segments = written(rows.groupBy("anchor", "segment").agg(F.count("*").alias("n"), one)
                       .select("anchor", "segment", "n", "one.*"), "segments")
    copies = segments.where("n > 1").select("anchor", "segment")
    whole = rows.join(copies, ["anchor", "segment"], "left_semi").select(
        "doc_id", "print", (F.col("at") - F.col("high")).alias("start"),
        (F.col("at") - F.col("low") + length).alias("end"))
    kinds = written(segments.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    body = F.substr(F.encode("d.text", "UTF-8"), (F.col("r.at") - F.col("r.high") + 1).cast("int"),
                    (F.col("r.high") - F.col("r.low") + length).cast("int"))
    mixed = with_text(segments.join(kinds, "anchor"), docs).select("r.*", body.alias("body"))
    parts = shard_covers(mixed.where(F.col("kinds") <= most), length, gram).unionByName(
        digest_covers(mixed.where(F.col("kinds") > most), length))
    pairs = F.transform(F.sequence(F.lit(0), F.size("cover") - 1, F.lit(2)), lambda i: F.struct(
        (F.col("at") + F.get("cover", i)).alias("start"), (F.col("at") + F.get("cover", i + 1)).alias("end")))
    single = parts.select("doc_id", "print", F.inline(pairs))
    return written(whole.unionByName(single).groupBy("doc_id", "print").agg(
        F.collect_set(F.struct("start", "end")).alias("ranges")), "ranges")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and ``kept`` (the remaining bytes) per document."""
    named = printed(docs)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                out = []
                for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                    body, kept, end, removed, runs = text.encode(), [], 0, 0, 0
                    for a, b in sorted((r["start"], r["end"]) for r in ranges or ()):
                        if a > end or not runs:
                            kept.append(body[end:a])
                            runs, removed, end = runs + 1, removed + b - a, b
                        elif b > end:
                            removed, end = removed + b - end, b
                    kept.append(body[end:])
                    out.append((len(body), removed, runs, b"".join(kept)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(
                        zip(*out) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names)

    joined = with_text(repeats(named, length, gram, most), named, "left").select("d.doc_id", "d.text", "r.ranges")
    kind = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
