"""Packing along a space-filling curve: documents that are near on a Hilbert curve share sequences.

A document's token counts are hashed to a few signed sums, a point in a small cube whose Hilbert number is the
document's key. All documents in key order form one stream of tokens, cut every ``length`` tokens, so that only the
last sequence is padded. Places in the stream are prefix sums on three levels: over cells of the curve (at most 2 ** 14
rows), over the keys of a cell, and over the documents of one key, where copies, however many, are dealt to salted
groups. Token ids are written once, as narrow numbers, and shuffled once.

Defined cases: a null or empty text is the closing id alone; null or repeated ids are packed like any other, and rows
equal in all that is read are interchangeable; other columns are ignored; an empty table has no pieces.
"""

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from clickloom.llm.common import written

LENGTH = 4096
CLOSING = 2
DIMENSIONS, BITS = 4, 8
CELL_BITS = 14
SALTS = 128
# Words, and pieces of words, whose ids a worker keeps: the first it meets, which holds the frequent ones.
KEPT = 400_000
# Fixed value: the split pattern of the tokenizer file whose texts can be encoded piece by piece.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same on lower-case Latin 1. Other spaces than ASCII's six, other characters and marks of special tokens are left
# to the library, word by word.
LETTER, DIGIT, SPACE = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x20\x09-\x0d"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^{SPACE}{LETTER}{DIGIT}]+")
LATIN = re.compile("[\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xff]*")
WORD = re.compile(f"[^{SPACE}]+")


class Encoded(dict):
    """The ids of words (as bytes) that this worker has met; the others are encoded when they are first asked for."""

    def __init__(self, tokenizer: Tokenizer, kind: np.dtype):
        self.tokenizer, self.kind, self.pieces = tokenizer, kind, {}
        self.tokenize = tokenizer.model.tokenize
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            shown = piece if piece.isascii() and piece.isalpha() else self.to_bytes(piece)[0][0]
            found = np.array([t.id for t in self.tokenize(shown)], self.kind).tobytes()
            if len(self.pieces) < KEPT:
                self.pieces[piece] = found
        return found

    def __missing__(self, word: str) -> bytes:
        if plain(word):
            found = b"".join(map(self.piece, PIECE.findall(word.lower())))
        else:
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()
        if len(self) < KEPT:
            self[word] = found
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Tokenizer, Encoded | None]:
    """The tokenizer of a file, and the store of words if it splits as ``SPLIT`` does."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path) as file:
        steps = (json.load(file).get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    tokenizer = Tokenizer.from_file(path)
    by_word = steps[0].get("pattern") == {"Regex": SPLIT}
    return tokenizer, Encoded(tokenizer, id_type(tokenizer)) if by_word else None


def id_type(tokenizer: Tokenizer) -> np.dtype:
    """The narrowest unsigned type for all ids of a tokenizer."""
    return np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def signs(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A fixed sign per token id and dimension, from a hash of both."""
    n = np.arange(size * dimensions, dtype=np.uint64) + np.uint64(1)
    n *= np.uint64(0x9E3779B97F4A7C15)
    n = (n ^ (n >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((n >> np.uint64(40)) & np.uint64(1)).astype(np.int8).reshape(size, dimensions) * 2 - 1


def plain(text: str) -> bool:
    """Whether ``PIECE`` on the lower-case text cuts what the tokenizer would."""
    return LATIN.fullmatch(text) is not None and "<|" not in text


def encode(texts: list[str | None], path: str) -> list[np.ndarray]:
    """The ids of each text and the closing id. No piece of ``SPLIT`` crosses white space, so the ids of a text are
    those of its words; words repeat, and a worker keeps the ids of those it has met."""
    tokenizer, known = encoder(path)
    kind = id_type(tokenizer)
    closing = np.array([CLOSING], kind).tobytes()
    out = []
    for text in texts:
        text = text or ""
        if known is None:
            body = np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()
        else:
            body = b"".join(map(known.__getitem__, text.lower().split() if plain(text) else WORD.findall(text)))
        out.append(np.frombuffer(body + closing, kind))
    return out


def point(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The hashed count vector of a document as a point of the cube, independent of the document's length."""
    sums = table[ids].sum(0, dtype=np.int64) / np.sqrt(len(ids))
    return np.clip((sums + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.uint32)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each point (Skilling's transform, on all points at once)."""
    axes = [points[:, i].astype(np.uint32).copy() for i in range(points.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for axis in axes:
            turned = (axis >> np.uint32(bit)) & np.uint32(1) != 0
            swap = np.where(turned, np.uint32(0), (axes[0] ^ axis) & low)
            axes[0] ^= np.where(turned, low, swap)
            if axis is not axes[0]:
                axis ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip = np.zeros(len(points), np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint32(bit)) & np.uint32(1) != 0, np.uint32((1 << bit) - 1), np.uint32(0))
    key = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> np.uint32(bit)) & np.uint32(1)).astype(np.int64)
    return key


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ``curve`` (Hilbert number), ``n`` (ids with the closing one) and ``ids`` (as narrow numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = signs(max(encoder(path)[0].get_vocab_size(), CLOSING + 1))
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids = encode(batch.column("text").to_pylist(), path)
                keys = hilbert(np.array([point(x, table) for x in ids]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.tobytes() for x in ids], pa.binary())], ["doc_id", "curve", "n", "ids"])

    typed = docs.select("doc_id", "text")
    return typed.mapInArrow(
        run, f"doc_id {typed.schema['doc_id'].dataType.simpleString()}, curve long, n long, ids binary")


def placed(tokens: DataFrame) -> DataFrame:
    """The tokenized rows with ``place``, the number of tokens before them in the stream."""
    salted = tokens.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    cell = F.shiftright("curve", DIMENSIONS * BITS - CELL_BITS)
    groups = salted.groupBy("curve", "salt").agg(F.sum("n").alias("total")).withColumn("cell", cell)
    before = lambda window: F.sum("total").over(window.rowsBetween(Window.unboundedPreceding, -1))
    cells = groups.groupBy("cell").agg(F.sum("total").alias("total")).select(
        "cell", F.coalesce(before(Window.orderBy("cell")), F.lit(0)).alias("cell_start"))
    starts = groups.withColumn("start", F.coalesce(before(Window.partitionBy("cell").orderBy("curve", "salt")), F.lit(0)))
    starts = starts.join(cells, "cell").select("curve", "salt", (F.col("cell_start") + F.col("start")).alias("start"))
    within = Window.partitionBy("curve", "salt").orderBy("doc_id", "ids").rowsBetween(Window.unboundedPreceding, -1)
    return salted.join(starts, ["curve", "salt"]).select(
        "doc_id", "n", "ids", (F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("place"))


def cut(rows: DataFrame, path: str, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """The pieces of placed documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked
    for, ``ids`` (little-endian unsigned 32-bit)."""
    kind = id_type(encoder(path)[0])
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                owners, out, bodies = [], [], []
                for i, (body, place) in enumerate(zip(batch.column("ids"), batch.column("place").to_pylist())):
                    ids = np.frombuffer(body.as_buffer(), kind).astype("<u4")
                    start = 0
                    while start < len(ids):
                        sequence, offset = divmod(place + start, length)
                        piece = ids[start:start + length - offset].tobytes()
                        size = len(piece) // 4
                        owners.append(i)
                        out.append((start, size, zlib.crc32(piece), len(ids), sequence, offset))
                        bodies.append(piece if with_ids else None)
                        start += size
                columns = [batch.column("doc_id").take(pa.array(owners, pa.int64()))]
                columns += [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(names))]
                if with_ids:
                    columns.append(pa.array(bodies, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, *(["ids"] if with_ids else [])])

    kinds = [f"doc_id {rows.schema['doc_id'].dataType.simpleString()}", *(f"{n} long" for n in names)]
    return rows.mapInArrow(run, ", ".join(kinds + (["ids binary"] if with_ids else [])))


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """All pieces of all documents, packed into sequences of ``length`` tokens along the curve."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    return cut(placed(written(tokenized(docs, path), "tokens")), path, length, with_ids)
