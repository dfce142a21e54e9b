"""Benchmark decontamination: suffix arrays over the training texts, searched with every benchmark window.

Documents stay where they are read. A task cuts its documents into shards of bounded size, sorts the word suffixes of
a shard by their first ``window`` words (a suffix array to the depth that a window needs), and binary-searches each
window of the benchmark in it (all ``window`` words of an item from one place, or a shorter item as a whole; the last
suffixes of an item, shorter than a window, are not searched). Neighbours of the found place share the window, and runs
of such places on one diagonal give the longest verbatim match of at least one window (0 if there is none); its place in
the benchmark is not returned. Suffixes with fewer known words than the shortest window cannot match and are left out. The benchmark goes to the tasks in blocks of at most ``block_bytes``; each further block is one more pass
over the documents, so its size is bounded whatever the benchmark's.

Defined cases: null or wordless texts have no words and no hits; items without words have no windows, items shorter
than a window are one window; equal items and repeated documents are each counted for themselves, items by distinct
id; a null item id counts as the empty text. All columns of the documents pass through; a column that has the name
of the result is replaced. An empty benchmark or table gives no hits or no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from clickloom.llm.common import free_name, same_columns
from clickloom.llm.word_ids import joined, span_hashes, spans

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
RESULT = "contamination"
FIELDS = StructType([
    StructField("n_words", LongType()), StructField("hits", ArrayType(LongType())),
    StructField("items", ArrayType(StringType())), StructField("longest", LongType())])

# Digits, lower-case ASCII letters and every byte of a non-ASCII character.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined lower-case bytes, word starts and ends, and the number of the first word of each text."""
    data, offsets = joined([t.lower() for t in texts], b" ")
    starts, ends = spans(IN_WORD[data])
    return data, starts, ends, np.searchsorted(starts, offsets)


class Searches:
    """One block of benchmark texts as sorted distinct windows, ready for a search in any shard."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        data, starts, ends, first = cut([text for _, text in items])
        hashes, at = np.unique(span_hashes(data, starts, ends), return_index=True)
        self.vocabulary = hashes
        self.words = [data[starts[i]:ends[i]].tobytes() for i in at]
        # A word takes the number of its hash, from 1; two words of one hash would be found by the check of hits.
        ids = np.searchsorted(hashes, span_hashes(data, starts, ends)).astype(np.uint32) + 1
        self.names = [name for name, _ in items]
        rows, lengths, owners, places = [], [], [], []
        for k in range(len(items)):
            words = ids[first[k]:first[k + 1]]
            for j in range(max(1, len(words) - window + 1) if len(words) else 0):
                part = words[j:j + window]
                rows.append(np.pad(part, (0, window - len(part))))
                lengths.append(len(part))
                owners.append(k)
                places.append(j)
        self.size = len(rows)
        if not rows:
            return
        keys, which = np.unique(np.array(rows, np.uint32), axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        self.low = packed(keys)
        self.high = packed(np.where(keys == 0, np.uint32(0xFFFFFFFF), keys))
        self.lengths = (keys != 0).sum(1)
        self.shortest = int(self.lengths.min())
        # The items and places of window w are owners[bounds[w]:bounds[w + 1]].
        self.bounds = np.searchsorted(which.ravel()[order], np.arange(len(keys) + 1))
        self.owners, self.places = np.array(owners)[order], np.array(places)[order]


def packed(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings that sort in the same order."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def suffix_array(ids: np.ndarray, first: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes that begin with ``least`` known words, in order of their first ``depth`` words, and
    these words as sorted keys. Words after an unknown one or the end of the text count as 0."""
    stop = np.union1d(np.flatnonzero(ids == 0), first[1:])
    where = np.flatnonzero(ids)
    known = stop[np.searchsorted(stop, where, side="right")] - where if len(where) else where
    where, known = where[known >= least], known[known >= least]
    step = np.arange(depth)
    rows = np.where(step < known[:, None], ids[np.minimum(where[:, None] + step, len(ids) - 1)], 0)
    keys = packed(rows) if len(where) else np.empty(0, f"S{4 * depth}")
    order = np.argsort(keys, kind="stable")
    return where[order], keys[order]


def expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges low:high, the number of the range and the member, one entry per member."""
    sizes = high - low
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]


def search(tests: Searches, texts: list[bytes]) -> list[tuple[int, list[int], list[str], int]]:
    """Of each text: words, hit word ranges (start, end, ...), names of matching items, longest match in words."""
    data, starts, ends, first = cut(texts)
    counts = np.diff(first)
    out = [(int(n), [], [], 0) for n in counts]
    if not tests.size or not len(starts):
        return out
    hashes = span_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    ids = np.where(tests.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)
    while True:
        places, keys = suffix_array(ids, first, tests.window, tests.shortest)
        low = np.searchsorted(keys, tests.low, side="left")
        high = np.maximum(low, np.searchsorted(keys, tests.high, side="right"))
        window, member = expanded(low, high)
        hit = places[member]
        length = tests.lengths[window]
        mark = np.zeros(len(ids) + 1, np.int64)
        np.add.at(mark, hit, 1)
        np.add.at(mark, hit + length, -1)
        covered = np.append(np.cumsum(mark[:-1]) > 0, False)
        # Equal hashes are not yet equal words.
        wrong = [i for i in np.flatnonzero(covered[:-1])
                 if data[starts[i]:ends[i]].tobytes() != tests.words[ids[i] - 1]]
        if not wrong:
            break
        ids[wrong] = 0
    if not len(hit):
        return out
    which, pair = expanded(tests.bounds[window], tests.bounds[window + 1])
    item, diagonal, place = tests.owners[pair], hit[which] - tests.places[pair], hit[which]
    text = np.searchsorted(first, place, side="right") - 1
    order = np.lexsort((place, diagonal, item, text))
    item, diagonal, place, text, size = item[order], diagonal[order], place[order], text[order], length[which][order]
    fresh = np.ones(len(item), bool)
    fresh[1:] = ((np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(text) != 0) | (np.diff(place) != 1))
    begin = np.flatnonzero(fresh)
    run = np.diff(np.append(begin, len(item))) - 1 + size[begin]
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text[begin], run)
    # A range ends where its text ends, also when the next text goes on with a hit.
    inside = covered.copy()
    left = np.flatnonzero(inside[:-1] & ~np.concatenate([[False], inside[:-2]]) | np.isin(
        np.arange(len(ids)), first[:-1]) & inside[:-1])
    right = np.concatenate([left[1:], [len(ids)]])
    gap = np.flatnonzero(~inside)
    right = np.minimum(right, gap[np.searchsorted(gap, left)])
    owner = np.searchsorted(first, left, side="right") - 1
    for k in np.unique(text):
        base = first[k]
        ranges = [int(x) for a, b in zip(left[owner == k], right[owner == k]) for x in (a - base, b - base)]
        names = sorted({tests.names[i] for i in np.unique(item[text == k])})
        out[k] = (int(counts[k]), ranges, names, int(longest[k]))
    return out


def merged(ranges: list[int], more: list[int]) -> list[int]:
    """The union of two lists of ranges, each start, end, start, end, ..."""
    out: list[int] = []
    for a, b in sorted([*zip(ranges[::2], ranges[1::2]), *zip(more[::2], more[1::2])]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def shards(texts: list[bytes], limit: int = SHARD_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``limit`` bytes together; a longer text is a shard of its own."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of bounded size, read one partition at a time."""
    part, size = [], 0
    for name, text in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").toLocalIterator():
        body = (text or "").encode()
        if part and size + len(body) > block_bytes:
            yield part
            part, size = [], 0
        part.append((name, body))
        size += len(body)
    yield part


def annotate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
             column: str = RESULT) -> DataFrame:
    """The documents with all their columns and ``column``: n_words, hits (start and end word of each hit range
    by turns), items (ids of matching items) and longest (words of the longest verbatim match)."""
    spark = docs.sparkSession
    out = docs.drop(column)
    schema = StructType([*out.schema.fields, StructField(column, FIELDS)])
    for number, block in enumerate(blocks(benchmark, block_bytes)):
        tests = spark.sparkContext.broadcast(Searches(block, window))

        def find(batches, tests=tests, earlier=number > 0):
            for batch in batches:
                texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
                rows = [row for part in shards(texts) for row in search(tests.value, part)]
                if earlier:
                    before = batch.column(column).to_pylist()
                    rows = [(n, merged(b["hits"], hits), sorted({*b["items"], *names}), max(b["longest"], longest))
                            for b, (n, hits, names, longest) in zip(before, rows)]
                    batch = batch.drop_columns([column])
                columns = [pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [[]] * 4,
                    (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64()))]
                yield batch.append_column(column, pa.StructArray.from_arrays(columns, FIELDS.names))

        out = out.mapInArrow(find, schema)
    return out


def n_hit(column: str = RESULT) -> Column:
    """Words of a document inside any hit range."""
    signed = F.transform(F.col(f"{column}.hits"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(column: str = RESULT) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit(column) > 0) & (20 * n_hit(column) >= F.col(f"{column}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    column = free_name(docs, RESULT)
    return same_columns(annotate(docs, benchmark, column=column).where(~contaminated(column)), docs)
