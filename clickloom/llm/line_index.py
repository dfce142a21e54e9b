"""Reversible removal of repeated lines: sharded cuckoo filters, backed by exact tables of references.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. A key of at least
``LEAST_CHARS`` code points that at least ``LEAST_DOCS`` documents hold is common: its lines go from every document but
the one with the largest id. The index consists of

* ``refs``: which document holds which key, one row for each key of a text;
* ``counts``: the number of documents and the largest id of each key, kept exact when documents come or go;
* ``filters``: for each shard of the key space a cuckoo filter of its common keys. A key that becomes common is inserted,
  one that ceases to be is deleted, so that lines come back when documents go.

References are first asked against the filter of their shard. Only those it lets through are joined with the exact
counts, which settle them; strangers that a filter lets through change nothing.

Scale: keys are 16-byte digests; references are written where the texts are read. Counts combine on the map side. A shard
holds about ``SHARD_KEYS`` common keys; its references are dealt to as many groups of ``GROUP_ROWS`` as their counted
number asks for, each with a copy of the filter, so that a line of a third of all documents meets nowhere. Texts are
shuffled once, to their own removed keys.

Defined cases: a document is a row: rows of one id count each, and share the decision. A null id is smaller than all
others; if only null ids hold a key, all keep it. Null and empty texts are one empty line. Keys within one text count once.
A long text is split whole in one task. Other columns pass through; an older ``line_dedup`` is replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from clickloom.llm.common import free_name, written
from clickloom.llm.cuckoo import CuckooFilter

LEAST_CHARS, LEAST_DOCS = 20, 3
SHARD_KEYS, GROUP_ROWS = 1 << 16, 1 << 15
STEP = 500
SPACE = b" \t\n\x0b\x0c\r"
COLUMN = "line_dedup"
RESULT = StructType([StructField("n_lines", LongType()), StructField("n_dropped", LongType()),
                     StructField("kept", StringType())])
COMMON = f"docs >= {LEAST_DOCS}"


def key(line: bytes) -> bytes | None:
    """The digest of a line's key; none for a short one."""
    line = line.strip(SPACE).lower()
    if len(line) < LEAST_CHARS or len(line) < 4 * LEAST_CHARS and len(line.decode()) < LEAST_CHARS:
        return None
    return xxhash.xxh3_128_digest(line)


def references(docs: DataFrame) -> DataFrame:
    """doc_id, ``mark`` (a hash of the text) and ``key`` for each key of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                held = [{key(line) for line in (text or "").encode().split(b"\n")} - {None}
                        for text in batch.column("text").to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(held)), [len(h) for h in held]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("mark").take(rows),
                     pa.array([k for h in held for k in h], pa.binary())], ["doc_id", "mark", "key"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return texts.mapInArrow(run, StructType([*texts.schema.fields[:2], StructField("key", BinaryType())]))


def counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))


def shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8")[::2]


def by_group(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows of equal ``names`` within each batch, in order."""
    for batch in batches:
        if batch.num_rows:
            values = list(zip(*(batch.column(n).to_pylist() for n in names)))
            cuts = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
            for a, b in zip(cuts, cuts[1:]):
                yield values[a], batch.slice(a, b - a)


@dataclass
class LineIndex:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int

    @classmethod
    def build(cls, docs: DataFrame) -> "LineIndex":
        refs = written(references(docs), "refs")
        counts = written(counted(refs), "counts")
        shards = -(-counts.where(COMMON).count() // SHARD_KEYS) or 1
        empty = docs.sparkSession.createDataFrame([], "shard int, filter binary")
        return cls(refs, counts, empty, shards)._filtered(counts.where(COMMON).select("key", F.lit(1).alias("change")))

    def insert(self, docs: DataFrame) -> "LineIndex":
        """The index with more documents."""
        new = written(references(docs), "refs")
        return self._changed(self.refs.unionByName(new), counted(new), None)

    def delete(self, ids: DataFrame) -> "LineIndex":
        """The index without the documents whose id is in ``ids`` (doc_id); a null there removes those without an id."""
        gone = ids.select(F.col("doc_id").alias("gone")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("gone"))
        rest = written(self.refs.join(gone, same, "left_anti"), "refs")
        return self._changed(rest, counted(self.refs.join(gone, same, "left_semi")), rest)

    def _changed(self, refs: DataFrame, delta: DataFrame, rest: DataFrame | None) -> "LineIndex":
        """Counts and filters after ``delta`` (key, docs, keeper) was added, or taken out, leaving ``rest``."""
        delta = written(delta, "delta").select("key", F.col("docs").alias("more"), F.col("keeper").alias("other"))
        sign = 1 if rest is None else -1
        both = self.counts.join(delta, "key", "full" if rest is None else "left")
        before, after = F.coalesce("docs", F.lit(0)), F.coalesce("docs", F.lit(0)) + sign * F.coalesce("more", F.lit(0))
        if rest is None:
            both = both.withColumn("now", F.greatest("keeper", "other"))
        else:
            # Where the largest document went, the references left say which one follows.
            lost = delta.join(self.counts, "key").where(F.col("other").eqNullSafe(F.col("keeper"))).select("key")
            both = both.join(counted(rest.join(lost, "key", "left_semi")).select("key", F.col("keeper").alias("next"),
                                                                                F.lit(True).alias("lost")), "key", "left")
            both = both.withColumn("now", F.when(F.col("lost"), F.col("next")).otherwise(F.col("keeper")))
        change = (after >= LEAST_DOCS).cast("int") - (before >= LEAST_DOCS).cast("int")
        moved = written(both.select("key", after.alias("docs"), F.col("now").alias("keeper"), change.alias("change")),
                        "counts")
        kept = LineIndex(refs, moved.drop("change").where("docs > 0"), self.filters, self.shards)
        return kept._filtered(moved.where("change <> 0").select("key", "change"))

    def _filtered(self, changes: DataFrame) -> "LineIndex":
        """The filters after ``changes``: keys that became common (1) or ceased to be (-1). A filter that is full is built
        anew, larger, from the exact counts."""
        none = F.lit(None)
        rows = self.filters.select("shard", F.lit(0).alias("kind"), "filter", none.cast("binary").alias("key"))
        rows = rows.unionByName(changes.select(shard(self.shards), F.when(F.col("change") < 0, 1).otherwise(2).alias("kind"),
                                               none.cast("binary").alias("filter"), "key"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, held, full = None, None, False

            def result() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([last], pa.int32()), pa.array([None if full else held.to_bytes()], pa.binary())],
                    ["shard", "filter"])

            for (at, kind), part in by_group(batches, "shard", "kind"):
                if at != last:
                    if last is not None:
                        yield result()
                    last, held, full = at, CuckooFilter.sized(SHARD_KEYS * 5 // 4), False
                if kind == 0:
                    held = CuckooFilter.from_bytes(part.column("filter")[0].as_py())
                elif kind == 1:
                    held.remove(hashes(part.column("key").to_pylist()))
                elif not full:
                    full = not held.insert(hashes(part.column("key").to_pylist()))
            if last is not None:
                yield result()

        found = written(rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
            run, "shard int, filter binary"), "filters")
        full = found.where("filter IS NULL").select("shard")
        if full.limit(1).count():
            keys = self.counts.where(COMMON).select(shard(self.shards), "key").join(full, "shard")
            found = written(found.where("filter IS NOT NULL").unionByName(
                keys.repartition("shard").sortWithinPartitions("shard").mapInArrow(rebuilt, "shard int, filter binary")),
                "filters")
        return LineIndex(self.refs, self.counts, found, self.shards)

    def suspects(self) -> DataFrame:
        """The references that the filter of their shard lets through."""
        groups = self.counts.where(COMMON).groupBy(shard(self.shards)).agg(
            F.ceil(F.sum("docs") / GROUP_ROWS).cast("int").alias("groups"))
        # One row for every SHARD_KEYS common keys.
        groups = F.broadcast(written(groups, "groups"))
        empty = [F.lit(None).cast(self.refs.schema[c].dataType).alias(c) for c in self.refs.columns]
        copies = self.filters.join(groups, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("kind"), "filter",
            *empty)
        # References to a shard without a common key match no group.
        asked = self.refs.withColumn("shard", shard(self.shards)).join(groups, "shard").select(
            "shard", F.pmod(F.xxhash64("doc_id", "mark"), F.col("groups")).cast("int").alias("part"),
            F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("filter"), *self.refs.columns)
        rows = copies.unionByName(asked).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
        return rows.mapInArrow(partial(let_through, names=self.refs.columns), self.refs.schema)

    def dropped(self) -> DataFrame:
        """doc_id, ``mark`` and the ``keys`` whose lines go, for each text that loses any."""
        common = self.counts.where(COMMON).select("key", "keeper")
        sure = written(self.suspects(), "suspects").join(common, "key").where(
            F.col("keeper").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper"))))
        return sure.groupBy("doc_id", "mark").agg(F.collect_set("key").alias("keys"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``line_dedup``: the number of lines, of dropped ones, and the text left."""
        docs = docs.drop(COLUMN)
        mark, keys, other, same = (free_name(docs, name) for name in ("mark", "keys", "other", "same"))
        gone = written(self.dropped(), "dropped").select(F.col("doc_id").alias(other), F.col("mark").alias(same),
                                                        F.col("keys").alias(keys))
        marked = docs.withColumn(mark, F.xxhash64("text"))
        rows = marked.join(gone, F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(mark) == F.col(same)), "left")
        names = docs.columns
        rows = rows.select(*[F.col(f"`{c}`") for c in names], keys)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, STEP):
                    batch = whole.slice(at, STEP)
                    found = [cut(t, k) for t, k in zip(batch.column("text").to_pylist(), batch.column(keys).to_pylist())]
                    column = pa.array(found, pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                                                        ("kept", pa.string())]))
                    yield batch.select(names).append_column(COLUMN, column)

        return rows.mapInArrow(run, StructType([*docs.schema.fields, StructField(COLUMN, RESULT)]))


def cut(text: str | None, gone: list[bytes] | None) -> dict:
    lines = (text or "").split("\n")
    kept = lines
    if gone:
        gone = set(gone)
        kept = [line for line in lines if key(line.encode()) not in gone]
    return {"n_lines": len(lines), "n_dropped": len(lines) - len(kept), "kept": "\n".join(kept)}


def let_through(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    held = None
    for (_, _, kind), part in by_group(batches, "shard", "part", "kind"):
        if kind == 0:
            held = CuckooFilter.from_bytes(part.column("filter")[0].as_py())
        else:
            yield part.select(names).filter(pa.array(held.contains(hashes(part.column("key").to_pylist()))))


def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter a shard from all its keys, large enough for them."""
    last, keys = None, []

    def result() -> pa.RecordBatch:
        size = len(keys)
        while not (held := CuckooFilter.sized(size)).insert(hashes(keys)):
            size *= 2
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([held.to_bytes()], pa.binary())],
                                          ["shard", "filter"])

    for (at,), part in by_group(batches, "shard"):
        if at != last and last is not None:
            yield result()
            keys = []
        last = at
        keys += part.column("key").to_pylist()
    if last is not None:
        yield result()
