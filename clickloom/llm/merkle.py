"""Merkle manifest of a dataset by nested-interval labels: a node carries the interval of leaf ranks that it covers.

A leaf is the digest of one row. Within a group (a language) leaves are ranked by id, and node i of level l covers the
ranks from i * 2 ** l to the next node's, or to the group's end. An ancestor of a leaf is the node whose interval holds
the leaf's rank; the sibling at a level is what the parent's interval holds beside the node's own: an interval before it,
one after it, or none. A proof is the list of these labelled siblings, level by level; the groups' subroots are the
leaves of one more tree.

Scale: ranks are prefix sums over a range-sorted table. Levels come in bands of ``width``: a bucket of at most 2 ** width
neighbouring nodes is one small piece of work, however large its group, and hands one node on to the next band. Paths of
upper bands (a thousandth of the rows, then a millionth) are attached by joins on the bucket and containment.

Defined cases: null fields are ``-``, so they differ from empty ones; a null language is a group of its own, before all
others; null ids come first; rows of equal id are ordered by leaf, and equal rows are interchangeable; a lone leaf is its
group's subroot, a lone subroot the root; an empty table has no rows; a long text is hashed whole; other columns are
ignored whatever their names.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from clickloom.llm.common import written

BAND = 10
# One level of a proof. Without a sibling the interval is empty and the digest null.
STEP = StructType([StructField("lo", LongType()), StructField("hi", LongType()), StructField("left", BooleanType()),
                   StructField("digest", BinaryType())])
ARROW_STEP = pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("left", pa.bool_()), ("digest", pa.binary())])


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """The digest (32 bytes) of the fields, each with its length in bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def group_key(name: Column) -> Column:
    """A text that is never null and sorts as the names do, null first."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit(""))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``lo``, the rank within ``g`` by ``order``, and ``n``, the size of ``g``.

    Rows equal in ``order`` are dealt by a number of their own, so no range must hold all of them.
    """
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "unranked")
    keys = ["g", *order, "row"]
    spread = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row")
                     .withColumn("at", F.monotonically_increasing_id())
                     .withColumn("part", F.shiftright("at", 33)), "ranged")
    counts = spread.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    by_group = Window.partitionBy("g")
    before = F.sum("here").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(counts.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                                   F.sum("here").over(by_group).alias("n")), "starts")
    return spread.join(starts, ["g", "part"]).withColumn("lo", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def digests(values: list[bytes]) -> list[bytes]:
    """The parents of neighbouring nodes: the digest of one or two digests as hexadecimal text."""
    sha, shown = hashlib.sha256, [v.hex().encode() for v in values]
    return [sha(b"".join(shown[i:i + 2])).digest() for i in range(0, len(shown), 2)]


def climb(lows: np.ndarray, n: int, base: int, width: int, values: list[bytes]) -> tuple[list[tuple], bytes]:
    """For a bucket of neighbouring nodes of level ``base``, in order: for each level of the band the sibling's interval,
    side and digest of every node, and the digest of the bucket's one node above."""
    steps, own = [], lows
    for level in range(base, base + width):
        if n - 1 >> level == 0:
            break
        # The ancestor of each node at this level is the one whose interval holds the node's own.
        held = np.searchsorted(own, lows, side="right") - 1
        lo = own[held]
        hi = np.minimum(lo + (1 << level), n)
        above = lo >> level + 1 << level + 1
        end = np.minimum(above + (2 << level), n)
        left = above < lo
        first, last = np.where(left, above, hi), np.where(left, lo, end)
        at = np.searchsorted(own, first)
        steps.append((first, last, left, [values[i] if a < b else None for i, a, b in zip(at, first, last)]))
        own, values = own[::2], digests(values)
    return steps, values[0]


def paths(steps: list[tuple], count: int) -> pa.Array:
    """Lists of steps, one per node."""
    if not steps:
        return pa.array([[]] * count, pa.list_(ARROW_STEP))
    lo, hi, left = (np.stack([s[k] for s in steps], axis=1).ravel() for k in range(3))
    digest = [d for row in zip(*(s[3] for s in steps)) for d in row]
    flat = pa.StructArray.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(left, pa.bool_()),
                                       pa.array(digest, pa.binary())], fields=list(ARROW_STEP))
    return pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * len(steps), pa.int32()), flat)


def band(nodes: DataFrame, base: int, width: int) -> DataFrame:
    """``nodes`` (g, lo, n, digest, ...) of level ``base`` with the ``path`` of each through this band, and on the first
    node of each bucket ``top``, the digest of the bucket's node above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for table in (*batches, None):
            if table is None:
                whole, rest = rest, None
            else:
                table = pa.Table.from_batches([table])
                table = table if rest is None else pa.concat_tables([rest, table])
                cuts = starts(table)
                whole, rest = table.slice(0, cuts[-2]), table.slice(cuts[-2])
            if whole is not None and whole.num_rows:
                yield from climbed(whole.combine_chunks())

    def starts(table: pa.Table) -> list[int]:
        bucket = table.column("lo").to_numpy() >> base + width
        group = table.column("g").combine_chunks().dictionary_encode().indices.to_numpy()
        change = (bucket[1:] != bucket[:-1]) | (group[1:] != group[:-1])
        return [0, *(np.flatnonzero(change) + 1).tolist(), len(bucket)]

    def climbed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cuts = starts(table)
        lows, sizes = table.column("lo").to_numpy(), table.column("n").to_numpy()
        values = table.column("digest").to_pylist()
        found, tops = [], []
        for a, b in zip(cuts, cuts[1:]):
            steps, top = climb(lows[a:b], int(sizes[a]), base, width, values[a:b])
            found.append(paths(steps, b - a))
            tops += [top] + [None] * (b - a - 1)
        table = table.append_column("path", pa.chunked_array(found)).append_column("top", pa.array(tops, pa.binary()))
        yield from table.combine_chunks().to_batches()

    kind = StructType([*nodes.schema.fields, StructField("path", ArrayType(STEP)), StructField("top", BinaryType())])
    return nodes.repartition("g", F.shiftright("lo", base + width)).sortWithinPartitions("g", "lo").mapInArrow(run, kind)


def attached(rows: DataFrame, above: DataFrame, base: int) -> DataFrame:
    """``rows`` with the path of the node of level ``base`` that contains each, joined on the bucket and the interval."""
    node = above.select(F.col("g").alias("above_g"), F.col("lo").alias("above_lo"), F.col("hi").alias("above_hi"),
                        F.col("path").alias("above_path"))
    bucket = F.shiftright("lo", base) == F.shiftright("above_lo", base)
    inside = (F.col("above_lo") <= F.col("lo")) & (F.col("lo") < F.col("above_hi"))
    found = rows.join(node, (F.col("g") == F.col("above_g")) & bucket & inside)
    return found.withColumn("path", F.concat("path", "above_path")).drop(*node.columns)


def tree(nodes: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """From leaves (g, lo, n, digest, ...): the leaves with their whole ``path``, and (g, digest) of each group's root."""
    largest = nodes.agg(F.max("n")).first()[0] or 1
    rows, base, bands = written(band(nodes, 0, width), "band"), width, []
    top = rows
    while True:
        level = top.where("top IS NOT NULL").select("g", "lo", "n", F.col("top").alias("digest"))
        if largest - 1 >> base == 0:
            break
        level = level.withColumn("hi", F.least(F.col("lo") + (1 << base), F.col("n")))
        top = written(band(level, base, width), "band")
        bands.append((top, base))
        base += width
    rows = rows.drop("top", "digest", "n")
    for above, at in bands:
        rows = attached(rows, above, at)
    return rows, level.select("g", "digest")


def proofs(leaves: DataFrame, width: int = BAND) -> DataFrame:
    """From ``leaves`` (g, doc_id, leaf, ...): all their columns, ``subroot``, ``root`` and ``path`` (up to the root)."""
    nodes = ranked(leaves, "doc_id", "leaf").withColumn("digest", F.col("leaf"))
    rows, subroots = tree(nodes, width)
    subroots = written(subroots, "subroots")
    groups = ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), "name")
    upper, root = tree(groups.withColumn("subroot", F.col("digest")), width)
    upper = written(upper.join(root.withColumnRenamed("digest", "root"), "g").select(
        F.col("name").alias("g"), "subroot", "root", F.col("path").alias("upper_path")), "upper")
    return (rows.join(upper, "g").withColumn("path", F.concat("path", "upper_path")).drop("upper_path", "lo", "g"))


def folded(start: Column, path: Column) -> Column:
    """The root (hexadecimal) that a leaf (hexadecimal) leads to over the siblings of ``path``."""
    beside = lambda step, side: F.when(step["left"] == side, hex_text(step["digest"])).otherwise("")
    lone = lambda step: step["digest"].isNull()
    return F.aggregate(path, start, lambda at, step: F.sha2(
        F.when(lone(step), at).otherwise(F.concat(beside(step, True), at, beside(step, False))), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, from the leaf's up, each run from left to right."""
    shown = F.transform(F.filter(path, lambda s: s["digest"].isNotNull()), lambda s: hex_text(s["digest"]))
    return F.sha2(F.array_join(shown, ""), 256)


def manifest(docs: DataFrame, n_chars: Column | None = None, width: int = BAND) -> DataFrame:
    """Per document: doc_id, ``leaf``, ``shown`` (the leaf with ``n_chars`` in place of the stored one, as somebody who
    checks the document finds it), ``subroot``, ``root`` (all 32 bytes) and ``path`` (the labelled siblings)."""
    of = lambda count: leaf(F.col("doc_id"), F.col("source"), F.col("lang"), count, F.col("text"))
    stored = of(F.col("n_chars"))
    return proofs(docs.select(group_key(F.col("lang")).alias("g"), "doc_id", stored.alias("leaf"),
                              (stored if n_chars is None else of(n_chars)).alias("shown")), width)
