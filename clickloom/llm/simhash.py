"""SimHash near-duplicates: pigeonring chains prune candidate pairs before the full Hamming check.

A fingerprint is a ring of eight segments of eight bits. If two fingerprints differ in at most 2 bits, some start on
the ring has a chain whose first l segments differ in at most l * 2 / 8 bits for every l: none in three segments, at
most one in seven, at most two in all eight. The first three segments are equal; of the next four, which hold at most
one difference, one pair is equal, and of the other pair one segment is. These 48 equal bits are the join key (8 starts
x 2 pairs x 2 segments), the rest of the chain is tested next, and the full distance last.

Scale: only distinct fingerprints are joined, so copies cost nothing, and a key holds at most 2 ** 16 of them, however
many documents there are. Links go to ``components``; documents get their class by a join on the fingerprint.

Defined cases: null, empty and wordless texts have fingerprint 0 and are linked like any other; ids may be null
(ignored by the minimum; a component of null ids has a null id) or repeated (one row each); other columns pass through
``keep_one`` whatever their names.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from clickloom.llm.common import annotated, free_name, same_columns, written
from clickloom.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit b is set when over half the hashes of the text's word shingles have it; as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    starts, ends = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), STEP):
        hashes = np.array([digest(body[a:b], SEED) for a, b in zip(starts[at:at + STEP], ends[at:at + STEP])], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    """The documents with all their columns and their fingerprint (signed 64-bit)."""
    return annotated(docs, column, LongType(), lambda texts: pa.array(map(fingerprint, texts), pa.int64()))


def turned(value: Column, start: int) -> Column:
    """The ring read from segment ``start``, which takes the highest bits."""
    if not start:
        return value
    return F.shiftleft(value, 8 * start).bitwiseOR(F.shiftrightunsigned(value, BITS - 8 * start))


def chain_keys(value: Column) -> Column:
    """The 32 join keys of a fingerprint as (start, key)."""
    keys = []
    for start in range(8):
        ring = turned(value, start)
        part = lambda segment, n=1: F.shiftrightunsigned(ring, 8 * (8 - segment - n)).bitwiseAND(
            F.lit((1 << (8 * n)) - 1).cast("long"))
        for k, (pair, single) in enumerate(((3, 5), (3, 6), (5, 3), (5, 4))):
            key = F.lit((4 * start + k) << 48).cast("long").bitwiseOR(F.shiftleft(part(0, 3), 24)).bitwiseOR(
                F.shiftleft(part(pair, 2), 8)).bitwiseOR(part(single))
            keys.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
    return F.array(*keys)


def links(values: DataFrame) -> DataFrame:
    """All pairs (u, v), u < v, of the distinct fingerprints in ``values`` that differ in at most two bits."""
    keyed = values.select("fingerprint", F.inline(chain_keys(F.col("fingerprint"))))
    left, right = keyed.alias("a"), keyed.alias("b")
    differ = F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))
    # Seven segments of the chain: all but the one before its start.
    before = F.expr("shiftleft(255L, 8 * (8 - ((a.start + 7) % 8) - 1))")
    chain = F.bit_count(differ.bitwiseAND(F.bitwise_not(before))) <= 1
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.fingerprint") < F.col("b.fingerprint"))
    return (left.join(right, same & chain & (F.bit_count(differ) <= DISTANCE))
            .select(F.col("a.fingerprint").alias("u"), F.col("b.fingerprint").alias("v")).distinct())


def classes(marked: DataFrame) -> DataFrame:
    """From (doc_id, fingerprint): each distinct ``fingerprint``, its ``root`` (a fingerprint that names the component)
    and ``component_id`` (the component's smallest doc_id)."""
    values = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(written(links(values), "pairs"))
    rooted = values.join(roots, values.fingerprint == roots.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("fingerprint", "root").join(named, "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, ``fingerprint``, ``root`` and ``component_id`` per document."""
    marked = written(fingerprints(docs.select("doc_id", "text")).drop("text"), "fingerprints")
    return marked.join(classes(marked), "fingerprint").select("doc_id", "fingerprint", "root", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the document with the smallest id (one of them, if ids repeat), with all its columns."""
    mark, root, smallest = (free_name(docs, name) for name in ("fingerprint", "root", "component_id"))
    marked = written(fingerprints(docs, mark), "fingerprints")
    found = classes(marked.select("doc_id", F.col(mark).alias("fingerprint"))).toDF(root, "print", smallest)
    found = found.withColumnRenamed("print", mark)
    first = marked.join(found, mark).where(F.col("doc_id").eqNullSafe(F.col(smallest)))
    return same_columns(first.dropDuplicates([root]), docs)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
