"""Ordered operators that stay spread out however the rows lie: by group, by time, by nothing.

A window over a whole group sorts that group in one task. Here the rows are range-partitioned by (group, time, id), so a
group that holds half of all rows, all of one minute if need be, lies in many ranges of equal size, and one range may hold
many groups. Inside a range a group is counted by a window; what the group's earlier ranges leave behind comes from one
row per range in which it goes on. The ranges are stored once, since their bounds are drawn from a sample.

Rows of equal group, time and id (copies of one event) lie in one range.

Where all groups are small, ranges only cost disk: ``apart`` parts the rows of the few groups that are much of a task from all
others, which ``within`` counts by plain windows.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.session import brief_shuffles, stored

RANGE = "_range"
# Hashes that groups are first counted by.
HASHES = 1 << 16


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``_range``, the number of the range of (keys, order) that a row lies in."""
    spread = df.drop(RANGE).repartitionByRange(*keys, *order)
    return stored(spread.withColumn(RANGE, F.spark_partition_id()), "ranged")


@dataclass(frozen=True)
class Running:
    """A running ``sum``, ``max``, ``min`` or ``last`` (non-null) value, up to a row or to the one before it."""

    kind: str
    value: Column
    before: bool = False

    def over(self, frame) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(frame)
        return getattr(F, self.kind)(self.value).over(frame)

    def of_range(self, order: list[str]) -> Column:
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), F.struct(*order)))
        return getattr(F, self.kind)(self.value)

    def with_carry(self, here: Column, carry: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0))
        if self.kind == "last":
            return F.coalesce(here, carry)
        # these skip nulls
        return F.greatest(here, carry) if self.kind == "max" else F.least(here, carry)


def running(rows: DataFrame, keys: list[str], order: list[str], **values: Running) -> DataFrame:
    """``rows`` of ``ranged`` with each of ``values`` as a column, running within ``keys`` by ``order``."""
    inside = Window.partitionBy(RANGE, *keys).orderBy(*order)
    frame = {b: inside.rowsBetween(Window.unboundedPreceding, -1 if b else 0) for b in (False, True)}
    by_range = Window.partitionBy(*keys).orderBy(RANGE)
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy(RANGE, *keys).agg(*[v.of_range(order).alias(n) for n, v in values.items()])
    left = lambda n, v: Running(v.kind, F.col(n)).over(earlier).alias(f"_carry_{n}")
    same = lambda n: F.col(n).alias(f"_carry_{n}")
    carry = (pieces.withColumn("_piece", F.row_number().over(by_range))
             .select("_piece", *[same(n) for n in (RANGE, *keys)], *[left(n, v) for n, v in values.items()])
             .where("_piece > 1").drop("_piece"))
    local = rows.withColumns({f"_here_{n}": v.over(frame[v.before]) for n, v in values.items()})
    match = [F.col(n).eqNullSafe(F.col(f"_carry_{n}")) for n in (RANGE, *keys)]
    # At most one group goes on into a range, so there are no more carries than ranges.
    whole = local.join(F.broadcast(carry), reduce(lambda a, b: a & b, match), "left")
    return whole.select(*[F.col(f"`{c}`") for c in rows.columns if c not in values], *[
        v.with_carry(F.col(f"_here_{n}"), F.col(f"_carry_{n}")).alias(n) for n, v in values.items()])


def within(rows: DataFrame, keys: list[str], order: list[str], **values: Running) -> DataFrame:
    """``rows`` with each of ``values`` as ``running`` gives it, for groups that are each a small part of a task. Rows that are
    already dealt by some of ``keys`` are not moved."""
    inside = Window.partitionBy(*keys).orderBy(*order)
    frame = {b: inside.rowsBetween(Window.unboundedPreceding, -1 if b else 0) for b in (False, True)}
    return rows.withColumns({n: v.with_carry(v.over(frame[v.before]), F.lit(None)) for n, v in values.items()})


def apart(rows: DataFrame, keys: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """The rows of groups that are more than half of an even share of a shuffle partition, None if there are none, and the others.

    Groups are counted by hash, which leaves a few numbers a task to move; only hashes with that many rows are counted by
    group. There are at most twice as many large groups as shuffle partitions.
    """
    spark = rows.sparkSession
    hashed, cells = F.pmod(F.xxhash64(*keys), F.lit(HASHES)), [F.col(k).alias(f"_large_{k}") for k in keys]
    with brief_shuffles(spark):
        counts = {r[0]: r[1] for r in rows.groupBy(hashed).count().collect()}
    limit = sum(counts.values()) / (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    full = [h for h, n in counts.items() if n > limit]
    if not full:
        return None, rows
    with brief_shuffles(spark):
        large = rows.where(hashed.isin(full)).groupBy(*cells).count().where(F.col("count") > limit).drop("count")
        found = large.collect()
    if not found:
        return None, rows
    listed = F.broadcast(spark.createDataFrame(found, large.schema))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys])
    return rows.join(listed, same, "left_semi"), rows.join(listed, same, "left_anti")


def number_rows(df: DataFrame, keys: list[str], ts: str = "timestamp", tie: str = "event_id",
                name: str = "session_sequence") -> DataFrame:
    """1-based position of each row in its group by (ts, tie)."""
    order = [ts, tie]
    return running(ranged(df, keys, order), keys, order, **{name: Running("sum", F.lit(1))}).drop(RANGE)


def latest_so_far(df: DataFrame, keys: list[str], value: Column, ts: str = "timestamp",
                  tie: str = "event_id", name: str = "latest") -> DataFrame:
    """Largest non-null ``value`` at or before each row of its group."""
    order = [ts, tie]
    return running(ranged(df, keys, order), keys, order, **{name: Running("max", value)}).drop(RANGE)


def neighbour_pairs(df: DataFrame, keys: list[str], value: str, ts: str = "timestamp",
                    tie: str = "event_id") -> DataFrame:
    """How often ``value`` is followed directly by another value, over all groups.

    Pairs inside a range and pairs across two ranges are counted apart and added, so no row
    has to be joined to its predecessor.
    """
    rows = ranged(df.select(*dict.fromkeys([*keys, value, ts, tie])), keys, [ts, tie])
    step = rows.withColumn("_next", F.lead(F.struct(value)).over(Window.partitionBy(RANGE, *keys).orderBy(ts, tie)))
    at = F.struct(ts, tie)
    inner = (step.where(F.col("_next").isNotNull())
             .groupBy(F.col(value).alias("from_value"), F.col(f"_next.{value}").alias("to_value"))
             .agg(F.count("*").alias("n")))
    edges = rows.groupBy(*keys, RANGE).agg(
        F.min_by(F.struct(value), at).alias("_first"), F.max_by(F.struct(value), at).alias("_last"))
    following = Window.partitionBy(*keys).orderBy(RANGE)
    outer = (edges.withColumn("_to", F.lead("_first").over(following)).where(F.col("_to").isNotNull())
             .groupBy(F.col(f"_last.{value}").alias("from_value"), F.col(f"_to.{value}").alias("to_value"))
             .agg(F.count("*").alias("n")))
    return (inner.unionByName(outer).groupBy("from_value", "to_value")
            .agg(F.sum("n").alias("transitions")))


def chunk_rows(numbered: DataFrame, keys: list[str], columns: list[str], position: str,
               chunk_size: int = 1000) -> DataFrame:
    """Rows of each group as arrays of at most ``chunk_size`` entries in order of ``position``.

    A group up to that size is one row with its whole list; a larger one continues in the rows
    with the next ``chunk`` numbers, so nothing is cut off and no array grows without bound.
    """
    zero_based = F.col(position) - 1
    chunk = ((zero_based - F.pmod(zero_based, F.lit(chunk_size))) / chunk_size).cast("long")
    # by position alone: a map in the row cannot be compared
    by_position = lambda a, b: (a[position] - b[position]).cast("int")
    listed = (numbered.groupBy(*keys, chunk.alias("chunk"))
              .agg(F.array_sort(F.collect_list(F.struct(position, *columns)), by_position).alias("_rows")))
    return listed.select(*keys, "chunk", F.size("_rows").alias("entries"), *[
        F.col(f"_rows.{c}").alias(c) for c in columns])


def sequence_chunks(df: DataFrame, keys: list[str], columns: list[str], ts: str = "timestamp",
                    tie: str = "event_id", chunk_size: int = 1000) -> DataFrame:
    """``chunk_rows`` of each group by (ts, tie)."""
    return chunk_rows(number_rows(df, keys, ts, tie, "_position"), keys, columns, "_position", chunk_size)
