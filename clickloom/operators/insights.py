"""Reports on customers, products and journeys that the dashboards name."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.numeric import money, money_sum, ratio, slot_start
from clickloom.operators.ordered import neighbour_pairs
from clickloom.session import stored


def anomaly_windows(events: DataFrame, every: str = "1 hour", trailing: int = 24,
                    limit: float = 3.0, least: int = 3) -> DataFrame:
    """Hourly counts per type against the mean and deviation of the windows before them.

    Every type has a row for every window between the first and the last event, so a window without events counts as 0
    and can be an anomaly. Types and windows bound the rows, whatever the number of events.
    """
    counts = (events.groupBy("event_type", slot_start(F.col("timestamp"), every).alias("slot_start"))
              .agg(F.count("*").alias("events")))
    span = counts.agg(F.min("slot_start").alias("first"), F.max("slot_start").alias("last"),
                      F.collect_set("event_type").alias("types"))
    slots = F.sequence("first", "last", F.expr(f"interval {every}"))
    grid = (span.where("first IS NOT NULL").select(F.explode("types").alias("event_type"), slots.alias("slots"))
            .select("event_type", F.explode("slots").alias("slot_start")))
    counts = grid.join(counts, ["event_type", "slot_start"], "left").fillna(0, ["events"])
    before = Window.partitionBy("event_type").orderBy("slot_start").rowsBetween(-trailing, -1)
    # Squares of counts pass the range of a long.
    exact = F.col("events").cast("decimal(18,0)")
    n, total = F.count("events").over(before), F.sum("events").over(before)
    squares = F.sum((exact * exact).cast("decimal(38,0)")).over(before)
    # n*sum(x^2) - sum(x)^2 in whole numbers: no rounding before the root
    whole = total.cast("decimal(19,0)")
    apart = (n.cast("decimal(4,0)") * squares).cast("decimal(38,0)") - (whole * whole).cast("decimal(38,0)")
    spread = F.sqrt(apart.cast("double") / (n * (n - 1)))
    scored = counts.withColumns({"_n": n, "_mean": ratio(total, n),
                                 "_spread": F.when(n >= least, spread)})
    z = F.try_divide(F.col("events") - F.col("_mean"), F.col("_spread"))
    return (scored.withColumn("z_score", z)
            .withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)))
            .drop("_n", "_mean", "_spread"))


def revenue_vs_previous(enriched: DataFrame) -> DataFrame:
    """Revenue per day and its change from the day before in the table; one row per day."""
    days = (enriched.groupBy(F.to_date("timestamp").alias("day"))
            .agg(money_sum(F.col("event_revenue")).alias("revenue")))
    before = F.lag("revenue").over(Window.partitionBy(F.lit(1)).orderBy("day"))
    return days.withColumn("previous_revenue", before).withColumn(
        "growth", ratio(F.col("revenue") - F.col("previous_revenue"), F.col("previous_revenue")))


def customer_ltv(enriched: DataFrame) -> DataFrame:
    """Mean revenue per user of each first-purchase month."""
    users = (enriched.where(F.col("event_type") == "purchase").groupBy("user_id")
             .agg(F.min("timestamp").alias("first"), F.sum(money(F.col("event_revenue"))).alias("spent")))
    return (users.groupBy(F.date_format("first", "yyyy-MM").alias("cohort"))
            .agg(F.count("*").alias("users"), F.sum("spent").cast("double").alias("revenue"))
            .withColumn("lifetime_value", ratio(F.col("revenue"), F.col("users"))))


def geo_revenue(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("location").agg(
        F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"),
        money_sum(F.col("event_revenue")).alias("revenue"))


def fifths(df: DataFrame, key: str, scores: dict[str, tuple[str, bool]], width: int = 1024) -> DataFrame:
    """``key``, the scored columns and a score of 1 to 5 for each: the fifth of all rows that
    reach up to the row's whole-number value. ``scores`` is name -> (column, ascending).

    Equal values get equal scores. The running share goes over distinct values, cut into
    ranges of ``width``: one task orders the values of one range, and one row per range is
    ordered as a whole. All columns are scored in one pass as rows of a long table.
    """
    cells = [F.struct(F.lit(name).alias("_name"), (F.col(c) if up else -F.col(c)).cast("long").alias("_v"))
             for name, (c, up) in scores.items()]
    long = df.select(key, F.explode(F.array(*cells)).alias("_c")).select(key, "_c._name", "_c._v")
    ranged = long.groupBy("_name", "_v").agg(F.count("*").alias("_n")).withColumn(
        "_range", ((F.col("_v") - F.pmod(F.col("_v"), F.lit(width))) / width).cast("long"))
    ranges = ranged.groupBy("_name", "_range").agg(F.sum("_n").alias("_in"))
    everything = Window.partitionBy("_name")
    ahead = everything.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = ranges.select("_name", "_range", F.coalesce(F.sum("_in").over(ahead), F.lit(0)).alias("_ahead"),
                          F.sum("_in").over(everything).alias("_all"))
    inside = (Window.partitionBy("_name", "_range").orderBy("_v")
              .rowsBetween(Window.unboundedPreceding, 0))
    upto = ranged.withColumn("_upto", F.sum("_n").over(inside)).join(carry, ["_name", "_range"])
    reached = (F.col("_upto") + F.col("_ahead")) * 5 + F.col("_all") - 1
    score = ((reached - F.pmod(reached, F.col("_all"))) / F.col("_all")).cast("int")
    placed = long.join(upto.select("_name", "_v", score.alias("_score")), ["_name", "_v"], "left")
    of = lambda name, c: F.max(F.when(F.col("_name") == name, F.col(c)))
    return placed.groupBy(key).agg(
        *[(of(n, "_v") if up else -of(n, "_v")).alias(c) for n, (c, up) in scores.items()],
        *[of(n, "_score").alias(n) for n in scores])


def rfm_segments(orders: DataFrame, as_of: Column) -> DataFrame:
    """Recency, frequency and monetary scores of each user from (user_id, timestamp, amount)."""
    users = orders.groupBy("user_id").agg(
        F.date_diff(as_of, F.max("timestamp")).cast("long").alias("recency_days"),
        F.count("*").alias("frequency"),
        F.floor(F.sum(money(F.col("amount")))).cast("long").alias("monetary"))
    scored = fifths(users, "user_id", {"r_score": ("recency_days", False), "f_score": ("frequency", True),
                                       "m_score": ("monetary", True)})
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumn("rfm_segment", F.when(total >= 13, "champion").when(total >= 10, "loyal")
                             .when(total >= 7, "potential").otherwise("at_risk"))


def journey_transitions(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How often one event type directly follows another within a session."""
    pairs = neighbour_pairs(events, keys or ["session_id"], "event_type")
    return pairs.select(F.col("from_value").alias("from_type"), F.col("to_value").alias("to_type"),
                        "transitions")


def retention_cohorts(events: DataFrame) -> DataFrame:
    """Users of each first-seen week that come back, by weeks since."""
    weeks = events.select("user_id", F.date_trunc("week", "timestamp").cast("date").alias("week")).distinct()
    first = F.min("week").over(Window.partitionBy("user_id"))
    placed = weeks.withColumn("cohort_week", first)
    offset = (F.date_diff("week", "cohort_week") / 7).cast("long")
    # one row per user and week is left, so a count of rows is a count of users
    return placed.groupBy("cohort_week", offset.alias("week_offset")).agg(F.count("*").alias("users"))


def churn_flags(events: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Last event of each user and whether it is longer ago than ``days``."""
    seen = events.groupBy("user_id").agg(F.max("timestamp").alias("last_seen"), F.count("*").alias("events"))
    return seen.withColumn("is_churned", F.col("last_seen") < as_of - F.make_dt_interval(days=F.lit(days)))


def product_performance(events: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Views, cart additions, units, revenue and units per view of every product."""
    named = events.where(F.col("event_type").isin("product_view", "add_to_cart")).select(
        F.col("properties")["product_id"].alias("product_id"), "event_type")
    seen = named.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count_if(F.col("event_type") == "product_view").alias("views"),
        F.count_if(F.col("event_type") == "add_to_cart").alias("cart_adds"))
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        F.sum(money(F.col("price") * F.col("quantity"))).cast("double").alias("revenue"))
    joined = products.join(seen, "product_id", "left").join(sold, "product_id", "left")
    return (joined.select("product_id", "category", "price",
                          *[F.coalesce(c, F.lit(0)).alias(c) for c in ("views", "cart_adds", "units")],
                          F.coalesce("revenue", F.lit(0.0)).alias("revenue"))
            .withColumn("units_per_view", ratio(F.col("units"), F.col("views"))))


# What a text can be read as. The bits of several values are merged by "or"; the kind they make together is the lowest one
# that holds them all.
INTEGER, NUMBER, BOOLEAN, TEXT = 1, 2, 4, 8


def value_kind(text: Column) -> Column:
    """The bit of a value's kind; 0 for null."""
    return (F.when(text.isNull(), 0).when(text.rlike(r"^[+-]?\d{1,18}$"), INTEGER)
            .when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), NUMBER)
            .when(F.lower(text).isin("true", "false"), BOOLEAN).otherwise(TEXT))


def kind_name(bits: Column) -> Column:
    """integer < number < text and boolean < text; null is below all."""
    has = lambda bit: bits.bitwiseAND(bit) != 0
    return (F.when(has(TEXT) | has(BOOLEAN) & has(INTEGER | NUMBER), "text").when(has(BOOLEAN), "boolean")
            .when(has(NUMBER), "number").when(has(INTEGER), "integer").otherwise("null"))


def kind_bits(name: Column) -> Column:
    return (F.when(name == "integer", INTEGER).when(name == "number", NUMBER).when(name == "boolean", BOOLEAN)
            .when(name == "text", TEXT).otherwise(0))


def schema_drift(events: DataFrame, baseline: DataFrame, field: str = "properties") -> DataFrame:
    """What differs from the baseline (event_type, key and perhaps ``kind``) on a day: keys it does not list, listed ones
    that are absent, and keys whose values no longer fit their listed kind.

    The events are read once, to one row per day, type and key.
    """
    cells = F.explode_outer(F.map_entries(field)).alias("cell")
    daily = stored(events.select(F.to_date("timestamp").alias("day"), "event_type", cells)
                   .groupBy("day", "event_type", F.col("cell.key").alias("key"))
                   .agg(F.count("*").alias("rows"), F.bit_or(value_kind(F.col("cell.value"))).alias("bits")), "daily-keys")
    keys = daily.where(F.col("key").isNotNull())
    kind = F.col("kind") if "kind" in baseline.columns else F.lit(None).cast("string")
    known = baseline.select("event_type", "key", kind.alias("kind")).distinct()
    found = keys.join(known.withColumn("listed", F.lit(True)), ["event_type", "key"], "left")
    fits = kind_name(F.col("bits").bitwiseOR(kind_bits(F.col("kind")))) == F.col("kind")
    drift = F.when(F.col("listed").isNull(), "new_key").when(~fits, "changed_type")
    present = found.withColumn("drift", drift).where("drift IS NOT NULL").select("day", "event_type", "key", "rows", "drift")
    due = daily.select("day", "event_type").distinct().join(known, "event_type")
    absent = (due.join(keys, ["day", "event_type", "key"], "left_anti")
              .select("day", "event_type", "key", F.lit(0).cast("long").alias("rows"),
                      F.lit("missing_key").alias("drift")))
    return present.unionByName(absent)


def daily_sketches(df: DataFrame, columns: list[str], day: Column) -> DataFrame:
    """One row per day and column, to be merged over any range of days: rows, nulls, smallest and largest text, and
    sketches of the distinct values and, for numeric columns, of the quantiles."""
    numeric = {c for c in columns if df.schema[c].dataType.typeName() in ("double", "float", "long", "integer", "short")}
    aggs = [F.count("*").alias("rows")]
    for c in columns:
        text = F.col(c).cast("string")
        quantiles = F.kll_sketch_agg_double(F.col(c).cast("double")) if c in numeric else F.lit(None).cast("binary")
        aggs += [F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("values"), F.hll_sketch_agg(text).alias("distinct"),
            (F.when(F.count(c) > 0, quantiles) if c in numeric else quantiles).alias("quantiles"),
            F.min(text).alias("min_value"), F.max(text).alias("max_value")).alias(f"_{c}")]
    one = df.groupBy(day.alias("day")).agg(*aggs)
    return one.select("day", "rows", F.inline(F.array(*[f"_{c}" for c in columns])))


def merged_profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """The profile of the days of ``sketches``: rows, null share, estimated distinct values and quantiles, bounds."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("sketch"),
        F.count("quantiles").alias("sketched"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))
    ranks = F.array(*[F.lit(q) for q in quantiles])
    return merged.select(
        "column_name", "rows", (ratio(F.col("rows") - F.col("values"), F.col("rows")) * 100.0).alias("null_percent"),
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(F.col("sketched") > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("quantiles"),
        "min_value", "max_value")


def profile_columns(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """Rows, null share, distinct values, smallest and largest text of each column, in one pass.

    Distinct counts are sketches unless ``exact``.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    aggs = [F.count("*").alias("_rows")]
    for c in columns:
        text = F.col(c).cast("string")
        aggs += [F.count(c).alias(f"_n_{c}"), distinct(F.col(c)).alias(f"_d_{c}"),
                 F.min(text).alias(f"_min_{c}"), F.max(text).alias(f"_max_{c}")]
    one = df.agg(*aggs)
    cells = [F.struct(
        F.lit(c).alias("column_name"), F.col("_rows").alias("rows"),
        (ratio(F.col("_rows") - F.col(f"_n_{c}"), F.col("_rows")) * 100.0).alias("null_percent"),
        F.col(f"_d_{c}").alias("distinct_values"),
        F.col(f"_min_{c}").alias("min_value"), F.col(f"_max_{c}").alias("max_value")) for c in columns]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def ip_number(text: Column) -> Column:
    """An IPv4 address as a whole number; anything else gives null."""
    parts = F.split(text, r"\.")
    octets = [F.get(parts, i).try_cast("int") for i in range(4)]
    valid = F.size(parts) == 4
    for octet in octets:
        valid = valid & octet.between(0, 255)
    number = octets[0].cast("long")
    for octet in octets[1:]:
        number = number * 256 + octet
    return F.when(valid, number)


def address_prefixes(networks: DataFrame) -> DataFrame:
    """Each range (first_ip, last_ip, ...) as the fewest aligned blocks that make it up: ``_bits`` (the size of a block as a
    power of two) and ``_prefix`` (the address without these bits). A range has at most two blocks of a size."""
    first, end = F.col("first_ip"), F.col("last_ip") + 1
    low = lambda bits: F.shiftright(first + F.lit((1 << bits) - 1), bits)
    high = lambda bits: F.shiftright(end, bits)
    blocks = []
    for bits in range(33):
        # Complete blocks of this size that do not lie in a complete one of the next.
        within = low(bits + 1) < high(bits + 1)
        left = F.when(low(bits) < F.when(within, 2 * low(bits + 1)).otherwise(high(bits)), low(bits))
        right = F.when(within, F.when(2 * high(bits + 1) < high(bits), 2 * high(bits + 1))).when(
            low(bits) + 1 < high(bits), low(bits) + 1)
        blocks += [F.struct(F.lit(bits).alias("_bits"), side.alias("_prefix")) for side in (left, right)]
    return networks.select("*", F.inline(F.filter(F.array(*blocks), lambda b: b["_prefix"].isNotNull())))


def locate_ip(events: DataFrame, networks: DataFrame, address: Column, key: str = "event_id") -> DataFrame:
    """Left join of an address with ranges (first_ip, last_ip, ...) as whole numbers; of several ranges the one with the
    longest matching prefix counts, then the first by its columns.

    Ranges become prefixes, and every distinct address asks once for each prefix length in use: an equality join, however
    many ranges lie in one block. Events without an address get numbers of their own, below 0, and match nothing.
    """
    names = [c for c in networks.columns if c not in ("first_ip", "last_ip")]
    listed = stored(address_prefixes(networks).select("_bits", "_prefix", *names), "prefixes")
    # At most 33 numbers.
    lengths = sorted(r[0] for r in listed.select("_bits").distinct().collect())
    nowhere = -F.lit(1) - F.pmod(F.xxhash64(key), F.lit(4096))
    numbered = events.withColumn("_ip", F.coalesce(address, nowhere))
    asked = F.array(*[F.struct(F.lit(b).alias("_bits"), F.shiftright("_ip", b).alias("_prefix")) for b in lengths]).cast(
        "array<struct<_bits:int,_prefix:bigint>>")
    asking = numbered.select("_ip").where("_ip >= 0").distinct().select("_ip", F.inline(asked))
    best = F.min(F.struct("_bits", *names)).alias("_best")
    hits = stored(asking.join(listed, ["_bits", "_prefix"]).groupBy("_ip").agg(best), "located")
    found = numbered.join(hits, "_ip", "left")
    return found.select(*[F.col(f"`{c}`") for c in events.columns], *[F.col(f"_best.`{n}`").alias(n) for n in names])
