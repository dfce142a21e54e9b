"""Adapter: the star-schema tables of a data folder as events, messages and dimensions."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions.numeric import money
from clickloom.schemas import JSON_TIME
from clickloom.session import configure

# Declared, so that no query opens a file only to learn its columns.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}
BROKEN_EVERY = 97
COUNTRIES = ["US", "UK", "CA", "DE", "FR"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def canonical_events(spark: SparkSession, sf_dir: str, types: tuple[str, ...] = (),
                     since: str | None = None, removal_prices: bool = False) -> DataFrame:
    """The ``events`` table as canonical events. ``types`` names the table's own types and
    ``since`` the earliest time to read; both filters reach the scan."""
    rows = table(spark, sf_dir, "events")
    if since:
        rows = rows.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return canonical(rows, types, removal_prices)


def canonical(rows: DataFrame, types: tuple[str, ...] = (), removal_prices: bool = False) -> DataFrame:
    """Canonical events from rows of the ``events`` table, batch or stream. With ``removal_prices`` a removal from the cart
    keeps its price."""
    if types:
        rows = rows.where(F.col("event_type").isin(*types))
    unpriced = "false" if removal_prices else "k % 3 = 2"
    with_k = rows.withColumns({"k": F.expr("cast(get_json_object(props, '$.k') as int)"),
                               "at": F.expr("cast(ts as timestamp)")})
    return with_k.selectExpr(
        "cast(event_id as string) as event_id",
        """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'user_login'
           WHEN 'click' THEN CASE k % 3 WHEN 0 THEN 'product_view' WHEN 1 THEN 'add_to_cart'
                             ELSE 'remove_from_cart' END
           ELSE event_type END AS event_type""",
        "at AS timestamp",
        "cast(user_id as string) AS user_id",
        "concat(cast(user_id as string), '_', date_format(at, 'yyyyMMdd')) AS session_id",
        "CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'synthetic' END AS source",
        f"""CASE WHEN k % 20 = 0 THEN cast(map() as map<string, string>)
           WHEN event_type = 'click' AND {unpriced} THEN map('product_id', cast(k + 100 * (event_id % 20) as string),
             'quantity', cast(1 + k % 3 as string), 'k', cast(k as string))
           WHEN event_type = 'click' THEN map('product_id', cast(k + 100 * (event_id % 20) as string),
             'price', cast(value as string), 'quantity', cast(1 + k % 3 as string), 'k', cast(k as string))
           WHEN event_type = 'purchase' THEN map('total_amount', cast(value as string), 'k', cast(k as string))
           ELSE map('k', cast(k as string)) END AS properties""",
        """CASE WHEN k % 10 = 0 THEN cast(map() as map<string, string>)
           ELSE map('platform', CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'synthetic' END,
             'environment', 'prod') END AS metadata""",
        "timestamp_micros(unix_micros(at) + ((event_id * 37 + k * 13) % 3000) * 1000) AS kafka_timestamp",
        "event_id AS offset",
        "cast(user_id % 24 as int) AS partition",
        "value")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as broker messages; every 97th value is cut short and does not parse."""
    return as_messages(canonical_events(spark, sf_dir))


def as_messages(events: DataFrame) -> DataFrame:
    body = F.to_json(F.struct("event_id", "event_type", "timestamp", "user_id", "session_id",
                              "source", "properties", "metadata"), JSON_TIME)
    broken = F.col("offset") % BROKEN_EVERY == 0
    return events.select(
        F.col("user_id").alias("key"),
        F.when(broken, F.concat(F.lit("{broken "), "event_id")).otherwise(body).alias("value"),
        F.lit("ecommerce-events-raw").alias("topic"),
        "partition", "offset", F.col("kafka_timestamp").alias("timestamp"))


def web_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the batch a web client posts."""
    record = F.struct(F.col("user_id").alias("key"), F.struct(
        "event_id", "event_type", "timestamp", "user_id", "session_id", "source", "properties",
        F.when(F.size("metadata") > 0, F.map_concat("metadata", F.create_map(
            F.lit("sdk_version"), F.lit("1.0.0"),
            F.lit("session_start_time"), F.date_format("timestamp", "yyyy-MM-dd'T'00:00:00'Z'"))))
        .otherwise(F.col("metadata")).alias("metadata")).alias("value"))
    return canonical_events(spark, sf_dir).select(
        F.to_json(F.struct(F.array(record).alias("records")), JSON_TIME).alias("value"))


def mobile_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the batch a mobile client posts, alternating the two spellings."""
    kind = F.col("event_type")
    name = (F.when(kind == "product_view", "product_viewed").when(kind == "add_to_cart", "product_added")
            .when(kind == "purchase", "purchase_completed").otherwise(kind))
    ios = F.col("offset") % 2 == 0
    sent = F.map_concat("properties", F.create_map(
        F.lit("platform"), F.when(ios, "ios").otherwise("android")))
    millis = F.unix_millis("timestamp")
    snake = F.struct(name.alias("event_name"), sent.alias("properties"), millis.alias("timestamp"),
                     "session_id", "user_id")
    camel = F.struct(name.alias("eventName"), sent.alias("properties"), millis.alias("timestamp"),
                     F.col("session_id").alias("sessionId"), F.col("user_id").alias("userId"))
    body = lambda e: F.to_json(F.struct(F.array(e).alias("events"), F.lit("key").alias("api_key"),
                                        F.lit("prod").alias("environment")))
    return canonical_events(spark, sf_dir).select(F.when(ios, body(snake)).otherwise(body(camel)).alias("value"))


def profiles(spark: SparkSession, sf_dir: str, totals: bool = True, places: bool = True) -> DataFrame:
    """Customers as user profiles; every tenth customer has none. ``totals`` adds order sums
    and ``places`` the nation as location."""
    base = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 0)
    columns = [F.col("c_custkey").cast("string").alias("user_id"), F.col("c_name").alias("first_name"),
               F.col("c_mktsegment").alias("customer_segment")]
    if places:
        nations = table(spark, sf_dir, "nation")
        base = base.join(nations, base.c_nationkey == nations.n_nationkey, "left")
        columns.append(F.col("n_name").alias("location"))
    base = base.select(*columns)
    if not totals:
        return base
    sums = (table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("user_id"))
            .agg(F.count("*").alias("total_orders"),
                 (F.sum(money(F.col("o_totalprice"))).cast("double") / 1000).alias("total_spent"),
                 F.max("o_orderdate").cast("timestamp").alias("last_activity")))
    return base.join(sums, "user_id", "left")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"))


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as purchase events; a quantity above 1 is sent as two items of one event."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    half = F.floor(F.col("l_quantity") / 2).cast("int")
    rest = F.col("l_quantity").cast("int") - half
    item = lambda quantity: F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        quantity.alias("quantity"))
    items = F.when(half > 0, F.array(item(half), item(rest))).otherwise(F.array(item(rest)))
    user, ts = F.col("o_custkey").cast("string"), F.col("o_orderdate").cast("timestamp")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
                    .alias("event_id"),
                    F.lit("purchase").alias("event_type"), ts.alias("timestamp"),
                    user.alias("user_id"),
                    F.concat(user, F.lit("_"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
                    F.create_map(F.lit("order_id"), F.col("l_orderkey").cast("string"),
                                 F.lit("items"), F.to_json(items)).alias("properties")))


def cart_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as additions to the customer's cart, every second line partly removed again, every third order bought.
    A removal names its product and quantity alone."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    text, line = lambda c: c.cast("string"), F.col("l_linenumber")
    number = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long"),
                         F.floor("l_extendedprice"))
    at = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + line * 60_000_000
    product = text(F.col("l_partkey") % 50)
    quantity = F.col("l_quantity").cast("long")
    price = text(F.floor(F.col("l_extendedprice") / F.col("l_quantity")))
    names = lambda *keys: F.array(*[F.lit(k) for k in keys])
    priced = F.map_from_arrays(names("product_id", "quantity", "price"), F.array(product, text(quantity), price))
    plain = F.map_from_arrays(names("product_id", "quantity"), F.array(product, text(quantity)))
    taken = F.when(line % 4 == 0, 99).otherwise(F.floor(quantity / 2))
    removed = F.map_from_arrays(names("product_id", "quantity"), F.array(product, text(taken)))
    # A line is one or two types of event, and the rest follows from the type: what nobody asks for is not read.
    kinds = F.when(line % 2 == 0, names("add_to_cart", "remove_from_cart")).otherwise(names("add_to_cart"))
    gone = F.col("event_type") == "remove_from_cart"
    user = text(F.col("o_custkey")).alias("user_id")
    of_lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumn("event_type", F.explode(kinds)).select(
        user, F.concat(number, F.when(gone, "-r").otherwise("-a")).alias("event_id"), "event_type",
        F.timestamp_micros(at + F.when(gone, 90_000_000).otherwise(0)).alias("timestamp"),
        F.when(gone, removed).when(line % 7 != 6, priced).otherwise(plain).alias("properties"))
    bought = orders.where(F.col("o_orderkey") % 3 == 0).select(
        user, text(F.col("o_orderkey")).alias("event_id"), F.lit("purchase").alias("event_type"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("interval 12 hours")).alias("timestamp"),
        F.create_map(F.lit("order_id"), text(F.col("o_orderkey"))).alias("properties"))
    return of_lines.unionByName(bought)


def demo_events(spark: SparkSession, sf_dir: str, removal_prices: bool = False) -> DataFrame:
    return as_demo(canonical_events(spark, sf_dir, removal_prices=removal_prices))


def as_demo(events: DataFrame) -> DataFrame:
    """Events on a clock 1000 times faster, so that a demo window of seconds holds several."""
    start = F.lit("2024-01-01").cast("timestamp")
    number = F.col("offset")
    country = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]),
                           (F.col("user_id").cast("int") % len(COUNTRIES) + 1))
    micros = F.unix_micros("timestamp") - F.unix_micros(start)
    fast = F.unix_micros(start) + ((micros - F.pmod(micros, F.lit(1000))) / 1000).cast("long")
    return events.select(
        F.timestamp_micros(fast).alias("timestamp"), "user_id", "event_type",
        F.col("properties")["product_id"].alias("product_id"),
        F.col("properties")["price"].try_cast("double").alias("price"),
        F.when(number % 3 == 0, "web").when(number % 3 == 1, "mobile").otherwise("tablet").alias("source"),
        country.alias("country"), "event_id")
