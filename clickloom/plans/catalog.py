"""Registry of the named queries and their reference SQL, and the shared inputs of both."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from clickloom.operators import enrich
from clickloom.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The processing time of the registered queries; the events cover January 2024.
AS_OF = "2024-01-31 00:00:00"


def as_of(text: str = AS_OF):
    return F.lit(text).cast("timestamp")


def comparable(df: DataFrame) -> DataFrame:
    """Times without zone, whole numbers as bigint, arrays as joined text: the same column
    types on both sides of the check."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.concat_ws(",", c)
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def events(spark, sf_dir, types=()):
    return tables.canonical_events(spark, sf_dir, types)


def priced_events(spark, sf_dir):
    """Events with segment, revenue and score."""
    return enrich.with_segment_and_revenue(
        events(spark, sf_dir), tables.profiles(spark, sf_dir, totals=False, places=False),
        tables.products(spark, sf_dir))


def enriched_events(spark, sf_dir):
    return enrich.enrich(events(spark, sf_dir), tables.profiles(spark, sf_dir),
                         tables.products(spark, sf_dir), as_of())


# ---- SQL side --------------------------------------------------------------------------------

def slot_sql(ts: str, width: int) -> str:
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {width * 1_000_000})"


def money_sql(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,4))) AS DOUBLE)"


def ratio_sql(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"


EV = r"""
raw AS (SELECT event_id AS n, ts, CAST(user_id AS VARCHAR) AS u, user_id AS user_no, event_type AS t,
               value AS v, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k FROM events),
ev AS (SELECT CAST(n AS VARCHAR) AS event_id, n, k, v, user_no,
  CASE WHEN t = 'view' THEN 'page_view'
       WHEN t = 'click' AND k % 3 = 0 THEN 'product_view'
       WHEN t = 'click' AND k % 3 = 1 THEN 'add_to_cart'
       WHEN t = 'click' THEN 'remove_from_cart'
       WHEN t = 'signup' THEN 'user_login' ELSE t END AS event_type,
  ts AS "timestamp", u AS user_id, u || '_' || strftime(ts, '%Y%m%d') AS session_id,
  CASE n % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'synthetic' END AS source,
  k % 20 = 0 AS no_properties, k % 10 = 0 AS no_metadata,
  CASE WHEN t = 'click' AND k % 20 <> 0 THEN CAST(k + 100 * (n % 20) AS VARCHAR) END AS product_id,
  CASE WHEN t = 'click' AND k % 20 <> 0 AND k % 3 <> 2 THEN v END AS property_price,
  CASE WHEN t = 'click' AND k % 20 <> 0 THEN 1 + k % 3 END AS quantity,
  CASE WHEN t = 'purchase' AND k % 20 <> 0 THEN v END AS total_amount,
  ts + to_microseconds(((n * 37 + k * 13) % 3000) * 1000) AS kafka_timestamp
  FROM raw)"""

PROFILE = """
profile AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, n_name AS location,
  c_mktsegment AS customer_segment, total_orders, total_spent
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, count(*) AS total_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / 1000 AS total_spent
             FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey
  WHERE c_custkey % 10 <> 0)"""

SEGMENT_SQL = """CASE WHEN total_spent > 1000 AND total_orders > 10 THEN 'VIP'
       WHEN total_spent > 500 AND total_orders > 5 THEN 'Premium'
       WHEN total_spent > 100 AND total_orders > 2 THEN 'Regular' ELSE 'New' END"""

ENR = EV + "," + PROFILE + f""",
enr AS (SELECT e.*, p.customer_segment, p.location, p.total_orders, p.total_spent,
  CAST(d.p_partkey AS VARCHAR) AS known_product, d.p_type AS category, d.p_brand AS brand, d.p_retailprice AS price,
  CASE e.event_type WHEN 'purchase' THEN coalesce(e.total_amount, 0)
       WHEN 'add_to_cart' THEN coalesce(e.quantity, 1) * coalesce(d.p_retailprice, 0) * CAST(0.1 AS DOUBLE)
       ELSE CAST(0 AS DOUBLE) END AS event_revenue,
  {SEGMENT_SQL} AS customer_value_segment,
  CAST(1 AS DOUBLE) - CAST(CASE WHEN no_properties THEN 0.2 ELSE 0 END AS DOUBLE)
    - CAST(CASE WHEN no_metadata THEN 0.2 ELSE 0 END AS DOUBLE) AS data_quality_score
  FROM ev e LEFT JOIN profile p ON p.user_id = e.user_id
  LEFT JOIN part d ON CAST(d.p_partkey AS VARCHAR) = e.product_id)"""

REVENUE = EV + """,
rev AS (SELECT *, CASE event_type WHEN 'purchase' THEN coalesce(total_amount, 0) ELSE CAST(0 AS DOUBLE) END
  AS event_revenue FROM ev)"""


def sessions_sql(gap_seconds: int) -> str:
    """CTEs on top of ``enr`` that end in ``sessions``."""
    return f""",
gaps AS (SELECT *, CASE WHEN epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w) <= {gap_seconds * 1_000_000}
           THEN 0 ELSE 1 END AS opens FROM enr
         WINDOW w AS (PARTITION BY session_id, user_id ORDER BY "timestamp")),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY session_id, user_id ORDER BY "timestamp"
               ROWS UNBOUNDED PRECEDING) AS run FROM gaps),
merged AS (SELECT session_id, user_id, run, min("timestamp") AS session_start, max("timestamp") AS session_end,
  count(*) AS total_events, count(DISTINCT event_type) AS unique_event_types,
  {money_sql('event_revenue')} AS session_revenue,
  arg_min(struct_pack(s := customer_segment, o := source), "timestamp") AS first_row,
  bool_or(event_type = 'purchase') AS has_purchase,
  bool_or(event_type IN ('add_to_cart', 'remove_from_cart')) AS has_cart_activity
  FROM numbered GROUP BY session_id, user_id, run),
sessions AS (SELECT session_id, user_id, session_start, session_end, total_events, unique_event_types,
  session_revenue, first_row.s AS customer_segment, first_row.o AS source, has_purchase, has_cart_activity,
  CAST(epoch_us(session_end) // 1000000 - epoch_us(session_start) // 1000000 AS DOUBLE) / 60
    AS session_duration_minutes,
  has_cart_activity AND NOT has_purchase AS abandoned_cart,
  CAST(CASE WHEN has_cart_activity THEN CASE WHEN has_purchase THEN 1 ELSE 0 END END AS DOUBLE)
    AS conversion_rate FROM merged)"""
