"""Business rules as native Column expressions."""

from pyspark.sql import Column, functions as F

# ---- Fixed values the results depend on ----------------------------------------------------
EXPECTED_CART_SHARE = 0.1
QUALITY_THRESHOLD = 0.7
HIGH_VALUE_SESSION = 500
LONG_SESSION_MINUTES = 60
HIGH_ACTIVITY_EVENTS = 50
LOW_QUALITY = "LOW_QUALITY_SCORE"
# (segment, spent above, orders above), first match wins
VALUE_SEGMENTS = [("VIP", 1000, 10), ("Premium", 500, 5), ("Regular", 100, 2)]
VALUE_SEGMENT_DEFAULT = "New"
EVENT_VALUES = {"page_view": 1, "product_view": 3, "add_to_cart": 10, "purchase": 100}
# (segment, price above), first match wins
PRICE_SEGMENTS = [("premium", 200), ("standard", 50)]
PRICE_SEGMENT_DEFAULT = "budget"
MOBILE_EVENT_NAMES = {
    "product_viewed": "product_view",
    "product_added": "add_to_cart",
    "purchase_completed": "purchase",
}
# ---------------------------------------------------------------------------------------------


def number(properties: Column, key: str, kind: str = "double") -> Column:
    """A property as a number; missing or unreadable text gives null, never an error."""
    return properties[key].try_cast(kind)


def event_revenue(event_type: Column, properties: Column, price: Column,
                  literal_nulls: bool = False) -> Column:
    """Revenue of a purchase, expected revenue of a cart addition, else 0.

    With ``literal_nulls`` a null price makes the whole value null, as a function taking a
    primitive price would.
    """
    purchase = F.coalesce(number(properties, "total_amount"), F.lit(0.0))
    cart = (F.coalesce(number(properties, "quantity", "int"), F.lit(1))
            * F.coalesce(price, F.lit(0.0)) * F.lit(EXPECTED_CART_SHARE))
    revenue = (F.when(event_type == "purchase", purchase)
               .when(event_type == "add_to_cart", cart)
               .otherwise(F.lit(0.0)))
    return F.when(price.isNotNull(), revenue) if literal_nulls else revenue


def customer_value_segment(spent: Column, orders: Column, literal_nulls: bool = False) -> Column:
    chain = F
    for name, spent_above, orders_above in VALUE_SEGMENTS:
        chain = chain.when((spent > spent_above) & (orders > orders_above), F.lit(name))
    segment = chain.otherwise(F.lit(VALUE_SEGMENT_DEFAULT))
    if literal_nulls:
        return F.when(spent.isNotNull() & orders.isNotNull(), segment)
    return segment


def _blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def _no_entries(value: Column) -> Column:
    return value.isNull() | (F.size(value) == 0)


def quality_score(event_id: Column, user_id: Column, properties: Column, metadata: Column) -> Column:
    """1.0 less a penalty per missing part, subtracted in this order, not below 0."""
    score = F.lit(1.0)
    for missing, penalty in ((_blank(event_id), 0.3), (_blank(user_id), 0.3),
                             (_no_entries(properties), 0.2), (_no_entries(metadata), 0.2)):
        score = score - F.when(missing, F.lit(penalty)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), score)


def event_value(event_type: Column) -> Column:
    chain = F
    for name, value in EVENT_VALUES.items():
        chain = chain.when(event_type == name, F.lit(value))
    return chain.otherwise(F.lit(0))


def price_segment(price: Column) -> Column:
    chain = F
    for name, above in PRICE_SEGMENTS:
        chain = chain.when(price > above, F.lit(name))
    return chain.otherwise(F.lit(PRICE_SEGMENT_DEFAULT))


def behavior_score(events: Column, sessions: Column, types: Column, revenue: Column) -> Column:
    """Mean of four scores of at most 10 points each."""
    ten = F.lit(10.0)
    activity = F.least(events / F.lit(10.0), ten)
    diversity = F.least(types * F.lit(2.0), ten)
    money = F.least(F.coalesce(revenue, F.lit(0.0)) / F.lit(100.0), ten)
    visits = F.least(sessions * F.lit(5.0), ten)
    return (activity + diversity + money + visits) / F.lit(4.0)


def needs_alert(abandoned: Column, revenue: Column, minutes: Column) -> Column:
    return abandoned | (revenue > HIGH_VALUE_SESSION) | (minutes > LONG_SESSION_MINUTES)


def alert_type(abandoned: Column, revenue: Column, minutes: Column) -> Column:
    """One alert per session; the first rule that holds names it."""
    return (F.when(abandoned, "CART_ABANDONMENT")
            .when(revenue > HIGH_VALUE_SESSION, "HIGH_VALUE_SESSION")
            .when(minutes > LONG_SESSION_MINUTES, "LONG_SESSION"))


def hour_session_id(user_id: Column, ts: Column) -> Column:
    return F.concat(user_id, F.lit("_"), F.date_format(ts, "yyyyMMddHH"))


def mobile_event_type(event_name: Column) -> Column:
    chain = F
    for name, canonical in MOBILE_EVENT_NAMES.items():
        chain = chain.when(event_name == name, F.lit(canonical))
    return chain.otherwise(event_name)
