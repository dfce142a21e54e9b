"""Cart value after every event of a user.

A cart holds products, each with a number of units and one price: that of its latest addition. A removal carries no price
of its own; it takes units of the product away, never more than are there. A purchase empties the cart. Without a product
id the event is about one nameless product; a missing quantity is 1, a missing price keeps the product's (0 at first).
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import business as rules
from clickloom.functions.numeric import money
from clickloom.operators.ordered import Running, apart, ranged, running, within

CART_TYPES = ("add_to_cart", "remove_from_cart", "purchase")


def cart_columns() -> dict[str, Column]:
    """``_product``, the signed ``_units`` of a cart event and, on additions, the ``_price``."""
    p, kind = F.col("properties"), F.col("event_type")
    units = F.coalesce(rules.number(p, "quantity", "int"), F.lit(1)).cast("long")
    return {"_product": p["product_id"],
            "_units": F.when(kind == "add_to_cart", units).when(kind == "remove_from_cart", -units).otherwise(F.lit(0)),
            "_price": F.when(kind == "add_to_cart", money(rules.number(p, "price")))}


def cart_totals(events: DataFrame, keys: list[str] | None = None, ts: str = "timestamp",
                tie: str = "event_id", columns: list[str] | None = None) -> DataFrame:
    """Value of the cart after each cart event and purchase, with ``columns`` of the events, or all of them.

    A cart lies between two purchases. Within it the units of a product are their running sum less what removals took
    too much, the lowest value the sum has had below 0, and the price is the last one given. An event changes the total by
    the product's worth after it less that before it.
    """
    keys, order = keys or ["user_id"], [ts, tie]
    names = columns or events.columns
    rows = events.where(F.col("event_type").isin(*CART_TYPES)).withColumns(cart_columns())
    # Only what is asked for is moved and stored.
    needed = dict.fromkeys([*names, *keys, *order, "event_type", *cart_columns()])
    large, others = apart(rows.select(*[F.col(f"`{c}`") for c in needed]), keys)
    # Users whose events are a small part of a task are moved once.
    totals = _totals(others, names, keys, order, lambda rows, by: rows, within)
    return totals if large is None else totals.unionByName(_totals(large, names, keys, order, lambda rows, by: ranged(rows, by, order), running))


def _totals(rows: DataFrame, names: list[str], keys: list[str], order: list[str], dealt: Callable, running: Callable) -> DataFrame:
    """The totals by ``running``, which takes rows that were ``dealt`` by the same keys."""
    bought = (F.col("event_type") == "purchase").cast("int")
    rows = running(dealt(rows, keys), keys, order, _cart=Running("sum", bought))

    held = [*keys, "_cart", "_product"]
    price, total = F.col("_price"), F.col("_sum")
    items = running(dealt(rows, held), held, order, _sum=Running("sum", F.col("_units")),
                    _known=Running("last", price), _known_before=Running("last", price, before=True))
    items = running(items, held, order, _low=Running("min", total), _low_before=Running("min", total, before=True))
    zero = F.lit(0).cast("decimal(18,4)")

    def worth(units: Column, low: str, known: str) -> Column:
        held_units = units - F.least(F.col(low), F.lit(0))
        return (held_units.cast("decimal(19,0)") * F.coalesce(known, zero)).cast("decimal(37,4)")

    change = worth(total, "_low", "_known") - worth(total - F.col("_units"), "_low_before", "_known_before")
    # What the products were worth is settled; only the change of the total is moved on.
    items = items.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, *keys, *order, "_cart"])], change.alias("_change"))
    whole = [*keys, "_cart"]
    totals = running(dealt(items, whole), whole, order, cart_total=Running("sum", F.col("_change")))
    return totals.select(*[F.col(f"`{c}`") for c in names], F.col("cart_total").cast("double").alias("cart_total"))
