"""Cart value per user on a stream, counted in event-time order."""

from collections import namedtuple

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from clickloom.functions.numeric import seconds
from clickloom.operators.carts import CART_TYPES, cart_columns
from clickloom.streaming.ordered import DELAY, IDLE, TimeOrdered, ordered

OUTPUT = "user_id string, event_id string, event_type string, us long, cart_total double"
Total = namedtuple("Total", ("user_id", "event_id", "event_type", "us", "cart_total"))


# Products of a cart that are kept with its total; the others have state of their own.
HELD = 1000
SCALE = 10_000


class CartState(TimeOrdered):
    """A map from product to units and price, and the total; the rules are those of ``operators.carts``. Amounts are counted
    in ten-thousandths."""

    fields = ("event_type", "product", "units", "price")
    memory = {"total": 0, "more": False, "held": {}}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.items = handle.getMapState("items", "who string, product string", "units long, price long")

    def take(self, who, state, event):
        if event.event_type == "purchase":
            self.empty(who, state)
        else:
            product = "" if event.product is None else f"={event.product}"
            name = (repr(who), product)
            near = product in state.held or not state.more and len(state.held) < HELD
            if near:
                units, price = state.held.get(product, (0, None))
            else:
                units, price = self.items.getValue(name) if self.items.containsKey(name) else (0, None)
            after = max(0, units + event.units), price if event.price is None else event.price
            state.total += after[0] * (after[1] or 0) - units * (price or 0)
            if near:
                state.held[product] = after
            else:
                state.more = True
                self.items.updateValue(name, after)
        yield Total(who[0], event.event_id, event.event_type, event.us, state.total / SCALE)

    def empty(self, who, state):
        if state.more:
            for name in [tuple(n) for n in self.items.keys() if n[0] == repr(who)]:
                self.items.removeKey(name)
        state.total, state.more, state.held = 0, False, {}

    def forget(self, who, state):
        self.empty(who, state)
        super().forget(who, state)


def cart_totals(events: DataFrame, delay: str = DELAY, idle: str = IDLE) -> DataFrame:
    """The cart after each event whose second the watermark has passed."""
    price = (F.col("_price") * SCALE).cast("long").alias("price")
    rows = (events.where(F.col("event_type").isin(*CART_TYPES)).withColumns(cart_columns())
            .select("user_id", "event_id", "event_type", "timestamp", F.col("_product").alias("product"),
                    F.col("_units").alias("units"), price))
    found = ordered(rows, ["user_id"], CartState(1000 * seconds(idle), ("user_id",)), OUTPUT, delay)
    return found.withColumn("timestamp", F.timestamp_micros("us")).drop("us")
