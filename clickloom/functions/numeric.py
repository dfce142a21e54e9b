"""Sums, ratios, bands and time slots."""

from pyspark.sql import Column, functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """``"30 minutes"`` -> 1800."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def money(value: Column) -> Column:
    """A fixed-point copy: sums of it do not depend on the order of the rows. A value that does not fit (too large, not
    a number, infinite) is missing; ``quality.fits_money`` counts those."""
    return value.try_cast("decimal(18,4)")


def money_sum(value: Column) -> Column:
    return F.sum(money(value)).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Null when the denominator is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def _slot_micros(ts: Column, duration: str) -> Column:
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(seconds(duration) * 1_000_000))


def slot(ts: Column, duration: str) -> Column:
    """Number of the epoch-aligned slot of this length that holds ``ts``."""
    return (_slot_micros(ts, duration) / F.lit(seconds(duration) * 1_000_000)).cast("long")


def slot_start(ts: Column, duration: str) -> Column:
    return F.timestamp_micros(_slot_micros(ts, duration))


def band(value: Column, steps: list[tuple[float, str]], default: str) -> Column:
    """Name of the highest step the value reaches, else ``default``; null stays null."""
    chain = F
    for lower, name in sorted(steps, reverse=True):
        chain = chain.when(value >= lower, F.lit(name))
    return F.when(value.isNotNull(), chain.otherwise(F.lit(default)))
