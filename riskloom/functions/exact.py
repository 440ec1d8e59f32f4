"""Exact arithmetic on integer cents and microseconds.

Every published number is rounded half away from zero from its exact value;
working in integers keeps the result independent of floating-point error and of
the order in which partial sums were merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(a: Column, b: Column) -> Column:
    """Integer quotient, toward zero."""
    return F.call_function("div", a, b)


def cents(amount: Column | str) -> Column:
    return (_col(amount) * 100).cast("bigint")


def scaled(units: Column, digits: int) -> Column:
    """Integer number of 10^-digits units as a decimal with that scale."""
    step = F.lit("0." + "0" * (digits - 1) + "1").cast(f"decimal({digits + 1},{digits})")
    return (units.cast("decimal(18,0)") * step).cast(f"decimal(18,{digits})")


def mean_cents(total: Column, count: Column) -> Column:
    """total / count in whole cents, half up, for non-negative totals; NULL without rows."""
    return F.when(count > 0, _div(F.lit(2) * total + count, F.lit(2) * count))


def ratio_milli(value: Column, total: Column, count: Column) -> Column:
    """value / (total / count) in thousandths, half up, for positive values;
    NULL without a total. The product of a value and a count passes 64 bits in
    long frames, so it is taken in 38 digits, on every row alike."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.when(total > 0, _div(wide(value) * wide(F.lit(2000) * count) + wide(total), wide(F.lit(2) * total)))


def rate_half_even(hits: Column, total: Column, digits: int) -> Column:
    """hits / total for whole numbers, ties to even, from exact integers; NULL without a total."""
    wide = lambda c: c.cast("decimal(28,0)")
    units, base = (wide(hits) * F.lit(10**digits)).cast("decimal(37,0)"), wide(F.nullif(total, F.lit(0)))
    quotient, rest = _div(units, base), (units % base).cast("decimal(28,0)") * 2
    up = (rest > base) | ((rest == base) & (quotient % 2 == 1))
    return scaled(quotient + F.when(up, F.lit(1)).otherwise(F.lit(0)), digits)


def elapsed_units(micros: Column, unit_micros: int) -> Column:
    """Non-negative microseconds in whole units, half up."""
    return _div(micros + F.lit(unit_micros // 2), F.lit(unit_micros).cast("bigint"))


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a zoned timestamp."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def wall_micros(ts: Column | str) -> Column:
    """Microseconds of a zone-less timestamp since 1970 on its own clock, whatever the session's zone."""
    t = _col(ts)
    days = F.unix_date(t.cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(t) * 60 + F.minute(t)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")


def round_half_even(value: Column) -> Column:
    """Nearest integer, ties to even."""
    return F.bround(value, 0).cast("int")
