"""Column helpers: exact money, percentages and stable hashes."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32
LOW_BITS = 20


HUGE = 1e15
AMOUNT_PARTS = ("units_high", "units_low", "micros", "huge")


def priced(amount: Column) -> Column:
    """True for an amount: neither NULL nor NaN."""
    return amount.isNotNull() & ~F.isnan(amount)


def amount_parts(amount: Column) -> tuple[Column, Column, Column, Column]:
    """Whole units (high and low bits), millionths, and what is too large to be counted so.

    The first three are BIGINTs, summed apart: exact whatever the row order, several times
    faster than a decimal sum, and out of reach of an overflow. Infinite amounts and those of
    ``HUGE`` and more, where a double has no cents left, are summed as doubles. NULL and NaN
    have no parts.
    """
    usual = F.when(F.abs(amount) < F.lit(HUGE), amount)
    units = F.floor(usual).cast("bigint")
    micros = F.rint((usual - units.cast("double")) * F.lit(1e6)).cast("bigint")
    high, low = F.shiftright(units, LOW_BITS), units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    return high, low, micros, F.when(priced(amount) & (F.abs(amount) >= F.lit(HUGE)), amount)


def amount_from_parts(high: Column, low: Column, micros: Column, huge: Column) -> Column:
    """Total amount as DOUBLE from the summed parts; NULL if nothing was summed."""
    units = high.cast("decimal(20,0)") * F.lit(1 << LOW_BITS) + low.cast("decimal(20,0)")
    whole = units.cast("decimal(31,0)") + micros.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    total = whole.cast("double")
    return F.when(huge.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + huge)


def rate_pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded half-even to 4 places; NULL for an empty whole."""
    ratio = F.when(whole != 0, part.cast("double") / whole.cast("double"))
    return F.bround(ratio * F.lit(100.0), 4)


def stable_hash32(key: Column, salt: str = "") -> Column:
    """First 32 bits of md5(salt + key) as BIGINT in [0, 2^32): the same in any engine."""
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def row_hash32(columns: list[str], salt: str = "") -> Column:
    """32-bit hash over whole rows, for tables without an identifier."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(HASH_SPACE))


def is_number(value: Column) -> Column:
    """True for finite values: not NULL, not NaN, not infinite."""
    return F.abs(value) < F.lit(float("inf"))
