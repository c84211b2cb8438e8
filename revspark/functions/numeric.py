"""Exact money arithmetic.

Money is stored as double, but sums and rounding go through decimals so that a
result does not depend on how rows were split into partitions, and so that
half-way cases round away from zero the same way on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,10)"    # money amounts as stored and their sums: below 10^28
AMOUNT = "decimal(22,6)"    # per-deal operands: prices and costs
RATE = "decimal(14,12)"     # per-deal rates; amount x rate is exact within 38 digits
WIDE = "decimal(38,10)"     # intermediate for rounding a double


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: Column | str) -> Column:
    """Exact sum(c), returned as double; NULL when all inputs are NULL.

    Rows are not rounded: sub-cent amounts add up.
    """
    return F.sum(_c(c).try_cast(MONEY)).cast("double")


def round_half_up(c: Column | str, scale: int) -> Column:
    """round(c, scale) with half-way cases away from zero, as double."""
    return F.round(_c(c).try_cast(WIDE), scale).cast("double")


def as_amount(c: Column | str) -> Column:
    """Fixed point; an amount of 10^16 or more cannot be told and is NULL."""
    return _c(c).try_cast(AMOUNT)


def as_rate(c: Column | str) -> Column:
    """Fixed point; a rate of 100 (that is 10,000 percent) or more cannot be told and is NULL."""
    return _c(c).try_cast(RATE)
