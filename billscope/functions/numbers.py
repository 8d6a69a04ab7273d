"""Exact money arithmetic: integer cents in, decimals out, never doubles."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale at which a `x * 1.0 / y` quotient is held before it is rounded for display.
QUOTIENT_SCALE = 7


def quotient(numerator: Column, denominator: Column, places: int) -> Column:
    """numerator / denominator rounded half up to `places`; NULL when the denominator is 0.

    Both sides are BIGINT. Their decimal quotient keeps 18 places, so the one rounding that
    matters is the explicit one. ANSI mode raises on x/0, hence the NULLIF.
    """
    divisor = F.nullif(denominator.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return F.round(numerator.cast("decimal(20,0)") / divisor, places)


def fraction(numerator: Column, denominator: Column, places: int) -> Column:
    """A share such as 0.9944, rounded from a seven-place quotient."""
    return F.round(quotient(numerator, denominator, QUOTIENT_SCALE), places).cast(f"decimal(20,{places})")


def percent(numerator: Column, denominator: Column, places: int) -> Column:
    """A share such as 99.44, rounded from a seven-place quotient."""
    return F.round(quotient(numerator, denominator, QUOTIENT_SCALE) * 100, places).cast(f"decimal(20,{places})")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def any_flag(condition: Column) -> Column:
    """Aggregate: 1 when the condition holds on at least one row of the group."""
    return F.max(flag(condition))


def sum_where(condition: Column, value: Column) -> Column:
    """Aggregate: sum of `value` over rows meeting the condition, 0 when there are none."""
    return F.sum(F.when(condition, value).otherwise(0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))
