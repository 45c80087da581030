"""Number rules: fixed-scale money, whole years, rounding and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from saldo.functions.text import plain_number

MONEY = "decimal(38,8)"
REPORT_MONEY = "decimal(18,2)"


def money(value: Column | str) -> Column:
    """Fixed scale of 8, half-even; unreadable or over 20 whole digits is NULL."""
    column = F.col(value) if isinstance(value, str) else value
    return F.bround(column.try_cast("decimal(38,18)"), 8).cast(MONEY)


def whole_number(value: Column | str) -> Column:
    """Integer cut toward zero; unreadable values and NULL are 0."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(plain_number(column).try_cast("int"), F.lit(0))


def as_amount(value: Column | str) -> Column:
    """Report amount; unreadable values and NULL are 0."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.try_cast(MONEY), F.lit(0).cast(MONEY))


def times_count(amount: Column, count: Column, scale: int = 8) -> Column:
    """``amount * count`` without losing decimal places.

    A product of two wide decimals drops to six places, so both sides are
    narrowed first; a value that does not fit raises instead of rounding.
    """
    return (amount.cast(f"decimal(27,{scale})") * count.cast("decimal(10,0)")).cast(
        f"decimal(38,{scale})"
    )


def half_up(value: Column) -> Column:
    """Nearest whole number with halves going up, also for negative values."""
    return F.floor(value + F.lit(0.5).cast("decimal(2,1)")).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double; NULL where the whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100


def change_percent(old: Column, new: Column) -> Column:
    """Change in percent of the old value; 100 for growth from nothing, else 0."""
    grown = (new.cast("double") - old.cast("double")) / old.cast("double") * 100
    return F.when(old > 0, grown).when(new > 0, F.lit(100.0)).otherwise(F.lit(0.0))
