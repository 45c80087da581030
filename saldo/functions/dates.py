"""Date filters written as ranges, so that they reach the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _day(year: int, month: int) -> Column:
    carry, index = divmod(month - 1, 12)
    return F.to_date(F.lit(f"{year + carry:04d}-{index + 1:02d}-01"))


def in_years(date: Column | str, years: list[int], last_month: int = 12) -> Column:
    """Dates of the given years, each up to the end of ``last_month``."""
    column = F.col(date) if isinstance(date, str) else date
    spans = [
        (column >= _day(year, 1)) & (column < _day(year, last_month + 1)) for year in years
    ]
    return reduce(lambda a, b: a | b, spans)
