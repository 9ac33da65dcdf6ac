"""Date and closed-interval expressions. All intervals include both end days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def overlaps(start_a, end_a, start_b, end_b) -> Column:
    return (_c(start_a) <= _c(end_b)) & (_c(start_b) <= _c(end_a))


def length_days(start, end) -> Column:
    return F.datediff(_c(end), _c(start)) + 1


def day_bin(date, bin_days: int) -> Column:
    """Number of the fixed-width time bin that holds a date."""
    return F.floor(F.unix_date(_c(date)) / bin_days).cast("int")


def date_code(date, program_year) -> tuple[Column, Column]:
    """Compact date code: day of year, and year offset from the program year."""
    date = _c(date)
    return F.dayofyear(date), F.year(date) - _c(program_year)


def date_decode(day_of_year, year_offset, program_year) -> Column:
    """The exact inverse of :func:`date_code`."""
    first = F.make_date(_c(program_year) + _c(year_offset), F.lit(1), F.lit(1))
    return F.date_add(first, _c(day_of_year) - 1)
