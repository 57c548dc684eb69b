"""Date columns. "Today" is always an as-of argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def parse_date(col: Column, *formats: str) -> Column:
    """First format that fits, NULL when none does."""
    return F.coalesce(*[F.try_to_date(col, f) for f in formats])


def epoch_millis_to_date(col: Column) -> Column:
    """UTC calendar day of epoch milliseconds, whatever the session zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(col / 86_400_000).cast("int"))


def date_to_epoch_millis(col: Column) -> Column:
    return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000


def stay_days(start: Column, end: Column) -> Column:
    """Length in days counting both ends."""
    return F.datediff(end, start) + 1


def age(birth: Column, as_of, mode: str = "exact") -> Column:
    """Age in years: ``exact`` birthday, ``dayofyear`` or calendar ``boundary``."""
    today = as_date(as_of)
    years = F.year(today) - F.year(birth)
    if mode == "boundary":
        return years
    if mode == "dayofyear":
        return years - F.when(F.dayofyear(birth) > F.dayofyear(today), 1).otherwise(0)
    if mode != "exact":
        raise ValueError(f"unknown age mode {mode!r}")
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return years - F.when(month_day(today) < month_day(birth), 1).otherwise(0)


def clamp_to_year_start(col: Column, year: Column | int) -> Column:
    """The later of the date and 1 January of ``year``."""
    first = F.make_date(F.lit(year) if isinstance(year, int) else year, F.lit(1), F.lit(1))
    return F.greatest(col, first)


def day_range(start: Column, end: Column) -> Column:
    """All days from start to end; an empty array when end precedes start."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
