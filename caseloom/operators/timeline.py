"""Operators over dated rows: propagation of a first event, interaction tracking, daily occupancy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.dates import as_date
from caseloom.operators.skew import attach_group, skew_join


def first_where(df: DataFrame, keys: Sequence[str], test: Column, by: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Per key, the ``take`` columns of the earliest row that passes the test."""
    return (
        df.filter(test)
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*take), F.struct(*by)).alias("_f"))
        .select(*keys, "_f.*")
    )


def propagate_forward(
    rows: DataFrame,
    firsts: DataFrame,
    key: str,
    when: str,
    first_when: str,
    values: dict[str, str],
) -> DataFrame:
    """Own value if present, else the first event's value when it is not later than the row.

    ``values`` maps a row column to the first-event column that may fill it.
    ``firsts`` has one row per key; rows of a key with very many are spread by ``when``.
    """
    joined = skew_join(rows, firsts, [key], [when])
    reached = F.col(first_when) <= F.col(when)
    for own, first in values.items():
        joined = joined.withColumn(own, F.coalesce(F.col(own), F.when(reached, F.col(first))))
    return joined.withColumn("reached", F.coalesce(reached, F.lit(False))).drop(*values.values())


def track_interactions(df: DataFrame, keys: Sequence[str], kind: str, when: str, kinds: Sequence[str]) -> DataFrame:
    """Flag and count per kind with first and last date, one aggregate for all kinds."""
    aggregates = []
    for k in kinds:
        hit = F.col(kind) == k
        aggregates += [F.bool_or(hit).alias(f"has_{k}"), F.count_if(hit).alias(f"n_{k}")]
    return df.groupBy(*keys).agg(*aggregates, F.min(when).alias("first_date"), F.max(when).alias("last_date"))


def group_total(df: DataFrame, keys: Sequence[str], value: Column, out: str, row_id: Sequence[str]) -> DataFrame:
    """Every row with the total of its group."""
    return attach_group(df, keys, {out: F.sum(value)}, row_id)


def occupancy_by_day(
    df: DataFrame, keys: Sequence[str], start: str, end: str, as_of, measures: Mapping[str, Column], out: str = "ref_date"
) -> DataFrame:
    """Per key and day the sums of ``measures`` over the intervals that cover the day.

    A sweep: an interval adds its measures on its first day and takes them off on the day after
    its last one (open ends last to ``as_of``, nothing after it counts). The changes of a day are
    summed before they move, a running sum per key gives the level, and only levels are listed
    by day. The work grows with the intervals plus the days in the result, not with the
    days of all intervals. Measures are whole numbers; a day on which all of them are zero is left out.
    """
    keys, names, today = list(keys), list(measures), as_date(as_of)
    rows = df.select(*keys, F.col(start).alias("_first"), F.least(F.coalesce(F.col(end), today), today).alias("_last"), *[m.cast("long").alias(n) for n, m in measures.items()])
    covered = rows.filter("_first <= _last")
    change = lambda day, sign: F.struct(day.alias("_day"), *[(sign * F.col(n)).alias(n) for n in names])
    both = F.array(change(F.col("_first"), F.lit(1)), change(F.date_add("_last", 1), F.lit(-1)))
    changes = covered.select(*keys, F.inline(both))
    per_day = changes.groupBy(*keys, "_day").agg(*[F.sum(n).alias(n) for n in names])
    sweep = Window.partitionBy(*keys).orderBy("_day")  # a row per key and day at most
    level = per_day.select(*keys, "_day", F.lead("_day").over(sweep).alias("_next"), *[F.sum(n).over(sweep).alias(n) for n in names])
    occupied = F.lit(False)
    for n in names:
        occupied = occupied | (F.col(n) != 0)
    days = F.explode(F.sequence(F.col("_day"), F.date_sub("_next", 1))).alias(out)
    return level.filter(F.col("_next").isNotNull() & occupied).select(*keys, days, *names)


def days_by_year(df: DataFrame, start: str, end: str, as_of) -> DataFrame:
    """One row per interval and calendar year it touches: ``yr``, ``n_days`` in it and ``last_day`` of them."""
    today = as_date(as_of)
    spanned = df.withColumn("_last", F.least(F.coalesce(F.col(end), today), today)).filter(F.col(start) <= F.col("_last"))
    years = spanned.withColumn("yr", F.explode(F.sequence(F.year(start).cast("long"), F.year("_last").cast("long"))))
    bound = lambda month, day: F.make_date(F.col("yr").cast("int"), F.lit(month), F.lit(day))
    last = F.least(F.col("_last"), bound(12, 31))
    return years.withColumns({"n_days": (F.datediff(last, F.greatest(F.col(start), bound(1, 1))) + 1).cast("long"), "last_day": last}).drop("_last")
