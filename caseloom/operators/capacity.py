"""Places of a unit from its bed configuration or its gendered places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.codes import yes_no


def unify_capacity(
    df: DataFrame, managed: Column, places: Sequence[str], beds: str, blocked: Sequence[str]
) -> DataFrame:
    """``total_places`` and ``available_places``.

    A unit that manages its own places counts their sum, any other its beds;
    blocked beds are taken off either way and a missing number counts as zero.
    """

    def total(cols: Sequence[str]) -> Column:
        summed = F.lit(0)
        for c in cols:
            summed = summed + F.coalesce(F.col(c), F.lit(0))
        return summed

    counted = df.withColumn("total_places", F.when(managed, total(places)).otherwise(total([beds])))
    return counted.withColumn("available_places", F.col("total_places") - total(blocked))


def code_flags(codes: DataFrame, keys: Sequence[str], code: str, flags: dict[str, str]) -> DataFrame:
    """One yes/no column per code from exploded codes; keys without codes keep 'no'."""
    marks = [F.max(yes_no(F.lower(F.coalesce(F.col(code), F.lit(""))) == value)).alias(name) for name, value in flags.items()]
    return codes.groupBy(*keys).agg(*marks)


def occupancy(units: DataFrame, stays: DataFrame, unit: str, open_test: Column, total: str, blocked: str) -> DataFrame:
    """Occupied, free places and the occupancy rate in percent per unit."""
    occupied = stays.filter(open_test).groupBy(unit).agg(F.count(F.lit(1)).alias("occupied"))
    joined = units.join(occupied, unit, "left").withColumn("occupied", F.coalesce("occupied", F.lit(0)))
    used = F.col("occupied") + F.col(blocked)
    rate = F.round(used / F.nullif(F.col(total), F.lit(0)) * 100, 2)
    return joined.withColumn("free", F.col(total) - used).withColumn("rate", rate)
