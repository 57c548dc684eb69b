"""Comparison of a computed table with its current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.keys import row_hash


def plain_text(col: Column, null_words: Sequence[str] = ("None",)) -> Column:
    """Text for comparison: NULL and its stand-ins are the empty string."""
    text = col.cast("string")
    return F.when(text.isNull() | text.isin(*null_words), F.lit("")).otherwise(text)


def _paired(new: DataFrame, old: DataFrame, key: str, cols: Sequence[str], null_words: Sequence[str]) -> DataFrame:
    """Computed and current text of every column, joined on the key as text."""
    n = new.select(
        F.col(key).cast("string").alias("_key"), F.struct(*[F.col(c) for c in new.columns]).alias("_row"),
        *[plain_text(F.col(c), null_words).alias(f"n_{c}") for c in cols],
    )
    o = old.select(
        F.col(key).cast("string").alias("_key"), *[plain_text(F.col(c), null_words).alias(f"o_{c}") for c in cols]
    )
    return n.join(o, "_key")


def changed_rows(
    new: DataFrame, old: DataFrame, key: str, cols: Sequence[str], null_words: Sequence[str] = ("None",)
) -> DataFrame:
    """Rows of ``new`` that differ from ``old`` in at least one column."""
    differs = F.lit(False)
    for c in cols:
        differs = differs | (F.col(f"n_{c}") != F.col(f"o_{c}"))
    return _paired(new, old, key, cols, null_words).filter(differs).select("_row.*")


def change_log(
    new: DataFrame,
    old: DataFrame,
    key: str,
    cols: Sequence[str],
    product: str,
    null_words: Sequence[str] = ("None",),
) -> DataFrame:
    """One row per changed column with the old and the new value."""
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.nullif(F.col(f"o_{c}"), F.lit("")).alias("old_value"),
                F.nullif(F.col(f"n_{c}"), F.lit("")).alias("new_value"),
            )
            for c in cols
        ]
    )
    long = _paired(new, old, key, cols, null_words).select("_key", F.explode(items).alias("i"))
    return (
        long.filter(~F.col("i.old_value").eqNullSafe(F.col("i.new_value")))
        .select(F.col("_key").alias("source_id"), F.lit(product).alias("product"), "i.*")
    )


def with_change_id(log: DataFrame) -> DataFrame:
    return log.withColumn("change_id", row_hash(*[F.col(c) for c in log.columns]))


def new_entrants(latest: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known yet."""
    return latest.join(known.select(key).distinct(), key, "left_anti")


def leavers(known: DataFrame, history: DataFrame, key: str, partition: str, newest: Column | None = None) -> DataFrame:
    """Known keys missing from the last partition, with the last one they were seen in.

    A caller that knows the last partition passes it and saves a scan.
    """
    last = history.groupBy(key).agg(F.max(partition).alias("last_seen"))
    newest = history.agg(F.max(partition).alias("m")).scalar() if newest is None else newest
    seen = known.select(key).distinct().join(last, key, "left")
    absent = F.col("last_seen").isNull() | (F.col("last_seen") < newest)
    return seen.filter(absent)
