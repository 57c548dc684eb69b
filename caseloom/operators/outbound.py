"""Update sets for an external system, written as batched payload rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.dates import date_to_epoch_millis
from caseloom.functions.text import null_words
from caseloom.operators.skew import number_rows
from caseloom.session import cut_lineage, make_folder
from caseloom.sinks.tables import append_rows

BATCH_ROWS = 100


def iso_day_millis(text: Column) -> Column:
    """UTC epoch millis of an ISO date, NULL for any other text."""
    is_date = F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}$")
    return date_to_epoch_millis(F.when(is_date, F.trim(text).try_cast("date")))


def outbound_value(col: Column, as_millis: bool) -> Column:
    """Text as it is, or where asked for an ISO date as a number: a variant holds either."""
    if not as_millis:
        return col
    return F.coalesce(iso_day_millis(col).cast("variant"), col.cast("variant"))


def update_batches(
    df: DataFrame, key: str, cols: Sequence[str], millis_cols: Sequence[str] = (), batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """Payload JSON per row with a batch number, ``batch_rows`` rows to a batch; a row without key is an error.

    Null words are dropped. In the payload, dates of ``millis_cols`` are numbers.
    """
    cleaned = df.select(
        F.coalesce(F.col(key).cast("long"), F.raise_error(F.lit(f"an update row has no {key}")).cast("long")).alias(key),
        *[null_words(F.col(c).cast("string")).alias(c) for c in cols],
    )
    numbered = number_rows(cleaned, key, "_no")
    attributes = F.struct(key, *[outbound_value(F.col(c), c in millis_cols).alias(c) for c in cols])
    return (
        numbered.withColumn("batch", F.floor((F.col("_no") - 1) / batch_rows).cast("long"))
        .withColumn("payload", F.to_json(F.struct(attributes.alias("attributes")), {"ignoreNullFields": "false"}))
        .drop("_no")
    )


def read_crosswalk(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``(key, external_id, synced_at)`` of all rows that the external system holds; empty at first."""
    make_folder(spark, path)
    return spark.read.schema(f"{key} long, external_id long, synced_at timestamp").parquet(path)


def pending_adds(df: DataFrame, crosswalk: DataFrame, key: str) -> DataFrame:
    """Rows that the external system does not hold yet; a row without key is never held."""
    return df.join(crosswalk.select(key).distinct(), key, "left_anti")


def record_adds(accepted: DataFrame, path: str, key: str, at: Column) -> None:
    """Append accepted rows ``(key, external_id)`` with their sync time; known keys keep their entry."""
    known = read_crosswalk(accepted.sparkSession, path, key)
    entries = accepted.select(F.col(key).cast("long").alias(key), F.col("external_id").cast("long").alias("external_id"), at.alias("synced_at"))
    append_rows(cut_lineage(pending_adds(entries, known, key), "adds"), path)
