"""Tables kept on plain files: keyed merge, partition replacement, SCD2 history.

Every operator reads one version of a table and returns, or writes elsewhere, the
next one; nothing overwrites the files it is reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.functions.keys import row_hash
from caseloom.session import cut_lineage, make_folder


def merge_by_key(existing: DataFrame, incoming: DataFrame, key: Sequence[str], unique: bool = True) -> DataFrame:
    """Incoming rows replace existing rows with the same key; NULL equals NULL.

    Two incoming rows with one key are an error when the result is computed, unless ``unique`` is off.
    """
    if unique:
        repeats = F.count(F.lit(1)).over(Window.partitionBy(*key))
        message = F.lit(f"incoming rows repeat a key of {list(key)}")
        checked = incoming.withColumn("_repeats", repeats)
        single = F.when(F.col("_repeats") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        incoming = checked.filter(single).drop("_repeats")
    new_keys = incoming.select(*[F.col(k).alias(f"_n_{k}") for k in key]).distinct()
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    return existing.join(new_keys, same, "left_anti").unionByName(incoming)


def append_snapshot(existing: DataFrame, incoming: DataFrame, stamp: str, key: Sequence[str]) -> DataFrame:
    """Merge a stamped snapshot unless a snapshot with its stamp is already there."""
    done = existing.select(F.col(stamp).alias("_s")).distinct()
    fresh = incoming.join(done, F.col(stamp) == F.col("_s"), "left_anti")
    return merge_by_key(existing, fresh, key)


def merge_stored(incoming: DataFrame, path: str, key: Sequence[str], partition: str) -> None:
    """Merge rows by key into a table stored by partition; other partitions are neither read nor written.

    The partition is part of the key, so a row never moves to another one; a row without
    partition is an error. The first merge creates the table. Merged rows are written
    aside before they replace the partitions, so running it again changes nothing.
    """
    if partition not in key:
        raise ValueError(f"{partition} must be part of the key {list(key)}")
    spark = incoming.sparkSession
    make_folder(spark, path)
    incoming = cut_lineage(incoming, "incoming")
    # a folder each in the table, which the driver lists anyway
    touched = [r[0] for r in incoming.select(partition).distinct().collect()]
    if None in touched:
        raise ValueError(f"incoming rows without {partition}")
    if touched:
        stored = spark.read.schema(incoming.schema).parquet(path).filter(F.col(partition).isin(touched))
        overwrite_partitions(cut_lineage(merge_by_key(stored, incoming, key), "merged"), path, [partition])


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; running it twice changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def latest_partition(
    df: DataFrame, partition: str, control: DataFrame | None = None, unit: str | None = None
) -> DataFrame:
    """Rows of the newest partition, which a subquery of the same plan finds.

    On a stored partition the subquery is a partition filter: it runs first, and the scan opens
    the files of its answer alone. With ``unit`` the partition is that calendar unit
    (``month``, ``year``) of a stored timestamp, and the filter is a range of the stored column.
    """
    top = F.max(partition)
    newest = (control if control is not None else df).agg(F.date_trunc(unit, top) if unit else top).scalar()
    return df.filter(F.col(partition) >= newest if unit else F.col(partition) == newest)


def partitions_missing(landed: DataFrame, *done: DataFrame, partition: str) -> DataFrame:
    """Landed partitions that are in none of the given tables."""
    missing = landed.select(partition).distinct()
    for table in done:
        missing = missing.join(table.select(partition).distinct(), partition, "left_anti")
    return missing


def scd2_next(
    history: DataFrame, snapshot: DataFrame, key: str, cols: Sequence[str], as_of: Column
) -> DataFrame:
    """Next version of a history with ``valid_from`` / ``valid_to``.

    Unchanged rows stay open, changed and vanished rows are closed at ``as_of``,
    new and changed rows are opened at ``as_of``. One full outer join on the key.
    """
    closed = history.filter(F.col("valid_to").isNotNull())
    open_rows = history.filter(F.col("valid_to").isNull())
    cur = open_rows.select(
        F.col(key).alias("_k"), F.struct(*cols).alias("_cur"), "valid_from", row_hash(*[F.col(c) for c in cols]).alias("_ch")
    )
    new = snapshot.select(
        F.col(key).alias("_nk"), F.struct(*cols).alias("_new"), row_hash(*[F.col(c) for c in cols]).alias("_nh")
    )
    both = cur.join(new, F.col("_k") == F.col("_nk"), "full")
    same = F.col("_ch").eqNullSafe(F.col("_nh"))
    kept = F.when(
        F.col("_k").isNotNull(),
        F.struct(
            F.col("_cur").alias("row"),
            F.col("valid_from").alias("valid_from"),
            F.when(~same, as_of).alias("valid_to"),
        ),
    )
    opened = F.when(
        F.col("_nk").isNotNull() & ~same,
        F.struct(F.col("_new").alias("row"), as_of.alias("valid_from"), F.lit(None).cast("date").alias("valid_to")),
    )
    versions = both.select(
        F.coalesce("_k", "_nk").alias(key),
        F.explode(F.filter(F.array(kept, opened), lambda v: v.isNotNull())).alias("_v"),
    ).select(key, "_v.row.*", "_v.valid_from", "_v.valid_to")
    return closed.select(versions.columns).unionByName(versions)


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([], df.schema)
