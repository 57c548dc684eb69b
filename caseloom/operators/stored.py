"""Tables stored in buckets of a key's hash: merges that read and write the touched buckets only.

A row lies in the folder ``bucket=<hash of its key>``, below the folders of further
columns if a store has them. A load touches the buckets of its own keys; the others keep their
files. Each bucket is written anew as a whole, in files of an even size, so the number
of folders and of small files does not grow with the number of loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.keys import row_hash
from caseloom.operators.incremental import merge_by_key, merge_stored, overwrite_partitions
from caseloom.session import cut_lineage, make_folder, remove_folder

BUCKET = "bucket"
#: Folders of a store; a load that touches every bucket rewrites the table.
BUCKETS = 64


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """Bucket of a row, NULL keys included."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def read_store(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of a store without their bucket; with a schema an empty or missing store has no rows."""
    if schema is None:
        return spark.read.parquet(path).drop(BUCKET)
    make_folder(spark, path)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path).drop(BUCKET)


def _touched(df: DataFrame, folders: Sequence[str]) -> list[tuple]:
    """Folders that hold rows of ``df``: as many as the store has folders at most."""
    found = [tuple(r) for r in df.select(*folders).distinct().collect()]
    if any(v is None for r in found for v in r):
        raise ValueError(f"rows without {list(folders[:-1])}")
    return found


def _in_folders(df: DataFrame, folders: Sequence[str], touched: list[tuple]) -> DataFrame:
    """Rows of the touched folders; the scan skips all folders that share no value with them."""
    near = F.lit(True)
    for name, values in zip(folders, zip(*touched, strict=True), strict=True):
        near = near & F.col(name).isin(list(set(values)))
    rows = df.filter(near)
    if len(folders) == 1:
        return rows
    wanted = df.sparkSession.createDataFrame(touched, df.select(*folders).schema)
    return rows.join(F.broadcast(wanted), list(folders), "left_semi")


def _replace(rows: DataFrame, path: str, folders: Sequence[str], touched: list[tuple]) -> None:
    """Write the new rows of the touched folders; a folder without rows goes."""
    columns = [c for c in rows.columns if c not in folders] + list(folders)
    written = cut_lineage(rows.select(columns), "merged")
    # even files, and no task with more than its share of a large folder
    overwrite_partitions(written.hint("rebalance", *folders), path, folders)
    left = set(_touched(written, folders))
    for gone in touched:
        if gone not in left:
            remove_folder(rows.sparkSession, "/".join([path, *(f"{n}={v}" for n, v in zip(folders, gone, strict=True))]))


def merge_buckets(
    incoming: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS, within: Sequence[str] = (), unique: bool = True
) -> None:
    """Merge rows into a store: they replace the rows with their keys, NULL equals NULL.

    ``within`` names columns of the key that have folders of their own above the buckets;
    rows without them are an error. Two incoming rows with one key are an error, unless
    ``unique`` is off: then a key has many rows, which are replaced together. The first merge makes the
    table. New buckets are written aside first, so running a merge again, also one that broke
    off, leaves the same table.
    """
    if missing := [c for c in within if c not in key]:
        raise ValueError(f"{missing} must be part of the key {list(key)}")
    folders, spark = [*within, BUCKET], incoming.sparkSession
    incoming = cut_lineage(incoming.withColumn(BUCKET, bucket_of(key, buckets)), "incoming")
    touched = _touched(incoming, folders)
    if not touched:
        make_folder(spark, path)
        return
    make_folder(spark, path)
    stored = _in_folders(spark.read.schema(incoming.schema).parquet(path), folders, touched)
    _replace(merge_by_key(stored, incoming, key, unique), path, folders, touched)


def rows_with_keys(keys: DataFrame, path: str, key: Sequence[str], schema: T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """Rows of a store of unique keys whose key occurs in ``keys``; only the buckets of these keys are read.

    Keys are compared as they are, so NULL finds nothing. ``keys`` is read twice: pass a stored table.
    """
    keys, spark = keys.select(*key).distinct(), keys.sparkSession
    make_folder(spark, path)
    touched = _touched(keys.select(bucket_of(key, buckets).alias(BUCKET)), [BUCKET])
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    stored = spark.read.schema(full).parquet(path)
    near = _in_folders(stored, [BUCKET], touched) if touched else stored.limit(0)
    return near.drop(BUCKET).join(keys, list(key), "left_semi")


def append_snapshot_stored(incoming: DataFrame, path: str, stamp: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """Merge a stamped snapshot into a store unless its stamp is there; earlier snapshots keep their files.

    The stamp has folders of its own, so whether it is there is a look at folder names.
    """
    if stamp not in key:
        raise ValueError(f"{stamp} must be part of the key {list(key)}")
    stored = read_store(incoming.sparkSession, path, incoming.schema)
    done = stored.select(F.col(stamp).alias("_s")).distinct()
    fresh = incoming.join(F.broadcast(done), F.col(stamp) == F.col("_s"), "left_anti")
    merge_buckets(fresh, path, key, buckets, within=[stamp])


def scd2_update(snapshot: DataFrame, path: str, key: str, cols: Sequence[str], as_of: Column, buckets: int = BUCKETS) -> None:
    """Bring a stored history up to a snapshot: closed versions are only ever added.

    ``open`` holds the present version of each key in buckets, ``closed`` the versions that
    ended, by the day they ended. The snapshot is compared with the open versions in one
    full outer join; changed and vanished ones go to the folder of ``as_of`` in ``closed``, and the
    buckets they leave and those of new versions are written anew. Folders of earlier days are
    neither read nor written. Closed versions come first: a run that broke off is
    simply run again. Keys of a snapshot are unique and not NULL.
    """
    spark, current, ended = snapshot.sparkSession, f"{path}/open", f"{path}/closed"
    snapshot = snapshot.select(key, *cols)
    now = snapshot.select("*", as_of.cast("date").alias("valid_from"))
    before = read_store(spark, current, now.schema)
    marked = lambda df, side: df.select(
        F.col(key).alias(f"_{side}_key"), F.struct(*df.columns).alias(f"_{side}"), row_hash(*[F.col(c) for c in cols]).alias(f"_{side}_hash")
    )
    both = marked(before, "old").join(marked(now, "new"), F.col("_old_key") == F.col("_new_key"), "full")
    changes = cut_lineage(both.filter(~F.col("_old_hash").eqNullSafe(F.col("_new_hash"))).select("_old", "_new"), "changes")
    if changes.isEmpty():
        return
    closed = changes.filter("_old IS NOT NULL").select("_old.*", as_of.cast("date").alias("valid_to"))
    make_folder(spark, ended)
    merge_stored(closed, ended, [key, "valid_from", "valid_to"], "valid_to")
    opened = changes.filter("_new IS NOT NULL").select("_new.*")
    moved = changes.select(F.coalesce(F.col(f"_old.{key}"), F.col(f"_new.{key}")).alias(key)).withColumn(BUCKET, bucket_of([key], buckets))
    touched = _touched(moved, [BUCKET])
    if not touched:
        return
    opened = opened.withColumn(BUCKET, bucket_of([key], buckets))
    kept = _in_folders(spark.read.schema(opened.schema).parquet(current), [BUCKET], touched).join(moved.select(key), key, "left_anti")
    _replace(kept.unionByName(opened), current, [BUCKET], touched)


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All versions of a stored history; ``schema`` is that of a version with ``valid_from`` and ``valid_to``."""
    open_schema = T.StructType([f for f in schema.fields if f.name != "valid_to"])
    current = read_store(spark, f"{path}/open", open_schema).withColumn("valid_to", F.lit(None).cast("date"))
    make_folder(spark, f"{path}/closed")
    return spark.read.schema(schema).parquet(f"{path}/closed").unionByName(current)
