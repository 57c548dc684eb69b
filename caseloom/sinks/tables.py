"""Tables of a catalog: replace by a new version, append, empty."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from caseloom.session import folder_names, remove_folder


#: Versions of a table that stay for readers that began before the last replacements.
KEPT_VERSIONS = 2


def swap_table(df: DataFrame, name: str, base: str, keep: int = KEPT_VERSIONS) -> str:
    """Replace a table at one stroke, whatever its columns, and return the folder of its new version.

    Readers go through a view over the folder of one version. The rows are written to a new
    folder of ``base`` and read back once; only then the view is replaced, in one statement, so a
    reader meets the old version or the new one and never none. A failed load leaves the old
    one in place and its own folder is removed. Of older versions the last ``keep`` stay for
    readers that are under way.
    """
    spark = df.sparkSession
    path = f"{base}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        spark.read.schema(df.schema).parquet(path).limit(1).count()
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    except Exception:
        remove_folder(spark, path)
        raise
    for old in sorted(folder_names(spark, base))[: -keep - 1]:
        remove_folder(spark, f"{base}/{old}")
    return path


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_or_empty(spark: SparkSession, df: DataFrame | None, schema, path: str) -> None:
    """Write a load; a source without rows leaves an empty table with its columns."""
    rows = spark.createDataFrame([], schema) if df is None else df
    rows.write.mode("overwrite").parquet(path)
