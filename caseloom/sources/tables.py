"""Source tables, rename projections and seed lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A declared source: parquet at ``folder/name.parquet``."""
    if name not in TABLES:
        raise KeyError(f"undeclared source {name!r}")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Raw-layer projection: output name to source column or expression."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def replace_columns(df: DataFrame, drop: tuple[str, ...] = (), **replaced: Column) -> DataFrame:
    """All columns except some, others replaced in place."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns if c not in drop])


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A static CSV lookup with a header and a declared schema."""
    return spark.read.csv(path, header=True, schema=schema)


def stamped(df: DataFrame, value: DataFrame, out: str) -> DataFrame:
    """Every row stamped with the single value of a one-row frame."""
    return df.withColumn(out, value.scalar())


def with_capture_time(df: DataFrame, at: Column | None = None, out: str = "captured_at") -> DataFrame:
    return df.withColumn(out, F.current_timestamp() if at is None else at)
