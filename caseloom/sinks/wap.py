"""Write, audit, publish: a partitioned load that becomes visible only when it is sound."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.incremental import overwrite_partitions


def write_staged(df: DataFrame, path: str, partition: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(path)


def audit(df: DataFrame, partition: str, line: str, expected: DataFrame | None = None) -> DataFrame:
    """Rows and blank lines per partition with a verdict, all partitions in one aggregate.

    A NULL partition or an expected partition without rows fails; blank lines warn.
    """
    counts = df.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.trim(F.coalesce(F.col(line), F.lit(""))) == "").alias("n_blank")
    )
    if expected is not None:
        wanted = expected.select(F.col(partition).alias("_p")).distinct()
        joined = counts.join(wanted, F.col(partition).eqNullSafe(F.col("_p")), "full")
        counts = joined.select(
            F.coalesce(partition, "_p").alias(partition),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.coalesce("n_blank", F.lit(0)).alias("n_blank"),
        )
    verdict = (
        F.when(F.col(partition).isNull() | (F.col("n_rows") == 0), "fail")
        .when(F.col("n_blank") > 0, "warn")
        .otherwise("pass")
    )
    return counts.withColumn("status", verdict)


def publish(
    spark: SparkSession, staged: str | DataFrame, final: str, partition: str | list[str], line: str, expected: DataFrame | None = None
) -> None:
    """Audit the staged table, then replace its partitions in the final one.

    ``partition`` is a column or several, the first of which is audited. ``expected``
    names the partitions that were promised; one without rows fails. Publishing the
    same staged data twice leaves the same final table.
    """
    rows = spark.read.parquet(staged) if isinstance(staged, str) else staged
    columns = [partition] if isinstance(partition, str) else partition
    bad = audit(rows, columns[0], line, expected).filter("status = 'fail'").limit(1).count()
    if bad:
        raise RuntimeError(f"audit failed: a partition of {final} is missing or empty")
    overwrite_partitions(rows, final, columns)


def clear_staged(spark: SparkSession, staged: str) -> None:
    """Leave an empty staging table with the same columns."""
    schema = spark.read.parquet(staged).schema
    spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
