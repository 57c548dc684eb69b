"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    """Builder with the library's defaults; keyword ``a__b`` sets ``a.b``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall
    back to a temporary folder when the setting is absent.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    created = tempfile.mkdtemp(prefix="caseloom-")
    spark.sparkContext.setCheckpointDir(created)
    return created


def run_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; two runs never meet in one path."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    A lost executor then re-reads files instead of replaying the whole history.
    """
    path = run_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder of the shared store, if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder of the shared store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [e.getPath().getName() for e in entries]
