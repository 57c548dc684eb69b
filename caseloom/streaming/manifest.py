"""The manifest of landed files: what was delivered, taken from the file listing alone.

The manifest is what an ingest promises to read. It knows of files that hold nothing,
which no reader of their contents would ever see, and of a file that is delivered again under its
name, which differs in size or time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import make_folder
from caseloom.sources.lines import partition_date

#: Files per part of the manifest, so per batch of an ingest.
BATCH_FILES = 1_000

MANIFEST = "file_path string, path string, length long, modified timestamp, part_date date"


def landed_files(spark: SparkSession, landing: str, name_part: int = -1) -> DataFrame:
    """``(file_path, path, length, modified, part_date)`` of every file under a path or pattern, empty files included.

    Sizes and times are file metadata, no content is read. ``name_part`` is the place of the
    dated name in the path: -1 for the file itself, -2 for its folder. ``path`` is missing for
    empty files, which nothing needs to open.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(landing)
    if not pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern):
        return spark.createDataFrame([], MANIFEST)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    # a scan leaves empty files out, the listing does not
    listed = spark.createDataFrame([(f,) for f in files.inputFiles()], "f string")
    named = listed.select(F.regexp_replace("f", "^file:/+", "file:/").alias("file_path"))  # as files name themselves when read
    full = files.select(
        F.col("_metadata.file_path").alias("_f"), "path", "length", F.col("modificationTime").alias("modified")
    )
    name = F.element_at(F.split("file_path", "/"), name_part)
    joined = named.join(full, F.col("file_path") == F.col("_f"), "left")
    return joined.select("file_path", "path", F.coalesce("length", F.lit(0)).alias("length"), "modified", partition_date(name).alias("part_date"))


def record_arrivals(spark: SparkSession, landing: str, manifest: str, name_part: int = -1) -> None:
    """Append the deliveries that the manifest lacks, a bounded number of files to a part of it."""
    make_folder(spark, manifest)
    files = landed_files(spark, landing, name_part)
    known = spark.read.schema(MANIFEST).parquet(manifest).select(F.col("file_path").alias("_f"), F.col("length").alias("_l"), F.col("modified").alias("_m"))
    same = (F.col("file_path") == F.col("_f")) & (F.col("length") == F.col("_l")) & F.col("modified").eqNullSafe(F.col("_m"))
    fresh = files.join(known, same, "left_anti")
    if not fresh.isEmpty():
        fresh.coalesce(1).write.mode("append").option("maxRecordsPerFile", BATCH_FILES).parquet(manifest)


def manifest_stream(spark: SparkSession, manifest: str) -> DataFrame:
    """The manifest as a stream, a part of it to a batch."""
    return spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 1).parquet(manifest)


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(line, file_path)`` of the given files; one that has gone meanwhile has no lines."""
    fs_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    paths = [p for p in paths if fs_path(p).getFileSystem(conf).exists(fs_path(p))]
    if not paths:
        return spark.createDataFrame([], "line string, file_path string")
    literal = [re.sub(r"[\[\]{}*?\\]", r"\\\g<0>", p) for p in paths]  # names are no patterns
    text = spark.read.option("ignoreMissingFiles", True).text(literal)
    return text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path"))
