"""Incremental file ingest: each delivery once, staged, audited file by file, then published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.incremental import overwrite_partitions
from caseloom.operators.stored import merge_buckets, read_store
from caseloom.session import run_path
from caseloom.sinks.wap import audit, write_staged
from caseloom.sources.lines import line_kind
from caseloom.streaming.manifest import lines_of, manifest_stream, record_arrivals

#: Folders of a day's files: a delivery rewrites those of its files and no others.
SLOTS = 8

LINES = "line string, file_path string, part_date date"
QUARANTINE = "file_path string, part_date date, length long, modified timestamp, n_rows long, reason string, batch_id long"


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    final: str,
    checkpoint: str,
    name_part: int = -1,
    rejected: str | None = None,
    quarantine: str | None = None,
) -> None:
    """Process the deliveries that arrived since the last run, then stop.

    The file listing is recorded in a manifest first (``<checkpoint>-manifest``), and the
    manifest is the stream: its checkpoint remembers which deliveries were done. The files of
    a batch are staged and audited against what the manifest promises: a file of at least one data
    line each. Sound files are published; a file that is empty, without data lines or
    gone is reported in the table ``quarantine`` and holds nothing else up.

    The final table has the folders ``part_date`` and, in them, a fixed number of slots by file
    name. A file that is delivered again replaces its lines; if the new delivery is unsound the
    old lines stay. Lines of files without a date in their name go to the table ``rejected``.
    Running a batch again after a failure leaves the same tables. ``name_part`` is the
    place of the dated name in the path, -1 for the file itself, -2 for its folder.
    """
    rejected, quarantine, manifest = rejected or f"{final}-rejected", quarantine or f"{final}-quarantine", f"{checkpoint}-manifest"
    record_arrivals(spark, landing, manifest, name_part)

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        # a part of the manifest: a bounded number of names
        files = spark.createDataFrame(batch.collect(), batch.schema)
        lines = lines_of(spark, [r["path"] for r in files.collect() if r["path"] is not None])
        data = lines.filter(line_kind(F.col("line")) == "data")
        undated = files.filter("part_date IS NULL").select("file_path")
        merge_buckets(lines.join(F.broadcast(undated), "file_path"), rejected, ["file_path"], SLOTS, unique=False)
        dated = files.filter("part_date IS NOT NULL")
        staged = run_path(spark, "staged")
        write_staged(data.join(F.broadcast(dated.select("file_path", "part_date")), "file_path"), staged, "part_date")
        rows = spark.read.schema(LINES).parquet(staged)
        verdicts = audit(rows, "file_path", "line", dated).select("file_path", "n_rows", "status")
        reported = dated.join(verdicts, "file_path")
        sound = reported.filter("status <> 'fail'").select("file_path")
        reason = F.when(F.col("path").isNull(), "empty file").otherwise("no data lines")
        bad = reported.filter("status = 'fail'").select(
            "file_path", "part_date", "length", "modified", "n_rows", reason.alias("reason"), F.lit(batch_id).cast("long").alias("batch_id")
        )
        overwrite_partitions(bad, quarantine, ["batch_id"])
        merge_buckets(rows.join(F.broadcast(sound), "file_path", "left_semi"), final, ["part_date", "file_path"], SLOTS, within=["part_date"], unique=False)

    query = (
        manifest_stream(spark, manifest)
        .writeStream.foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingested_lines(spark: SparkSession, final: str) -> DataFrame:
    """``(line, file_path, part_date)`` of an ingest's table, without rows before the first delivery."""
    return read_store(spark, final, spark.createDataFrame([], LINES).schema)


def quarantined_files(spark: SparkSession, quarantine: str) -> DataFrame:
    """Deliveries that the audit refused, with the reason; without rows if there were none."""
    return read_store(spark, quarantine, spark.createDataFrame([], QUARANTINE).schema)
