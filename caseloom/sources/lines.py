"""Raw-line ingestion: whole lines, file-name dates, archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Archive members that hold data.
DATA_SUFFIXES = (".txt", ".csv", ".dat")
CHUNK_LINES = 20_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line with the file it came from."""
    return spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path")
    )


def line_kind(line: Column, separator: str = ";") -> Column:
    """``blank``, ``data`` (first field all digits) or ``frame`` (header or footer)."""
    first = F.regexp_replace(F.split_part(line, F.lit(separator), F.lit(1)), '"', "")
    return (
        F.when(line.isNull() | (F.trim(line) == ""), "blank").when(first.rlike(r"^\d+$"), "data").otherwise("frame")
    )


def data_lines(df: DataFrame, line: str = "line") -> DataFrame:
    return df.filter(line_kind(F.col(line)) == "data")


def partition_date(name: Column) -> Column:
    """Date from a file name, NULL when it holds none.

    A dot-separated part ``C`` + YYMM means the first of that month; otherwise the
    first six digits after ``A`` that form a possible YYMMDD date.
    """
    parts = F.split(name, r"\.")
    month_text = F.get(F.filter(parts, lambda p: p.rlike(r"^C\d{4,}$")), F.lit(0))
    month = F.try_to_date(
        F.concat(F.lit("20"), F.substring(month_text, 2, 2), F.lpad(F.substring(month_text, 4, 10), 2, "0"), F.lit("01")),
        "yyyyMMdd",
    )
    tails = F.filter(parts, lambda p: p.rlike(r"^A.{6,}"))
    windows = F.flatten(
        F.transform(
            tails,
            lambda p: F.transform(F.sequence(F.lit(2), F.length(p) - 5), lambda i: p.substr(i, F.lit(6))),
        )
    )
    # two-digit years up to 68 belong to the 2000s
    century = lambda w: F.when(w.substr(1, 2).cast("int") <= 68, "20").otherwise("19")
    dates = F.transform(
        F.filter(windows, lambda w: w.rlike(r"^\d{6}$")),
        lambda w: F.try_to_date(F.concat(century(w), w), "yyyyMMdd"),
    )
    day = F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))
    return F.coalesce(month, day)


def _member_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.namelist():
                    if not member.lower().endswith(DATA_SUFFIXES):
                        continue
                    with archive.open(member) as raw:
                        text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="\n")
                        chunk: list[str] = []
                        for line in text:
                            chunk.append(line.rstrip("\r\n"))
                            if len(chunk) == CHUNK_LINES:
                                yield pd.DataFrame({"file_path": path, "member": member, "line": chunk})
                                chunk = []
                        if chunk:
                            yield pd.DataFrame({"file_path": path, "member": member, "line": chunk})


def unpack_archives(files: DataFrame) -> DataFrame:
    """Lines of the data members of zip archives given as ``path`` and ``content``.

    Members are streamed line by line in bounded chunks; only the compressed
    archive is held in memory.
    """
    return files.select("path", "content").mapInPandas(_member_lines, "file_path string, member string, line string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all zip files under a folder, one task per few archives."""
    return unpack_archives(spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]").load(path))
