"""Surrogate keys and row hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column, null_mark: str = NULL_MARK) -> Column:
    """MD5 over the '-'-joined text of the columns, NULLs marked."""
    parts = [F.coalesce(c.cast("string"), F.lit(null_mark)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def row_hash(*cols: Column) -> Column:
    """64-bit hash of the row as JSON, NULL fields included."""
    return F.xxhash64(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))
