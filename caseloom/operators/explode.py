"""Explosion of lists and intervals into rows, and nesting of rows into lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.codes import Domain, map_domain
from caseloom.functions.dates import as_date, day_range
from caseloom.functions.text import trim_space
from caseloom.operators.skew import attach_group


def code_tokens(col: Column, separator: str = ",", none_mark: str = "N") -> Column:
    """Trimmed non-blank tokens; the marker for "none" gives no tokens."""
    tokens = F.filter(F.transform(F.split(col, separator), lambda t: trim_space(t)), lambda t: t != "")
    empty = F.array().cast("array<string>")
    return F.when(col.isNull() | (F.upper(trim_space(col)) == none_mark), empty).otherwise(tokens)


def explode_codes(df: DataFrame, id_cols: Sequence[str], col: str, domain: Domain) -> DataFrame:
    """One row per entity and listed code with its label."""
    codes = df.select(*id_cols, F.explode(code_tokens(F.col(col))).alias("code"))
    return codes.withColumn("label", map_domain(F.col("code"), domain))


def explode_id_list(df: DataFrame, col: str, out: str) -> DataFrame:
    """Rows for a list such as ``(1,2,3)``: distinct integer ids, anything else dropped."""
    tokens = F.split(F.regexp_replace(F.col(col), "[()]", ""), ",")
    ids = F.filter(F.transform(tokens, lambda t: trim_space(t).try_cast("long")), lambda i: i.isNotNull())
    return df.withColumn(out, F.explode(F.array_distinct(ids)))


def explode_shared(df: DataFrame, main: str, shared: str, separator: str = ",") -> DataFrame:
    """Rows for the main provider and for every other provider in the shared list.

    Zero-padded ids are the same provider; repeats and the main provider are not
    listed twice; a row without a main provider still yields its shared ones.
    """
    own = F.col(main).cast("string").try_cast("long")
    tokens = F.transform(
        F.split(F.coalesce(F.col(shared), F.lit("")), separator), lambda t: trim_space(t).try_cast("long")
    )
    others = F.filter(F.array_distinct(tokens), lambda p: p.isNotNull() & ~p.eqNullSafe(own))
    providers = F.concat(
        F.array(F.struct(own.alias("id"), F.lit(True).alias("is_main"))),
        F.transform(others, lambda p: F.struct(p.alias("id"), F.lit(False).alias("is_main"))),
    )
    exploded = df.withColumn("_p", F.explode(providers))
    return exploded.withColumn(main, F.col("_p.id")).withColumn("is_main", F.col("_p.is_main")).drop("_p", shared)


def explode_days(df: DataFrame, start: str, end: str, as_of, out: str = "ref_date") -> DataFrame:
    """One row per day from start to end (open ends at ``as_of``), none after ``as_of``."""
    today = as_date(as_of)
    last = F.least(F.coalesce(F.col(end), today), today)
    return df.withColumn(out, F.explode(day_range(F.col(start), last)))


def nest_children(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    order_by: Sequence[str],
    out: str = "items",
    part_rows: int = 100_000,
) -> DataFrame:
    """Children as ordered arrays of structs, one row per (key, part).

    A key has one part per ``part_rows`` children, rounded up, and its children go to
    parts by the hash of ``order_by``, so no array outgrows a task. Values per key are
    aggregated over the parts. ``order_by`` fields must identify a child within its key.
    """
    keys = list(keys)
    children = df.select(*keys, *fields)
    sized = attach_group(children, keys, {"_size": F.count(F.lit(1))}, list(fields))
    parts = F.ceil(F.col("_size") / part_rows)
    parted = sized.withColumn("part", F.pmod(F.xxhash64(*order_by), parts).cast("int"))
    ordered = [*order_by, *[f for f in fields if f not in order_by]]
    items = F.array_sort(F.collect_list(F.struct(*ordered)))
    return parted.groupBy(*keys, "part").agg(items.alias(out))


def bounded_text_list(df: DataFrame, keys: Sequence[str], col: str, separator: str, out: str) -> DataFrame:
    """Distinct values per key in ascending order, joined to one text.

    Duplicates are removed before the list is built, so its length is the number
    of distinct values, not the number of rows.
    """
    distinct = df.select(*keys, col).filter(F.col(col).isNotNull()).distinct()
    joined = F.array_join(F.array_sort(F.collect_list(col)), separator)
    return distinct.groupBy(*keys).agg(joined.alias(out))
