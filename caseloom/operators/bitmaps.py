"""Exact distinct counts by bitmaps that can be stored and merged without the base rows.

The ids of a group that meet a condition are bits of a few bitmaps, one per 32,768
consecutive ids. Several conditions share a pass; what moves in the shuffle are bitmaps, however
many rows an id has. Bitmaps of months are merged to those of a year, or of any other set
of groups, and give the exact number of ids, which counts of months cannot.

Ids are whole numbers, dense at best (see ``number_rows``): the count is right for any, but scattered
ids need a bitmap each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column of the number of a bitmap: which 32,768 ids it covers.
PLACE = "id_block"


def id_bitmaps(df: DataFrame, group: Sequence[str], id_col: str, tests: Mapping[str, Column]) -> DataFrame:
    """``group``, ``id_block`` and a bitmap per test of the ids with a row that passes it; rows without id count nowhere.

    Rows of one id are reduced to one first, by a hash aggregate with a map-side step, so the
    bitmaps are made from few rows.
    """
    known = df.filter(F.col(id_col).isNotNull())
    flags = known.groupBy(*group, id_col).agg(*[F.bool_or(F.coalesce(test, F.lit(False))).alias(n) for n, test in tests.items()])
    key = F.col(id_col).cast("long")
    bit = lambda n: F.when(F.col(n), F.bitmap_bit_position(key))
    return flags.groupBy(*group, F.bitmap_bucket_number(key).alias(PLACE)).agg(*[F.bitmap_construct_agg(bit(n)).alias(n) for n in tests])


def merged_bitmaps(bitmaps: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups: an id is in a group if it is in one of its parts."""
    return bitmaps.groupBy(*group, PLACE).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def id_counts(bitmaps: DataFrame, group: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Number of ids per group and test, from bitmaps with one row per group and block."""
    return bitmaps.groupBy(*group).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])
