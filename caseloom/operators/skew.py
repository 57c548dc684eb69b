"""Joins and group values that stay balanced when one key holds a large share of the rows.

Frequent keys come from the statistics of a table: one pass over its key columns with a
sketch of frequent items per key. Without a key above ``HEAVY_ROWS`` the plain join or window is
used: one shuffle. Otherwise the values of the heaviest keys travel by broadcast and their rows
are spread over many tasks in the shuffle join, where they match nothing. At most
``MAX_HEAVY`` keys are ever broadcast; a key that the sketch loses track of holds about one in
12,000 of the rows or fewer, which the plain shuffle carries, split by adaptive execution
where it has to be. The result is the same whatever the statistics say.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import cut_lineage

MAX_HEAVY = 8_192
HEAVY_ROWS = 1_000_000
SPREAD = 65_536
#: Rows of a key that meet in one group of a many-to-many join.
BLOCK_ROWS = 16_384
#: Items a sketch keeps track of: some 200 KB a task, which one task merges.
TRACKED = 16_384


@dataclass(frozen=True)
class KeyStatistics:
    """Per set of key columns the hashes of the keys with more than a given number of rows."""

    heavy: Mapping[tuple[str, ...], Sequence[int]]


def key_hash(*keys: str) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _sketches(key_sets: Sequence[Sequence[str]], above: int | None = None) -> list[Column]:
    """An aggregate per set of keys, with a map-side step; hardly any key reaches the driver."""
    above = HEAVY_ROWS if above is None else above
    hashes = [f"xxhash64({', '.join(f'`{k}`' for k in keys)})" for keys in key_sets]
    top = [F.expr(f"approx_top_k({h}, {MAX_HEAVY}, {TRACKED})") for h in hashes]
    return [F.filter(t, lambda x: x["count"] > above).alias(f"k{i}") for i, t in enumerate(top)]


def _statistics(found: Mapping, key_sets: Sequence[Sequence[str]]) -> KeyStatistics:
    return KeyStatistics({tuple(keys): [r["item"] for r in found[f"k{i}"] or []] for i, keys in enumerate(key_sets)})


def key_statistics(df: DataFrame, *key_sets: Sequence[str], above: int | None = None) -> KeyStatistics:
    """Statistics of several sets of key columns in one pass over the table; ``above`` stands in for HEAVY_ROWS."""
    return _statistics(df.agg(*_sketches(key_sets, above)).first().asDict(), key_sets)


def stored_with_statistics(df: DataFrame, label: str, *key_sets: Sequence[str]) -> tuple[DataFrame, KeyStatistics]:
    """The table written to the shared folder, and its statistics, for which its key columns alone are read again.

    They are merged by a task: an observation would send the sketches of every task to the driver.
    """
    stored = cut_lineage(df, label)
    return stored, key_statistics(stored, *key_sets)


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], *[F.col(c).alias(f"{prefix}{c}") for c in rest])


def _same(keys: Sequence[str], prefix: str, null_safe: bool) -> Column:
    test = F.lit(True)
    for k in keys:
        left, right = F.col(k), F.col(f"{prefix}{k}")
        test = test & (left.eqNullSafe(right) if null_safe else left == right)
    return test


def _two_way_join(
    left: DataFrame,
    heavy: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    null_safe: bool,
    how: str,
) -> DataFrame:
    """``heavy`` has ``_hash``, the keys and values of frequent keys; ``_found`` is false for a hash without a right row."""
    values = [c for c in right.columns if c not in keys and c != "_n"]
    heavy = _renamed(heavy, keys, "_h_")
    light = _renamed(right.withColumn("_found", F.lit(True)), keys, "_l_")
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(SPREAD)).cast("int") + 1
    # a hash alone proves nothing: the keys are compared, too, where there is a right row
    hit = (key_hash(*keys) == F.col("_h__hash")) & (~F.col("_h__found") | _same(keys, "_h_", null_safe=True))
    marked = left.join(F.broadcast(heavy), hit, "left")
    # the place is part of the join key, so heavy rows are hashed to many tasks
    place = F.when(F.col("_h__hash").isNotNull(), spread.cast("long")).otherwise(F.xxhash64(*keys))
    marked = marked.withColumn("_place", place)
    light = light.withColumn("_l_place", F.xxhash64(*[F.col(f"_l_{k}") for k in keys]))
    joined = marked.join(
        light, _same(keys, "_l_", null_safe) & (F.col("_place") == F.col("_l_place")), "left"
    )
    if how == "inner":
        joined = joined.filter(F.coalesce("_h__found", "_l__found", F.lit(False)))
    # a heavy row takes the broadcast value, any other row the shuffled one
    picked = [
        F.when(F.col("_h__hash").isNotNull(), F.col(f"_h_{v}")).otherwise(F.col(f"_l_{v}")).alias(v) for v in values
    ]
    return joined.select(*[F.col(c) for c in left.columns], *picked)


def _heavy(known: DataFrame | KeyStatistics, keys: Sequence[str]) -> Sequence[int]:
    statistics = known if isinstance(known, KeyStatistics) else key_statistics(known, keys)
    return statistics.heavy[tuple(keys)]


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    count_on: DataFrame | KeyStatistics | None = None,
) -> DataFrame:
    """Left or inner join to a ``right`` that has one row per key.

    ``spread_by`` names left columns that tell rows of one key apart. ``count_on`` are the
    statistics of the keys, or a cheaper table with the same keys to take them from; without it
    ``left`` is read for them.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    keys = list(keys)
    frequent = _heavy(left if count_on is None else count_on, keys)
    if not frequent:
        return left.join(right, keys, how).select(*left.columns, *[c for c in right.columns if c not in keys])
    hashes = left.sparkSession.createDataFrame([(h,) for h in frequent], "_hash long")
    complete = right.dropna(subset=keys).withColumn("_r_hash", key_hash(*keys)).withColumn("_found", F.lit(True))
    # right has a row per key: no more rows are left of it than there are frequent keys
    heavy = hashes.join(complete, F.col("_hash") == F.col("_r_hash"), "left").drop("_r_hash")
    heavy = heavy.withColumn("_found", F.coalesce("_found", F.lit(False)))
    return _two_way_join(left, heavy, right, keys, spread_by, False, how)


def attach_group(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    spread_by: Sequence[str],
    count_on: DataFrame | KeyStatistics | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Every row with the aggregates of its group, NULL keys forming one group.

    A window when every group fits a task; with heavy keys the groups are reduced
    before the shuffle and joined back, so none is gathered in one task. A caller
    that knows ``df`` has ``at_most`` so many rows may save the counting.
    """
    keys = list(keys)
    small = at_most is not None and at_most <= HEAVY_ROWS
    frequent = [] if small else _heavy(df if count_on is None else count_on, keys)
    if not frequent:
        group = Window.partitionBy(*keys)
        return df.select("*", *[value.over(group).alias(name) for name, value in aggregates.items()])
    stats = df.groupBy(*keys).agg(*[v.alias(n) for n, v in aggregates.items()])
    hashes = df.sparkSession.createDataFrame([(h,) for h in frequent], "_r_hash long")
    heavy = stats.withColumn("_hash", key_hash(*keys)).withColumn("_found", F.lit(True))
    heavy = heavy.join(F.broadcast(hashes), F.col("_hash") == F.col("_r_hash"), "left_semi")
    return _two_way_join(df, heavy, stats, keys, spread_by, True, "left")


def block_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_by: str, right_by: str, block_rows: int | None = None) -> DataFrame:
    """Inner join of many rows to many, the rows of a frequent key dealt into blocks on both sides.

    A key that has more than ``block_rows`` rows on a side is cut into blocks of about that many,
    by the hash of ``left_by`` and ``right_by``. Each block of one side meets each
    block of the other in a group of its own, so a key's pairs are spread over as many
    groups as it has pairs of blocks and no row is held with more than a block of others. Other
    keys move once.
    """
    keys, block_rows, spark = list(keys), block_rows or BLOCK_ROWS, left.sparkSession
    frequent = {h for side in (left, right) for h in key_statistics(side, keys, above=block_rows).heavy[tuple(keys)]}
    if not frequent:
        return left.join(right, keys)
    hashes = spark.createDataFrame([(h,) for h in sorted(frequent)], "_h long")

    def blocks(side: DataFrame, name: str) -> DataFrame:
        of_frequent = side.select(key_hash(*keys).alias("_h")).join(F.broadcast(hashes), "_h", "left_semi")
        return of_frequent.groupBy("_h").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    # a row for each frequent key
    sizes = hashes.join(blocks(left, "_l"), "_h", "left").join(blocks(right, "_r"), "_h", "left").fillna(1, ["_l", "_r"])

    def dealt(side: DataFrame, by: str, own: str, other: str) -> DataFrame:
        sized = side.withColumn("_h", key_hash(*keys)).join(F.broadcast(sizes), "_h", "left").fillna(1, ["_l", "_r"])
        mine = F.pmod(F.xxhash64(by), F.col(own)).alias(f"_b{own}")
        return sized.select(*side.columns, mine, F.explode(F.sequence(F.lit(0).cast("long"), (F.col(other) - 1).cast("long"))).alias(f"_b{other}"))

    met = dealt(left, left_by, "_l", "_r").join(dealt(right, right_by, "_r", "_l"), [*keys, "_b_l", "_b_r"])
    return met.drop("_b_l", "_b_r")


def best_row(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """One row per key: the greatest by the tuple ``by`` (NULL is the smallest).

    An aggregate with a map-side step, so a hot key is reduced before it moves.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*[b.alias(f"o{i}") for i, b in enumerate(by)])).alias("_r")
    )
    return picked.select(*keys, "_r.*").select(*df.columns)


def distinct_right(right: DataFrame, *keys: str) -> DataFrame:
    """Key list for a semi or anti join, reduced before it is shuffled."""
    return right.select(*keys).distinct()


def number_rows(df: DataFrame, id_col: str, out: str, ranges: int | None = None) -> DataFrame:
    """Dense numbers 1..n in the order of a unique integer id, without one global sort.

    Rows are dealt out by sampled quantiles of the ids, so sparse or uneven ids give
    ranges of like size. The ranges are written once; each is numbered on its own and
    shifted by the row count of those before it, one row per range.
    """
    dealt = df.repartitionByRange(id_col) if ranges is None else df.repartitionByRange(ranges, id_col)
    ranged = cut_lineage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    inside = Window.partitionBy("_range").orderBy(id_col)
    return (
        ranged.join(offsets, "_range")
        .withColumn(out, F.row_number().over(inside) + F.col("_before"))
        .drop("_range", "_before")
    )
