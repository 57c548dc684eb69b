"""Helpers shared by the operators: Arrow slices, word hashes, size-checked broadcasts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast: ids with a flag, below 20 MB on the driver.
BROADCAST_ROWS = 500_000
#: Rows turned into Python objects at a time.
SLICE_ROWS = 128
#: Entries of a worker's word table; it is emptied when full.
CACHE_WORDS = 300_000
#: Longer words are computed each time and never kept.
CACHE_CHARS = 64


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where driver and workers share the checkout but not the search path; a
    cluster is given the package with ``--py-files`` or in its image.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def column(batch: pa.RecordBatch, name: str, null=None) -> list:
    """Values of a column, ``null`` in place of missing ones."""
    values = batch.column(batch.schema.get_field_index(name)).to_pylist()
    return values if null is None else [null if v is None else v for v in values]


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than that many."""
    return df.limit(limit + 1).count() <= limit


def place_of(df: DataFrame, name: str) -> int:
    """Position of a column as ``first_column`` finds it: the exact name first, then without regard to case."""
    return df.columns.index(name) if name in df.columns else [c.lower() for c in df.columns].index(name.lower())


def by_position(df: DataFrame) -> DataFrame:
    """The same table with columns ``_0``, ``_1`` and so on, so that none clash."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def matching(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join on ``key``; the ids are broadcast only if they are few, else shuffled.

    The result is the same either way and has all columns of ``df``, whatever their
    names. ``ids`` is read twice: pass a stored table.
    """
    ids = ids.select(key).distinct().toDF("_key")
    rows, at = by_position(df), place_of(df, key)
    joined = rows.join(F.broadcast(ids) if bounded(ids) else ids, F.col(f"_{at}") == F.col("_key"), how)
    return joined.toDF(*df.columns)


def kept_rows(df: DataFrame, make_test: Callable[[], Callable[[pa.RecordBatch], list[bool]]]) -> DataFrame:
    """The rows that pass a test, all columns as they are, whatever their names; nothing is shuffled.

    ``make_test`` is called once in a task and gives the test of a batch, whose columns are found by position.
    """
    on_workers(df.sparkSession)

    def keep(batches):
        test = make_test()
        for batch in slices(batches):
            yield batch.filter(pa.array(test(batch), pa.bool_()))

    rows = by_position(df)
    return rows.mapInArrow(keep, rows.schema).toDF(*df.columns)


def first_column(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; of columns that share a name the first counts.

    Operators select what they need before anything else, so further columns of
    the input, clashing names included, never reach them. Names clash as Spark sees
    them, without regard to case; a column of exactly the name comes before others.
    """
    on_workers(df.sparkSession)
    folded = [c.lower() for c in df.columns]
    if len(set(folded)) == len(folded):
        return df.select(*names)
    return by_position(df).select(*[F.col(f"_{place_of(df, n)}").alias(n) for n in names])


def labelled_for_training(labels: DataFrame, label: str) -> DataFrame:
    """``(doc_id, label)`` of rows that may be learned from: crc32 of the id as text, mod 4, is not 2.

    Rows without id or label are left out; of contradicting labels of an id the larger counts.
    """
    rows = first_column(labels, "doc_id", label)
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    return rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


def held_out(name: str):
    """True for ids whose label is never learned from; a missing id counts as held out."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 4 == 2, F.lit(True))


class WordHashes:
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __init__(self, limit: int = CACHE_WORDS):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def __call__(self, words: Sequence[bytes]) -> np.ndarray:
        known = self.known
        values = list(map(known.get, words))
        if None in values:
            if len(known) > self.limit:
                known.clear()
            for i, v in enumerate(values):
                if v is None:
                    w = words[i]
                    v = known.get(w)
                    if v is None:
                        v = xxhash.xxh64_intdigest(w)
                        if len(w) <= CACHE_CHARS:
                            known[w] = v
                    values[i] = v
        return np.array(values, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers, the same for a seed on every machine."""
    base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mixed(base) | np.uint64(1)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes, in order."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(odd_numbers(width, 17)):
        total += h[j : j + n] * factor
    return mixed(total)
