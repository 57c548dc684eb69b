"""Hard negatives by segment summaries.

Every vector is stored with the mean and the deviation of its segments, at several numbers
of segments. For two segments of m components the inner product is m times the product of
the means, plus or minus at most m times the product of the deviations, so summaries bound a
score from both sides. Pairs that the coarse bounds cannot settle go to the next finer
segments, and only what is left is scored exactly.

Anchors are a stated set of queries. They meet all rows block by block: both sides are dealt
into blocks of bounded size, and each pair of blocks is one group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import column, first_column, on_workers
from caseloom.session import cut_lineage

#: Segments per refinement; each level cuts the segments of the one before into equal parts.
LEVELS = (4, 16, 32)
#: Rows of a block, the least and the most, and anchors of a block, whatever the tables' size.
ROW_BLOCK, ANCHOR_BLOCK = (2_048, 65_536), 4_096
#: Components of a block at most, so that long vectors come in smaller blocks.
COMPONENTS = 1 << 22
#: Pairs whose bounds are held at a time, and pairs whose vectors are gathered at a time.
PAIRS, GATHERED = 1 << 18, 1 << 14
#: One pair in so many is left: from there on pairs are gathered one by one, before all are multiplied as blocks.
SPARSE = 24
#: Relative room for rounding in the bounds.
ROOM = 1e-9

STORED = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64())), ("summary", pa.list_(pa.float64()))])
SCORED = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
SCORED_TYPE = "anchor_id long, positive_id long, vec_id long, score long"


def quantised(vector: Column) -> Column:
    """Each component ``x`` as ``floor(256 * x)``, with ``x`` a double; whole numbers kept as doubles."""
    return F.transform(vector, lambda x: _floor(x.cast("double") * 256.0))


def _floor(x: Column) -> Column:
    # floor() gives a long, which very large components do not fit; beyond 2**52 a double is whole
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def segments(dims: int, level: int) -> list[tuple[int, int]]:
    """Bounds of the segments of a level; those of a finer level lie inside those of a coarser one."""
    parts = LEVELS[level]
    cuts = sorted({dims * k // parts for k in range(parts + 1)})
    return list(zip(cuts, cuts[1:], strict=False))


def summaries(vectors: np.ndarray, level: int) -> np.ndarray:
    """Means, then deviations of the segments, scaled by the root of their length so that bounds are inner products."""
    means, deviations = [], []
    for a, b in segments(vectors.shape[1], level):
        part, root = vectors[:, a:b], math.sqrt(b - a)
        means.append(part.mean(axis=1) * root)
        deviations.append(part.std(axis=1) * root)
    return np.stack(means + deviations, axis=1) if means else np.zeros((len(vectors), 0))


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = column(batch, "vector")
        by_width: dict[int, list[int]] = {}
        for i, v in enumerate(lists):
            by_width.setdefault(len(v), []).append(i)
        summary: list = [None] * len(lists)
        for rows in by_width.values():
            vectors = np.array([lists[i] for i in rows], np.float64).reshape(len(rows), -1)
            found = np.concatenate([summaries(vectors, level) for level in range(len(LEVELS))], axis=1)
            for i, s in zip(rows, found, strict=True):
                summary[i] = s
        arrays = [batch.column(batch.schema.get_field_index(n)) for n in ("vec_id", "label", "vector")]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(summary, pa.list_(pa.float64()))], schema=STORED)


def stored_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, vector, summary)`` of the rows that take part, written to the shared folder.

    Rows without id, label or vector and rows with a null or non-finite component take no part;
    of rows that share an id the least (label, vector) counts, so repeated rows are one.
    """
    rows = first_column(vectors, "vec_id", "label", "vector").filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = rows.filter(F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), quantised(F.col("vector")).alias("vector")).alias("row")
    )
    one = whole.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vector")
    return cut_lineage(one.mapInArrow(_summarised, "vec_id long, label long, vector array<double>, summary array<double>"), "vectors")


class Block:
    """Rows of a block as arrays, by ascending id: ids, labels, vectors and the summaries of each level."""

    def __init__(self, table: pa.Table, dims: int):
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], table.column("label").to_numpy()[order]
        values, lengths = _ragged(table, "vector")
        vectors = np.zeros((len(ids), dims))
        vectors[np.arange(dims) < lengths[:, None]] = values
        self.vectors = vectors[order]
        if (lengths == dims).all():
            flat, at = _ragged(table, "summary")[0].reshape(len(ids), -1)[order], 0
            self.levels = []
            for level in range(len(LEVELS)):
                width = 2 * len(segments(dims, level))
                self.levels.append(flat[:, at : at + width])
                at += width
        else:  # shorter vectors end in zeros here, so their segments lie elsewhere
            self.levels = [summaries(self.vectors, level) for level in range(len(LEVELS))]
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))

    def part(self, rows: slice | np.ndarray) -> Block:
        out = object.__new__(Block)
        out.ids, out.labels, out.vectors, out.norms = self.ids[rows], self.labels[rows], self.vectors[rows], self.norms[rows]
        out.levels = [x[rows] for x in self.levels]
        return out


def _products(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, or of the given pairs, a bounded number of them at a time."""
    if pairs is None:
        return a @ b.T
    out = np.empty(len(pairs[0]))
    for s in range(0, len(out), GATHERED):
        i, j = pairs[0][s : s + GATHERED], pairs[1][s : s + GATHERED]
        out[s : s + GATHERED] = np.einsum("ij,ij->i", a[i], b[j])
    return out


def bounds(anchors: Block, rows: Block, level: int, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the scores, of all pairs or of the given ones."""
    a, b = anchors.levels[level], rows.levels[level]
    half = a.shape[1] // 2
    means, deviations = _products(a[:, :half], b[:, :half], pairs), _products(a[:, half:], b[:, half:], pairs)
    deviations += ROOM * (np.outer(anchors.norms, rows.norms) if pairs is None else anchors.norms[pairs[0]] * rows.norms[pairs[1]])
    return means - deviations, means + deviations


def exact(anchors: Block, rows: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whole-number scores of pairs; such as no long can hold stay at its ends."""
    a, b = anchors.vectors, rows.vectors
    if not len(i) or not a.shape[1]:
        return np.zeros(len(i), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        if len(i) * SPARSE > len(a) * len(b):
            return (a @ b.T)[i, j].astype(np.int64)
        return _products(a, b, (i, j)).astype(np.int64)
    least, most = -(2**63), 2**63 - 1
    return np.array([min(max(sum(int(x) * int(y) for x, y in zip(a[p], b[q], strict=True)), least), most) for p, q in zip(i, j, strict=True)], np.int64)


def best(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each group, higher scores first, ties by smaller id."""
    order = np.lexsort((ids, ~scores, groups))  # ~ turns the order round, the ends of a long included
    ordered = groups[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    rank = np.arange(len(ordered)) - np.repeat(begins, np.diff(np.r_[begins, len(ordered)]))
    return order[rank < k]


def _kth(values: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``values``, the columns of its ``k`` largest living entries, and which rows have that many."""
    masked = np.where(alive, values, -np.inf)
    k = min(k, masked.shape[1])
    top = np.argpartition(-masked, k - 1, axis=1)[:, :k]
    return top, np.isfinite(np.take_along_axis(masked, top, axis=1)).all(axis=1)


def nearest(anchors: Block, rows: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` rows of each anchor among ``rows``, itself left out: anchor positions, row positions, scores.

    The rows with the largest upper bounds are scored at once; the least of their scores is a
    limit that no row with a smaller upper bound can reach.
    """
    alive = anchors.ids[:, None] != rows.ids[None, :]
    floor = np.full(len(anchors.ids), -np.inf)
    pairs = None
    for level in range(len(LEVELS)):
        if pairs is None:
            upper = bounds(anchors, rows, level)[1]
            if len(rows.ids) > k:
                top, enough = _kth(upper, alive, k)
                if enough.any():
                    who = np.flatnonzero(enough)
                    first = exact(anchors, rows, np.repeat(who, top.shape[1]), top[who].ravel())
                    least = first.reshape(len(who), -1).min(axis=1).astype(np.float64)
                    least = np.where(least > -(2.0**63), least - np.abs(least) * ROOM, -np.inf)
                    floor[who] = np.maximum(floor[who], least)
            alive &= upper >= floor[:, None]
            if alive.sum() * SPARSE < alive.size:
                pairs = np.nonzero(alive)
        else:
            upper = bounds(anchors, rows, level, pairs)[1]
            keep = upper >= floor[pairs[0]]
            pairs = pairs[0][keep], pairs[1][keep]
    i, j = np.nonzero(alive) if pairs is None else pairs
    scores = exact(anchors, rows, i, j)
    first = best(i, scores, rows.ids[j], k)
    return i[first], j[first], scores[first]


def within(anchors: Block, least: np.ndarray, most: np.ndarray, rows: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of another label whose score lies from ``least`` to ``most`` of the anchor: anchor positions, row positions, scores."""
    alive = anchors.labels[:, None] != rows.labels[None, :]
    pairs = None
    for level in range(len(LEVELS)):
        if pairs is None:
            lower, upper = bounds(anchors, rows, level)
            alive &= (upper >= least[:, None]) & (lower <= most[:, None])
            if alive.sum() * SPARSE < alive.size:
                pairs = np.nonzero(alive)
        else:
            lower, upper = bounds(anchors, rows, level, pairs)
            keep = (upper >= least[pairs[0]]) & (lower <= most[pairs[0]])
            pairs = pairs[0][keep], pairs[1][keep]
    i, j = np.nonzero(alive) if pairs is None else pairs
    return i, j, exact(anchors, rows, i, j)


def _ragged(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after another, and the length of each list."""
    lists = table.column(name).combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _blocks(left: pa.Table, right: pa.Table) -> tuple[Block, Block]:
    """Anchors and rows of a pair of blocks, brought to one number of components."""
    dims = max(int(_ragged(t, "vector")[1].max()) for t in (left, right))
    return Block(left, dims), Block(right, dims)


def _chunks(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, PAIRS // max(rows, 1))
    return (slice(s, s + step) for s in range(0, anchors, step))


def _scored(found: list[tuple[np.ndarray, ...]]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=SCORED)


def _positives_of(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _scored([])
        anchors, rows = _blocks(left, right)
        found = []
        for label in np.unique(anchors.labels):
            ours, theirs = anchors.part(np.flatnonzero(anchors.labels == label)), rows.part(np.flatnonzero(rows.labels == label))
            if not len(theirs.ids):
                continue
            for chunk in _chunks(len(ours.ids), len(theirs.ids)):
                part = ours.part(chunk)
                i, j, scores = nearest(part, theirs, k)
                found.append((part.ids[i], theirs.ids[j], theirs.ids[j], scores))
        return _scored(found)

    return search


def least_score(positive: int, percent: int) -> int:
    """Smallest score that is ``percent`` of the positive's or more, without rounding."""
    return -(-percent * positive // 100)


def _negatives_of(k: int, percent: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _scored([])
        anchors, rows = _blocks(left, right)
        wanted = dict(zip(left.column("vec_id").to_pylist(), left.column("positives").to_pylist(), strict=True))
        ranges = [[(p["positive_id"], least_score(p["score"], percent), p["score"]) for p in wanted[i]] for i in anchors.ids.tolist()]
        # doubles, a little wider: the ranges are compared once more as whole numbers below
        least = np.array([min(r[1] for r in own) for own in ranges], np.float64)
        most = np.array([max(r[2] for r in own) for own in ranges], np.float64)
        least, most = least - np.abs(least) * ROOM, most + np.abs(most) * ROOM
        most[most >= 2.0**63] = np.inf  # a score at the end of a long may stand for any larger one
        found = []
        for chunk in _chunks(len(anchors.ids), len(rows.ids)):
            part = anchors.part(chunk)
            i, j, scores = within(part, least[chunk], most[chunk], rows)
            own = ranges[chunk]
            for n in range(max(map(len, own), default=0)):
                low = np.array([r[n][1] if n < len(r) else 1 for r in own], np.int64)
                high = np.array([r[n][2] if n < len(r) else 0 for r in own], np.int64)
                ids = np.array([r[n][0] if n < len(r) else 0 for r in own], np.int64)
                fits = np.flatnonzero((scores >= low[i]) & (scores <= high[i]))
                fits = fits[best(i[fits], scores[fits], rows.ids[j[fits]], k)]
                found.append((part.ids[i[fits]], ids[i[fits]], rows.ids[j[fits]], scores[fits]))
        return _scored(found)

    return search


def _met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, dims: int, search) -> DataFrame:
    """``search`` over every pair of an anchor block and a row block, each pair a group of its own."""
    session = rows.sparkSession
    on_workers(session)
    tasks, most = session.sparkContext.defaultParallelism, max(1, COMPONENTS // max(dims, 1))
    size = min(max(n_rows // (4 * tasks), ROW_BLOCK[0]), ROW_BLOCK[1], most)
    row_blocks, anchor_blocks = max(1, -(-n_rows // size)), max(1, -(-n_anchors // min(ANCHOR_BLOCK, most)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], dealt(anchor_blocks).alias("a"), every(row_blocks).alias("r"))
    right = rows.select("*", dealt(row_blocks).alias("r"), every(anchor_blocks).alias("a"))
    return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(search, SCORED_TYPE)


def _first(scored: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has ``vec_id``, ``label`` and ``vector``; ``is_anchor`` is a condition on
    ``vec_id`` and ``label``. Scores are inner products of ``floor(256 * x)``; higher ones come
    first, ties by smaller id. Positives of an anchor are its first other rows of the same
    label, hard negatives of a positive the first rows of other labels that score from
    ``percent`` of it up to it; none for a positive below zero.

    Rows with missing or non-finite values take no part, repeated ids are one row, a shorter
    vector counts as one with zeros behind it, an empty one scores 0 everywhere. Scores that
    no long can hold stay at its ends. No rows give no negatives; further columns are not
    looked at.
    """
    rows = stored_vectors(vectors)
    anchors = rows.filter(is_anchor)
    n_rows, n_anchors, dims = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    near = _met(anchors, rows, n_anchors, n_rows, dims, _positives_of(positives))
    chosen = cut_lineage(_first(near, ["anchor_id"], positives).select("anchor_id", "positive_id", "score"), "positives")
    given = chosen.filter("score >= 0").groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    asking = anchors.join(given, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    scored = _met(asking, rows, n_anchors, n_rows, dims, _negatives_of(negatives, percent))
    found = _first(scored, ["anchor_id", "positive_id"], negatives)
    return found.join(chosen.withColumnRenamed("score", "positive_score"), ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
