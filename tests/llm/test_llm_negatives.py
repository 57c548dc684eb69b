from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from llm_frames import empty
from pyspark.sql import functions as F

from caseloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, vector array<float>"


def brute_force(rows, is_anchor, k=5):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, [math.floor(256 * float(np.float32(x))) for x in v])), (label, [math.floor(256 * float(np.float32(x))) for x in v]))
    whole = lambda p, q: sum(x * y for x, y in zip(kept[p][1], kept[q][1], strict=False))
    score = lambda p, q: min(max(whole(p, q), -(2**63)), 2**63 - 1)
    out = set()
    for a in filter(is_anchor, kept):
        others = sorted(((-score(a, b), b) for b in kept if b != a))
        for minus, p in [o for o in others if kept[o[1]][0] == kept[a][0]][:k]:
            fit = [(-m, n) for m, n in others if kept[n][0] != kept[a][0] and 80 * -minus <= 100 * -m <= 100 * -minus]
            out |= {(a, p, rank, n, -minus, s) for rank, (s, n) in enumerate(fit[:k], 1)}
    return out


def found(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return {tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()}


def vectors(rng, n, dims, close=0.3):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [[0.2 * (c + close * rng.gauss(0, 1)) for c in rng.choice(centres)] for _ in range(n)]


def test_equals_brute_force_in_one_block_and_in_many(spark, monkeypatch):
    rng = random.Random(3)
    for dims in (3, 70):
        rows = [(i, rng.randint(0, 3), v) for i, v in enumerate(vectors(rng, 180, dims))]
        wanted = brute_force(rows, lambda i: i % 10 == 0)
        assert len(wanted) > 50 and found(spark, rows) == wanted
        with monkeypatch.context() as m:
            m.setattr(hn, "ROW_BLOCK", (40, 40))
            m.setattr(hn, "ANCHOR_BLOCK", 7)
            m.setattr(hn, "PAIRS", 64)
            m.setattr(hn, "COMPONENTS", 60 * dims)
            assert found(spark, rows) == wanted


def test_awkward_rows(spark):
    rng = random.Random(4)
    copy = [0.3, -0.2, 0.1, 0.5]
    rows = [(i, i % 3, v) for i, v in enumerate(vectors(rng, 60, 4))]
    rows += [(100 + i, i % 2, copy) for i in range(120)]  # two thirds are one vector: ties everywhere
    rows += [(300, None, copy), (310, 1, None), (320, 1, [0.1, None, 0.2, 0.3]), (330, 1, [float("nan")] * 4), (340, 1, [float("inf")] * 4), (None, 1, copy)]
    rows += [(350, 1, []), (360, 1, [0.4]), (370, 1, [0.4] * 9), (380, 1, [0.0] * 4)]  # other lengths
    rows += [(390, 1, copy), (390, 1, copy), (400, 2, copy), (400, 0, copy[::-1])]  # repeated ids
    assert found(spark, rows) == brute_force(rows, lambda i: i % 10 == 0)
    assert hn.hard_negatives(empty(spark, SCHEMA), F.col("vec_id") % 10 == 0).count() == 0


def test_further_columns_and_other_types(spark):
    rows = [(i, i % 2, [0.5, i / 64], "x", 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id int, label short, vector array<double>, note string, n int").toDF("vec_id", "label", "vector", "Label", "rank")
    got = {tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()}
    assert got == brute_force([r[:3] for r in rows], lambda i: i % 10 == 0)


def test_large_components_are_scored_exactly(spark):
    for size in (2.0**22, 2.0**40):  # scores above what a double holds, and above what a long holds
        rows = [(i, i % 2, [size + i, -1.0]) for i in range(30)]
        assert found(spark, rows) == brute_force(rows, lambda i: i % 10 == 0) != set()


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(5)
    for dims in (1, 5, 64, 100):
        a, b = (np.floor(rng.normal(0, 40, (n, dims))) for n in (9, 30))
        blocks = []
        for v in (a, b):
            stored = [np.concatenate([hn.summaries(v[i : i + 1], level)[0] for level in range(len(hn.LEVELS))]) for i in range(len(v))]
            columns = {"vec_id": list(range(len(v))), "label": [0] * len(v), "vector": list(map(list, v)), "summary": list(map(list, stored))}
            blocks.append(hn.Block(pa.table(columns), dims))
        score, width = a @ b.T, math.inf
        for level in range(len(hn.LEVELS)):
            low, high = hn.bounds(*blocks, level)
            assert (low <= score + 1e-6).all() and (score <= high + 1e-6).all()
            assert (high - low).mean() <= width + 1e-6
            width = (high - low).mean()
            pairs = np.nonzero(np.ones_like(score, bool))
            assert np.allclose(hn.bounds(*blocks, level, pairs)[1], high.ravel())


def test_finer_segments_lie_inside_coarser_ones():
    for dims in (0, 1, 7, 64, 65, 1000):
        cuts = [{x for s in hn.segments(dims, level) for x in s} for level in range(len(hn.LEVELS))]
        assert cuts[0] <= cuts[1] <= cuts[2]
        assert all(sum(b - a for a, b in hn.segments(dims, level)) == dims for level in range(3))
