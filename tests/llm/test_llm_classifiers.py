from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from llm_frames import AWKWARD, awkward, empty

from caseloom.llm import quality_fm, toxicity


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def corpus(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")
    return docs, labels


def accuracy(scores, rows, threshold):
    right = [(r.score >= threshold) == bool(rows[r.doc_id][1]) for r in scores.collect() if held_out(r.doc_id)]
    assert len(right) > 50
    return sum(right) / len(right)


def brute_segments(scores):
    """Maximal segments by definition: the best, first and longest; then left and right of it."""
    best = max(((sum(scores[i:j]), -i, j) for i, j in itertools.combinations(range(len(scores) + 1), 2)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], best[2]
    left, right = brute_segments(scores[:i]), brute_segments(scores[j:])
    return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in right]


def test_segments_equal_the_definition():
    rng = random.Random(5)
    for _ in range(400):
        spots = sorted(rng.sample(range(14), rng.randint(0, 8)))
        values = [(i, round(rng.uniform(0.3, 3), 3)) for i in spots]
        line = [-0.7] * 14
        for i, s in values:
            line[i] = s
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(values, 0.7)]
        assert got == [(a, b, round(s, 6)) for a, b, s in brute_segments(line)]


def test_toxic_held_out_rows(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(500):
        text = [rng.choice(words) for _ in range(rng.randint(20, 300))]
        if i % 5 == 0:
            for _ in range(rng.randint(2, 4)):
                text.insert(rng.randrange(len(text)), "zzvile" + rng.choice(["", "st", "ly", "ness", "dom"]))
        rows.append((" ".join(text), int(i % 5 == 0)))
    docs, labels = corpus(spark, rows)
    model = toxicity.train(docs, labels)
    assert accuracy(toxicity.score(docs, model), rows, 0.3) > 0.97
    assert model.score("zzvilehood and zzvileful")[0] > 0.5  # new words with a known beginning
    found = {r.doc_id for r in toxicity.passages(docs, model).collect()}
    assert {i for i in range(0, 500, 5)} <= found
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert kept == {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.3}


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(7)
    size = 40 + quality_fm.STATS * quality_fm.BINS
    model = quality_fm.Model(np.sort(rng.normal(size=(quality_fm.STATS, 7)), axis=1), 0.3, rng.normal(size=size) / 9, rng.normal(size=(size, 8)) / 9)
    places, weights, stats = np.array([3, 9, 33]), rng.normal(size=3), rng.normal(size=quality_fm.STATS)
    i, x = model.rows(places, weights, stats)
    pairs = sum(model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b] for a, b in itertools.combinations(range(len(i)), 2))
    assert model.score(places, weights, stats) == pytest.approx(1 / (1 + np.exp(-(0.3 + model.linear[i] @ x + pairs))))


def test_quality_held_out_rows(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(500):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        rows.append((" ".join(f"{w}#%" if i % 4 == 0 else w for w in text), int(i % 4 > 0)))
    docs, labels = corpus(spark, rows)
    model = quality_fm.train(docs, labels)
    assert accuracy(quality_fm.score(docs, model), rows, 0.7) > 0.97
    kept = {r.doc_id for r in quality_fm.with_quality(docs, model).collect()}
    assert kept == {r.doc_id for r in quality_fm.score(docs, model).collect() if r.score >= 0.7}


def test_awkward_empty_and_unlabelled(spark):
    rows = [(t or "", int(i % 3 == 0)) for i, (_, t) in enumerate(AWKWARD * 10)]
    docs, labels = corpus(spark, rows)
    nothing = empty(spark, "doc_id long, quality int, toxic int")
    for module, column, without in ((toxicity, "toxic", 0), (quality_fm, "quality", 1)):
        for given in (labels, nothing):
            scores = [r.score for r in module.score(awkward(spark), module.train(docs, given)).collect()]
            assert len(scores) == len(AWKWARD) and all(0 <= s <= 1 for s in scores)
        assert all(round(s) == without for s in scores)
        assert module.score(empty(spark), module.train(empty(spark), nothing)).count() == 0
        one = labels.selectExpr("doc_id", "1 AS quality", "1 AS toxic")
        assert all(r.score > 0.9 for r in module.score(docs, module.train(docs, one)).collect()), column


def test_metadata_tells_texts_apart(spark):
    rng = random.Random(12)
    rows, docs = [], []
    for i in range(900):
        text = " ".join(rng.choice(["some", "words", "that", "say", "nothing"]) for _ in range(rng.randint(20, 60)))
        rows.append((text, int(i % 3 == 0)))
        docs.append((i, text, [len(text), len(text) // 3, None][i % 3]))  # cut off or not stated: of low quality
    given = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    _, labels = corpus(spark, rows)
    model = quality_fm.train(given, labels)
    scores = quality_fm.score(given, model)
    assert accuracy(scores, rows, 0.7) > 0.97
    assert {r.doc_id for r in quality_fm.with_quality(given, model).collect()} == {r.doc_id for r in scores.collect() if r.score >= 0.7}
    assert quality_fm.score(given.drop("n_chars"), model).filter("score >= 0.7").count() == 0
