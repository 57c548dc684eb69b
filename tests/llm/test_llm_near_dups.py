from __future__ import annotations

import itertools
import random

import pytest
from llm_frames import awkward, empty

from caseloom.llm import near_dups


def brute_force(rows, percent):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        if doc is not None:
            sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {d: d for d in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        union = len(sets[a] | sets[b])
        if union and 100 * len(sets[a] & sets[b]) >= percent * union:
            x, y = root(a), root(b)
            group[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_equal_brute_force(spark, monkeypatch, percent):
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3_000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(140):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 8])):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "A b c"), (504, "a B  c"), (505, "a b"), (None, rows[3][1]), (0, rows[0][1])]
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    expected = brute_force(rows, percent)
    assert len(got) == len(rows) and 20 < len({c for _, c in expected.values()}) < 140
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*expected[r.doc_id], expected[r.doc_id][1] == r.doc_id)


def test_awkward_and_empty_tables(spark):
    got = {r.doc_id: r for r in near_dups.near_duplicates(awkward(spark)).collect()}
    assert got[2].n_shingles == got[3].n_shingles == got[4].n_shingles == 0 and got[7].n_shingles == 1
    assert got[9].component_id == 9 and got[None].component_id is None
    assert near_dups.near_duplicates(empty(spark)).count() == 0


def test_match_threshold_follows_the_similarity():
    assert near_dups.least_matches(32, 85) == 16 and near_dups.least_matches(32, 80) < 16
    assert near_dups.least_matches(32, 100) == 32


def test_an_id_with_several_texts_has_one_result(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(40 * (k + 1), 40 * (k + 3))}" for _ in range(60)) for k in range(6)]
    rows = [(rng.randrange(12), rng.choice(texts) + rng.choice(["", " end"])) for _ in range(60)] + [(3, None), (4, ""), (None, texts[0])]
    schema = "doc_id long, text string"
    hashed = spark.createDataFrame(rows, schema).selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    speaks = {}
    for r in hashed:
        if r.doc_id is not None:
            speaks[r.doc_id] = min(speaks.get(r.doc_id, (r.h, r.text)), (r.h, r.text), key=lambda x: x[0])
    expected = brute_force([(d, t) for d, (_, t) in speaks.items()], 80)
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame(rows[::-1], schema).repartition(5)):
        got = near_dups.near_duplicates(frame, percent=80).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in rows)
        assert all((r.n_shingles, r.component_id) == expected[r.doc_id] for r in got if r.doc_id is not None)
