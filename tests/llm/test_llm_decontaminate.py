from __future__ import annotations

import random

import pytest
from llm_frames import AWKWARD, awkward, empty

from caseloom.llm import decontaminate
from caseloom.llm.common import WordHashes


def score(a, b):
    """Smith-Waterman by the full recurrence."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_equals_the_recurrence():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randint(0, 4) for _ in range(rng.randint(1, 15))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(1, 25))]
        assert decontaminate.align(a, b)[0] == score(a, b)


def test_copies_are_found_and_clean_documents_left(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "bcdfghjkl" for b in "aeiou"] * 3 + [f"term{i}" for i in range(400)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = {i: text(35) for i in range(8)}
    docs, planted = [], set()
    for d in range(300):
        body = text(200)
        if d % 6 == 0:
            copy = list(items[d % 8])
            for _ in range(d % 5):  # words changed, left out and put in
                k = rng.randrange(len(copy))
                copy[k : k + 1] = rng.choice([[], ["new"], [copy[k], "more"]])
            body[50:50] = copy
            planted.add((d, d % 8))
        docs.append((d, " ".join(body).title()))
    docs += [(900 + i, " ".join(items[7])) for i in range(200)]  # an item that many documents hold
    planted |= {(900 + i, 7) for i in range(200)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(70, None), (71, "")], "item_id long, text string")
    whole = decontaminate.contaminated(frame, bench)
    assert {(r.doc_id, r.item_id) for r in whole.collect()} == planted
    exact = [r for r in whole.collect() if r.doc_id == 0]
    assert exact and (exact[0].first_word, exact[0].end_word, exact[0].score) == (50, 85, 1.0)
    blocks = decontaminate.contaminated(frame, bench, block_items=3)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == planted
    assert {r.doc_id for r in decontaminate.decontaminated(frame, bench).collect()} == {d for d, _ in docs} - {d for d, _ in planted}


def test_awkward_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a row without id"), (2, "plain words on a line and another line"), (None, "x y z w")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(awkward(spark), bench).collect()}
    assert found == {(1, 2), (None, 1)}  # the row without id copies an item, too
    left = decontaminate.decontaminated(awkward(spark), bench)
    assert left.columns == ["doc_id", "text", "doc_id", "text"] and left.count() == len(AWKWARD) - 2
    assert decontaminate.decontaminated(empty(spark), bench).count() == 0
    assert decontaminate.decontaminated(awkward(spark), empty(spark, "item_id long, text string")).count() == len(AWKWARD)
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(awkward(spark), empty(spark, "item_id long, text string")).count() == 0


def test_stretches_stay_short_however_often_a_text_repeats_an_item():
    item = [f"w{i}" for i in range(40)]
    text = ["before"] * 100 + item * 500 + item[:20] + ["cut"] * 9 + item[20:] + ["after"] * 100
    hashes = WordHashes()
    found = decontaminate.Seeds([(7, item)]).passages(text, hashes([w.encode() for w in text]))
    assert all(len(words) <= 3 * len(item) + 10 for *_, words, _ in found) and len(found) > 200
    assert [piece for _, piece, *_ in found] == list(range(len(found)))
    covered = set()
    for _, _, first, words, grams in found:
        assert words == text[first : first + len(words)] and grams
        covered.update(range(first, first + len(words)))
    assert covered >= set(range(100, len(text) - 100))


def test_repeated_copies_are_reported_once_each(spark):
    item = [f"w{i}" for i in range(30)]
    text = " ".join(["x"] * 50 + item + ["y"] * 200 + item + item)
    docs = spark.createDataFrame([(1, text), (1, text), (2, " ".join(["z"] * 90))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.end_word) for r in got} >= {(1, 50, 80)} and len(got) == 2 * len(set(got))
    assert all(r.score == 1.0 and r.matched == 30 for r in got if r.first_word in (50, 280, 310))


def test_edited_copies_beside_verbatim_ones_are_found(spark):
    rng = random.Random(5)
    items = {i: [f"i{i}w{j}" for j in range(40)] for i in range(4)}
    docs, planted = [], set()
    for i, item in items.items():
        for step in (None, None, 10, 8, 6, 5, 4):  # two verbatim copies, then 10 to 25% of the words changed
            copy = [f"new{j}" if step and j % step == step - 1 else w for j, w in enumerate(item)]
            planted.add((len(docs), i))
            docs.append((len(docs), " ".join(["x"] * rng.randint(0, 60) + copy + ["y"] * 30)))
        for share in (0.1, 0.2, 0.3):
            gone = set(rng.sample(range(40), int(40 * share)))
            copy = [f"new{j}" if j in gone else w for j, w in enumerate(item)]
            if score(item, copy) >= 40:
                planted.add((len(docs), i))
            docs.append((len(docs), " ".join(copy)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)
    sixth = [r.score for r in got if r.doc_id == 4]
    assert sixth == [score(items[0], docs[4][1].split()) / 80]


def test_every_text_that_reaches_the_score_is_found():
    rng, hashes = random.Random(6), WordHashes()
    reached = 0
    for _ in range(1500):
        item = [rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(rng.randint(3, 24))]
        copy = list(item)
        for _ in range(rng.randint(0, len(item))):
            k = rng.randrange(len(copy)) if copy else 0
            copy[k : k + 1] = rng.choice([[], ["new"], copy[k : k + 1] + ["more"]])
        text = ["x"] * rng.randint(0, 9) + copy + ["y"] * rng.randint(0, 9)
        if score(item, text) >= len(item):
            reached += 1
            found = decontaminate.Seeds([(1, item)]).passages(text, hashes([w.encode() for w in text]))
            assert max(score(item, part) for *_, part, _ in found) == score(item, text)
    assert reached > 500


def test_each_of_several_copies_is_reported(spark):
    item = [f"w{i}" for i in range(30)]
    edited = [f"new{i}" if i % 5 == 4 else w for i, w in enumerate(item)]
    texts = [["x"] * 50 + item + ["y"] * 200 + item + item, item * 60, ["x"] * 7 + item + edited + item + ["y", "z"] + edited]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")).collect()
    spans = lambda doc: sorted((r.first_word, r.end_word) for r in got if r.doc_id == doc)
    assert spans(0) == [(50, 80), (280, 310), (310, 340)]
    assert spans(1) == [(30 * i, 30 * i + 30) for i in range(60)]
    assert spans(2) == [(7, 37), (37, 66), (67, 97), (99, 128)]  # a changed word at the end is no part of a copy


def test_the_smallest_copies_and_items_are_found(spark):
    item = [f"w{i}" for i in range(24)]
    edits = [
        [w if i % 4 else f"new{i}" for i, w in enumerate(item)],  # every fourth word changed
        [w if i % 3 else f"new{i}" for i, w in enumerate(item)],  # every third
        [w for i, w in enumerate(item) if i % 3],  # every third left out
        [x for i, w in enumerate(item) for x in ([w, f"new{i}"] if i % 2 else [w])],  # one put in after every second word
        [x for i, w in enumerate(item) for x in (w, f"new{i}")],  # after every word
    ]
    short = {1: "Solo", 2: "two words", 3: "three words here", 4: ""}
    texts = edits + ["x solo y solo".split(), "two words x".split(), "x three words here".split(), ["nothing"], ["two", "a", "b", "here"]]
    bench = spark.createDataFrame([(0, " ".join(item)), *short.items()], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 1), (5, 1), (6, 2), (7, 3)]
    assert all(r.score == score(item, texts[r.doc_id]) / 48 >= 0.5 for r in got if r.item_id == 0)
    assert {(r.doc_id, r.first_word, r.end_word) for r in got if r.item_id} == {(5, 1, 2), (5, 3, 4), (6, 0, 2), (7, 1, 4)}


@pytest.mark.parametrize("limits", [{}, {"block_items": 1}, {"block_bytes": 200}])
def test_items_and_documents_that_share_an_id_or_have_none(spark, limits):
    """Against the full recurrence of every text with every item text."""
    rng = random.Random(7)
    item = lambda tag: " ".join(f"{tag}{j}" for j in range(25))
    items = [(7, item("a")), (7, item("b")), (7, item("b")), (None, item("c")), (None, item("d")), (8, item("e")), (9, item("e"))]
    bodies = [item(tag) for tag in "abcdefg"] + [" ".join(w for j, w in enumerate(item("b").split()) if j % 6) + " x y z"]
    docs = [(rng.choice([1, 1, 2, 3, None]), f"{'pre ' * rng.randint(0, 5)}{body}") for body in bodies * 2]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    hits = lambda text: {(i, w) for i, w in items if score(w.split(), text.split()) >= 25}
    wanted = sorted(str((d, i)) for d, text in docs for i, _ in hits(text))
    got = decontaminate.contaminated(frame, bench, **limits).collect()
    assert sorted(str((r.doc_id, r.item_id)) for r in got) == wanted
    left = decontaminate.decontaminated(frame, bench, **limits).collect()
    assert sorted(map(str, map(tuple, left))) == sorted(str(d) for d in docs if not hits(d[1])) and left
