"""DataFrame operators on small fixtures, many against brute force."""

from __future__ import annotations

import datetime as dt
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from caseloom.functions.codes import Domain
from caseloom.models import core
from caseloom.operators import bitmaps, capacity, delta, explode, forms, graph, incremental, layout, linked, matching, outbound, skew, timeline
from caseloom.sources import features


@contextmanager
def settings(spark, values):
    """SQL settings for a while."""
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(f"spark.sql.{k}", v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("heavy", [3, 1_000_000])
def test_skew_join_equals_plain_join(spark, heavy, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", heavy)
    rng = random.Random(1)
    left = spark.createDataFrame([(i, rng.choice([1, 1, 1, 2, 3, None, None])) for i in range(200)], "id int, k int")
    right = spark.createDataFrame([(1, "a"), (2, None), (9, "z")], "k int, v string")
    for how in ("left", "inner"):
        ours = skew.skew_join(left, right, ["k"], ["id"], how=how)
        plain = left.join(right, "k", how).select(ours.columns)
        assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


@pytest.mark.parametrize("heavy", [3, 1_000_000])
def test_attach_group_treats_null_as_a_group(spark, heavy, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", heavy)
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(30)], "id int, k int")
    got = skew.attach_group(df, ["k"], {"m": F.min("id"), "n": F.count("*")}, ["id"])
    expected = {None: (0, 10), 0: (2, 10), 1: (1, 10)}
    assert all((r["m"], r["n"]) == expected[r["k"]] for r in got.collect()) and got.count() == 30


def test_key_statistics_of_a_table_while_it_is_written(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 20)
    df = spark.range(200).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"), (F.col("id") % 50).alias("v"))
    stored, known = skew.stored_with_statistics(df, "counted", ["k"], ["v"], ["k", "v"])
    assert known == skew.key_statistics(df, ["k"], ["v"], ["k", "v"]) and stored.count() == 200
    every = {r[0] for r in df.select(skew.key_hash("k")).distinct().collect()}
    assert set(known.heavy[("k",)]) == every and len(every) == 4 and not known.heavy[("v",)] and not known.heavy[("k", "v")]
    right = spark.createDataFrame([(1, "a"), (None, "n"), (3, "c")], "k long, w string")
    ours = skew.skew_join(stored, right, ["k"], ["id"], count_on=known)
    plain = df.join(right, "k", "left").select(ours.columns)
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()
    assert skew.key_statistics(df.limit(0), ["k"]).heavy == {("k",): []}


def test_block_join_splits_a_hot_key(spark, monkeypatch):
    left = spark.range(3_000).select(F.when(F.col("id") < 2_000, 0).otherwise(F.col("id") % 90).alias("k"), F.col("id").alias("x"))
    right = spark.range(2_000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 90).alias("k"), F.col("id").alias("y"))
    plain = left.join(right, "k")
    whole = lambda df: tuple(df.agg(F.count("*"), F.sum(F.hash("k", "x", "y").cast("decimal(38,0)"))).first())
    assert whole(skew.block_join(left, right, ["k"], "x", "y")) == whole(plain)
    met = skew.block_join(left, right, ["k"], "x", "y", block_rows=100)
    assert whole(met) == whole(plain) and met.columns == ["k", "x", "y"]
    plainly = {"adaptive.coalescePartitions.enabled": "false", "adaptive.skewJoin.enabled": "false", "shuffle.partitions": "32", "autoBroadcastJoinThreshold": "-1"}
    with settings(spark, plainly):
        tasks = skew.block_join(left, right, ["k"], "x", "y", block_rows=100).groupBy(F.spark_partition_id()).count().collect()
    shares = [r["count"] for r in tasks]
    assert max(shares) < 0.15 * sum(shares) and len(shares) == 32
    nulls = spark.createDataFrame([(None, 1), (1, 2)], "k long, x long")
    assert skew.block_join(nulls, nulls.toDF("k", "y"), ["k"], "x", "y", block_rows=1).count() == 1


def test_similar_names_with_one_word_in_a_hundred_thousand_of_them(spark):
    names = spark.range(100_000).select(F.lit("k").alias("b"), F.concat(F.lit("silva "), F.conv((F.col("id") * 7919 % 1_000_003 * 1_000_003).cast("string"), 10, 36)).alias("v"))
    names = names.union(spark.createDataFrame([("k", "silva"), ("k", "silva silva")], names.schema))
    found = matching.similar_values(names, "b", "v", edit_max=0, cont_min=0.8)
    # the lone word is contained in every name
    assert found.filter("value_a = 'silva' or value_b = 'silva'").count() == 100_001


def test_best_row_and_numbers(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 5, "a"), (2, 3, "b"), (2, 3, "c")], "k int, d int, v string")
    assert rows(skew.best_row(df, ["k"], [F.col("d"), F.col("v")])) == [(1, 5, "a"), (2, 3, "c")]
    sparse = [i * 7 for i in range(50)] + [10**12 * i for i in range(1, 51)]
    for ranges in (None, 7):
        numbered = skew.number_rows(spark.createDataFrame([(i,) for i in sparse], "id long"), "id", "no", ranges)
        assert rows(numbered) == [(x, i + 1) for i, x in enumerate(sparse)]


def test_explode_codes(spark):
    df = spark.createDataFrame([(1, "1, 9,,43"), (2, "N"), (3, " n "), (4, ""), (5, None), (6, "8")], "id int, c string")
    got = explode.explode_codes(df, ["id"], "c", Domain({"1": "one", "9": "nine"}))
    assert sorted((r["id"], r["code"], r["label"] or "") for r in got.collect()) == [(1, "1", "one"), (1, "43", ""), (1, "9", "nine"), (6, "8", "")]


def test_explode_shared(spark):
    df = spark.createDataFrame([(1, 7, "007,12,,7, 12,x"), (2, None, "5"), (3, 8, None)], "id int, p long, s string")
    got = [(r["id"], r["p"], r["is_main"]) for r in explode.explode_shared(df, "p", "s").collect()]
    assert sorted(got, key=str) == sorted([(1, 7, True), (1, 12, False), (2, None, True), (2, 5, False), (3, 8, True)], key=str)


def test_explode_id_list(spark):
    df = spark.createDataFrame([(1, "(1,,x)"), (2, "()"), (3, ""), (4, None), (5, "(2, 2,3)")], "id int, l string")
    assert rows(explode.explode_id_list(df, "l", "p").select("id", "p")) == [(1, 1), (5, 2), (5, 3)]


def test_explode_days_counts_sum_of_lengths(spark):
    day = dt.date
    df = spark.createDataFrame(
        [
            (1, day(2024, 1, 1), day(2024, 1, 1)),
            (2, day(2024, 1, 1), None),
            (3, day(2024, 1, 5), day(2024, 1, 2)),
            (4, day(2024, 2, 1), None),
            (5, day(2024, 1, 3), day(2024, 3, 1)),
        ],
        "id int, a date, b date",
    )
    got = explode.explode_days(df, "a", "b", "2024-01-10").groupBy("id").count()
    assert rows(got) == [(1, 1), (2, 10), (5, 8)]


def test_nest_children_splits_large_groups(spark):
    df = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 5)], "k int, c int")
    nested = explode.nest_children(df, ["k"], ["c"], ["c"], part_rows=10)
    assert nested.filter("k = 1").count() > 5
    assert nested.agg(F.max(F.size("items"))).first()[0] < 40
    assert rows(nested.select("k", F.explode("items").alias("i")).select("k", "i.c")) == sorted([(1, i) for i in range(100)] + [(2, 5)])


NOTE = "<h3>{t}</h3><p>Day: <b>{d}</b><br>Kinds <b>a, ,b</b>Done: <b>Sim</b><br>Empty: <b></b>No: <b> 12 </b></p>\n<h3>OBSERVAÇÕES</h3> free\ntext"


def test_html_fields(spark):
    df = spark.createDataFrame(
        [(1, NOTE.format(t="T", d="undefined")), (2, "<h3>T</h3> <b>x</b>"), (3, "plain"), (4, "<p><b>v</b><b>w</b></p>")], "id int, n string"
    )
    got = forms.html_fields(df, ["id"], "n").collect()
    assert [(r["label"], r["value"]) for r in got if r["id"] == 1] == [
        ("Day", "undefined"), ("Kinds", "a, ,b"), ("Done", "Sim"), ("Empty", ""), ("No", "12"),
    ]
    assert {r["remarks"] for r in got if r["id"] == 1} == {"free\ntext"}
    assert [(r["label"], r["value"]) for r in got if r["id"] == 4] == [("", "w")]
    assert {r["id"] for r in got} == {1, 4}


def test_extract_form_latest_and_ties(spark):
    day = dt.date
    data = [
        (1, day(2024, 1, 1), NOTE.format(t="T", d="01/01/2024")),
        (1, day(2024, 2, 1), NOTE.format(t="T", d="05/01/2024")),
        (1, day(2024, 2, 1), NOTE.format(t="T", d="07/01/2024")),
        (1, day(2024, 3, 1), NOTE.format(t="Other", d="09/01/2024")),
        (None, day(2024, 1, 1), NOTE.format(t="T", d="01/01/2024")),
    ]
    df = spark.createDataFrame(data, "k int, at date, n string")
    fields = [
        forms.Field("%Day%", "day", "date"), forms.Field("%Kinds%", "kinds", "array"), forms.Field("%Done%", "done", "boolean"),
        forms.Field("%No", "no", "number"), forms.Field("%Missing%", "missing", "exists"), forms.Field("%Day%", "days", "array_agg"),
    ]
    got = forms.extract_form(df, ["k"], "n", "T", fields, ["at"], "has").collect()
    assert [tuple(r) for r in got] == [(1, True, day(2024, 1, 7), ["a", "b"], True, 12, False, ["05/01/2024", "07/01/2024"])]


def test_extract_forms_in_one_pass(spark):
    data = [(1, NOTE.format(t="T", d="a")), (1, NOTE.format(t="U", d="b")), (2, NOTE.format(t="U", d="c")), (3, NOTE.format(t="V", d="d"))]
    df = spark.createDataFrame(data, "k int, n string")
    wanted = {"T": [forms.Field("%Day%", "t_day"), forms.Field("%Missing%", "t_missing", "exists")], "U": [forms.Field("%Day%", "u_day")]}
    got = forms.extract_forms(df, ["k"], "n", wanted)
    assert sorted(map(tuple, got.collect())) == [(1, "a", False, "b"), (2, None, None, "c")]


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2030)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    df = spark.createDataFrame(edges, "a int, b int")
    got = dict(rows(graph.connected_components(df, "a", "b")))
    assert got == union_find(nodes, [e for e in edges if e[0] != e[1]])


def edit_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def alike(a, b):
    x, y = a.split(" "), b.split(" ")
    return edit_distance(a, b) <= 2 or len(set(x) & set(y)) / min(len(x), len(y)) >= 0.8


def test_similar_values_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["ana", "ane", "maria", "mario", "jo", "joao", "silva", "silvia", "souza", "li", "a"]
    names = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(160)}
    names |= {n[:-1] for n in sorted(names)[:40] if len(n) > 2} | {"x", "xy", "xyz", "zzzz"}
    names = sorted({n.strip() for n in names} - {""})
    blocked = [(rng.choice("pq"), n) for n in names]
    df = spark.createDataFrame(blocked, "blk string, v string")
    expected = sorted((p, a, b) for p, a in blocked for q, b in blocked if a < b and p == q and alike(a, b))
    assert rows(matching.similar_values(df, "blk", "v")) == expected and len(expected) > 50


def test_fuzzy_dedup_follows_chains_and_skips_empty_names(spark):
    people = [
        (1, "maria silva", "ana souza"), (2, "maria silvaa", "ana souza"), (3, "maria silvaaaa", "ana souza"),
        (4, "maria silva", "rita lima"), (5, "", ""), (6, "", ""), (7, "maria silva", "ana souza"),
    ]
    df = spark.createDataFrame(people, "id int, a string, b string")
    whole = {r["id"]: r["cluster_id"] for r in matching.fuzzy_dedup(df, "id", "a", "b", matching.FuzzyRule(2, 1.0)).collect()}
    assert whole == {1: 1, 2: 1, 3: 1, 7: 1, 4: 4, 5: 5, 6: 6}
    hop = {r["id"]: r["cluster_id"] for r in matching.fuzzy_dedup(df, "id", "a", "b", matching.FuzzyRule(2, 1.0), mode="one_hop").collect()}
    assert hop == {1: 1, 2: 1, 3: 2, 7: 1, 4: 4, 5: 5, 6: 6}


def test_exact_rules(spark):
    day = dt.date(2000, 1, 1)
    people = [
        (1, 2020, "12345678901", "A", "M", "", day), (2, 2020, "12345678901", "B", "N", "", None), (3, 2021, "12345678901", "A", "M", "", day),
        (4, 2020, "99999999999", "X", "", "", None), (5, 2020, "99999999999", "Y", "", "", None), (6, 2020, "", "B", "N", "", None),
    ]
    df = spark.createDataFrame(people, "id int, yr int, doc string, nm string, mo string, fa string, born date")
    rules = matching.person_rules("doc", "nm", "mo", "fa", "born")
    got = {r["id"]: (r["cluster_id"], r["cluster_size"], r["is_duplicate"]) for r in matching.exact_rule_dedup(df, "id", rules, ["yr"]).collect()}
    assert got == {1: (1, 3, False), 2: (1, 3, True), 6: (1, 3, True), 3: (3, 1, False), 4: (4, 1, False), 5: (5, 1, False)}


def test_layout_versions(spark):
    base = ["P", "202502", "", "", "fam", *[""] * 7, '"1234,50"', *[""] * 11, "w", "10,5", "", "3", "20250131"]
    old = base + [""] * (34 - len(base))
    new = old[:25] + ["extra"] + old[25:]
    short = "P;209913"
    df = spark.createDataFrame([(1, ";".join(old)), (2, ";".join(new)), (3, short), (4, "  ")], "id int, line string")
    positions = [
        layout.Position("month", 1, "month"), layout.Position("value", 12, "decimal"), layout.Position("income", 25, "decimal"),
        layout.Position("people", 27, "integer"), layout.Position("updated", 28, "date"),
    ]
    got = {r["id"]: r for r in layout.parse_layout(df, "line", positions, {35: 25}).collect()}
    assert set(got) == {1, 2, 3}
    for n in (1, 2):
        r = got[n]
        assert (r["month"], float(r["value"]), float(r["income"]), r["people"], r["updated"]) == (dt.date(2025, 2, 1), 1234.5, 10.5, 3, dt.date(2025, 1, 31))
    assert got[3]["month"] is None and got[3]["value"] is None


def test_family_bands(spark):
    df = spark.createDataFrame([(1, "f", 300.0), (2, "f", 74.0), (3, "g", 376.0), (4, "h", None)], "id int, fam string, v double")
    got = {r["id"]: r["family_band"] for r in layout.family_bands(df, ["fam"], "v", ["id"]).collect()}
    assert got == {1: "ate 374", 2: "ate 374", 3: "375 a 600", 4: "acima de 1350"}


def test_capacity(spark):
    df = spark.createDataFrame([(1, "S", 9, 3, None, 1), (2, "N", 9, 3, 4, None), (3, None, None, 3, 4, 2)], "u int, m string, beds int, men int, women int, blk int")
    got = capacity.unify_capacity(df, F.col("m") == "S", ["men", "women"], "beds", ["blk"])
    assert rows(got.select("u", "total_places", "available_places")) == [(1, 3, 2), (2, 9, 9), (3, 0, -2)]


def test_changed_rows_and_log(spark):
    old = spark.createDataFrame([("1", "a", "None"), ("2", "b", "x"), ("3", None, "")], "id string, p string, q string")
    new = spark.createDataFrame([(1, "a", None), (2, "c", None), (3, None, "None")], "id long, p string, q string")
    assert rows(delta.changed_rows(new, old, "id", ["p", "q"]).select("id")) == [(2,)]
    log = delta.change_log(new, old, "id", ["p", "q"], "t").collect()
    assert sorted((r["column_name"], r["old_value"], r["new_value"]) for r in log) == [("p", "b", "c"), ("q", "x", None)]
    assert delta.changed_rows(old, old, "id", ["p", "q"]).isEmpty()


def test_leavers(spark):
    history = spark.createDataFrame([(1, 1), (1, 3), (2, 2), (3, 3)], "id int, part int")
    known = spark.createDataFrame([(1,), (2,), (9,)], "id int")
    assert sorted(map(tuple, delta.leavers(known, history, "id", "part").collect()), key=str) == sorted([(2, 2), (9, None)], key=str)
    assert rows(delta.new_entrants(history.filter("part = 3"), known, "id")) == [(3, 3)]


def test_merge_matches_null_keys(spark):
    old = spark.createDataFrame([(1, None, "old"), (2, "x", "old")], "a int, b string, v string")
    new = spark.createDataFrame([(1, None, "new"), (3, None, "new")], "a int, b string, v string")
    got = incremental.merge_by_key(old, new, ["a", "b"])
    assert sorted((r["a"], r["v"]) for r in got.collect()) == [(1, "new"), (2, "old"), (3, "new")]


def test_merge_rejects_repeated_keys(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    for old in (spark.createDataFrame([(2, "x")], "k int, v string"), incremental.empty_like(spark, twice)):
        with pytest.raises(Exception, match="repeat a key"):
            incremental.merge_by_key(old, twice, ["k"]).collect()


def test_snapshot_is_not_repeated(spark):
    day = dt.date(2024, 1, 1)
    snap = spark.createDataFrame([(day, "a"), (day, None)], "s date, k string")
    first = incremental.append_snapshot(incremental.empty_like(spark, snap), snap, "s", ["k", "s"])
    assert incremental.append_snapshot(first, snap, "s", ["k", "s"]).count() == 2


def test_scd2(spark):
    none = spark.createDataFrame([], "k int, v string, valid_from date, valid_to date")
    day = lambda n: F.lit(f"2024-01-0{n}").cast("date")
    snap = lambda data: spark.createDataFrame(data, "k int, v string")
    history = incremental.scd2_next(none, snap([(1, "a"), (2, None)]), "k", ["v"], day(1))
    history = incremental.scd2_next(history, snap([(1, "b"), (2, None), (3, "c")]), "k", ["v"], day(2))
    history = incremental.scd2_next(history, snap([(3, "c")]), "k", ["v"], day(3))
    got = sorted(((r["k"], r["v"], str(r["valid_from"])[-1], str(r["valid_to"])[-1] if r["valid_to"] else None) for r in history.collect()), key=str)
    assert got == sorted([(1, "a", "1", "2"), (1, "b", "2", "3"), (2, None, "1", "3"), (3, "c", "2", None)], key=str)


def test_propagation_is_forward_only(spark):
    cards = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, "own"), ("b", 1, None)], "k string, m int, v string")
    firsts = spark.createDataFrame([("a", 2, "first")], "k string, fm int, fv string")
    got = timeline.propagate_forward(cards, firsts, "k", "m", "fm", {"v": "fv"})
    assert sorted((r["k"], r["m"], r["v"] or "", r["reached"]) for r in got.collect()) == [
        ("a", 1, "", False), ("a", 2, "first", True), ("a", 3, "own", True), ("b", 1, "", False),
    ]


def test_outbound_batches(spark):
    df = spark.createDataFrame([(i, "None" if i == 0 else "x", "2024-01-02") for i in range(250)], "objectid int, a string, d string")
    got = outbound.update_batches(df, "objectid", ["a", "d"], ["d"])
    assert rows(got.groupBy("batch").count()) == [(0, 100), (1, 100), (2, 50)]
    assert got.filter("objectid = 0").first()["payload"] == '{"attributes":{"objectid":0,"a":null,"d":1704153600000}}'
    texts = spark.createDataFrame([(1, "nan", " 2024-01-02 "), (2, "2024-01-02", "soon"), (3, "y", None)], "k int, a string, d string")
    assert [r["payload"] for r in outbound.update_batches(texts, "k", ["a", "d"], ["d"]).orderBy("k").collect()] == [
        '{"attributes":{"k":1,"a":null,"d":1704153600000}}',
        '{"attributes":{"k":2,"a":"2024-01-02","d":"soon"}}',
        '{"attributes":{"k":3,"a":"y","d":null}}',
    ]


def test_occupancy_by_day_equals_listing_every_day(spark):
    rng = random.Random(8)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    stays = [(rng.choice(["a", "b", None]), day(rng.randint(0, 30)), rng.choice([None, day(rng.randint(0, 45))]), rng.randint(-1, 2)) for _ in range(120)]
    stays += [("c", None, day(3), 1), ("d", day(90), None, 1), ("e", day(5), day(4), 1)]  # no start, after as_of, ends before it begins
    df = spark.createDataFrame(stays, "k string, s date, e date, w int")
    got = timeline.occupancy_by_day(df, ["k"], "s", "e", str(day(40)), {"n": F.lit(1), "w": F.col("w")})
    wanted = {}
    for k, s, e, w in stays:
        last = min(e or day(40), day(40))
        while s is not None and s <= last:
            n, total = wanted.get((k, s), (0, 0))
            wanted[k, s] = (n + 1, total + w)
            s += dt.timedelta(1)
    assert {(r["k"], r["ref_date"]): (r["n"], r["w"]) for r in got.collect()} == wanted
    years = timeline.days_by_year(df, "s", "e", str(day(40)))
    assert years.agg(F.sum("n_days")).first()[0] == sum(n for n, _ in wanted.values())
    long = spark.createDataFrame([(dt.date(2022, 12, 30), dt.date(2024, 1, 2))], "s date, e date")
    spans = timeline.days_by_year(long, "s", "e", "2025-01-01").select("yr", "n_days", F.col("last_day").cast("string"))
    assert rows(spans) == [(2022, 2, "2022-12-31"), (2023, 365, "2023-12-31"), (2024, 2, "2024-01-02")]


def test_bitmaps_of_months_give_distinct_ids_of_any_span(spark):
    rng = random.Random(9)
    seen = [(rng.randint(1, 6), rng.choice([None, -70_000, 5, 32_768, *range(200), 1 << 40]), rng.random() < 0.3) for _ in range(3_000)]
    df = spark.createDataFrame(seen, "m int, id long, t boolean")
    months = bitmaps.id_bitmaps(df, ["m"], "id", {"all": F.lit(True), "some": F.col("t")})
    assert months.count() <= 6 * 5
    half = bitmaps.merged_bitmaps(months.withColumn("h", F.col("m") > 3), ["h"], ["all", "some"])
    count = lambda test: (len({i for m, i, t in seen if test(m) and i is not None}), len({i for m, i, t in seen if test(m) and t and i is not None}))
    got = {r["h"]: (r["all"], r["some"]) for r in bitmaps.id_counts(half, ["h"], ["all", "some"]).collect()}
    assert got == {False: count(lambda m: m <= 3), True: count(lambda m: m > 3)}
    assert {r["m"]: r["all"] for r in bitmaps.id_counts(months, ["m"], ["all"]).collect()} == {n: count(lambda m: m == n)[0] for n in range(1, 7)}  # noqa: B023


def test_pivot_forms_equals_one_form_at_a_time(spark):
    note = lambda title, **fields: f"<h3>{title}</h3><p>" + "".join(f"{k}: <b>{v}</b><br>" for k, v in fields.items()) + "</p>"
    data = [
        (1, 1, 1, note("A", Name="x", Tag="p")), (1, 2, 1, note("A", Name="y", Tag="q")), (1, 3, 2, note("A", Name="z")), (1, 4, 1, note("B", Size="7")),
        (2, 1, 1, note("B", Size="8")), (3, 1, 2, note("A", Name="n")), (4, 1, 1, note("C", Name="n")), (None, 1, 1, note("A", Name="n")), (5, 1, 1, None),
    ]
    df = spark.createDataFrame(data, "k int, n int, scope int, note string")
    name, tags, size = [forms.Field("Name", "name"), forms.Field("Name", "names", "array")], [forms.Field("Tag", "tags", "array_agg")], [forms.Field("Size", "size", "number")]
    wanted = [forms.Form("A", name, F.col("scope") == 1, latest=True, flag="a"), forms.Form("A", tags), forms.Form("B", size, latest=True, flag="b")]
    got = {r["k"]: tuple(r)[1:] for r in forms.pivot_forms(df, ["k"], "note", wanted, ["n"]).collect()}
    assert got == {1: (True, True, "y", ["y"], ["p", "q"], 7), 2: (False, True, None, None, None, 8), 3: (False, False, None, None, [], None)}
    first = forms.extract_form(df.filter("scope = 1"), ["k"], "note", "A", name, ["n"])
    assert {r["k"]: (r["name"], r["names"]) for r in first.collect()} == {k: v[2:4] for k, v in got.items() if v[0]}


def test_collected_geometries_of_a_key_with_many_shapes_come_in_parts(spark):
    df = spark.range(500).select((F.col("id") % 100 == 99).cast("int").alias("k"), F.concat(F.lit("POINT ("), (F.col("id") % 250).cast("string"), F.lit(")")).alias("g"))
    parts = features.collect_geometries(df, ["k"], "g", part_shapes=40).collect()
    assert len([r for r in parts if r["k"] == 0]) > 4 and all(r["n_shapes"] < 90 for r in parts)
    shapes = lambda k: [s for r in parts if r["k"] == k for s in r["geometry"][len("GEOMETRYCOLLECTION ("):-1].split(", ")]
    for k in (0, 1):
        wanted = {r["g"] for r in df.filter(F.col("k") == k).collect()}
        assert len(shapes(k)) == len(wanted) and set(shapes(k)) == wanted


def test_components_kept_between_loads_equal_those_of_one_load(spark, tmp_path):
    rng = random.Random(10)
    path = tmp_path / "links"
    groups = lambda df: {r["node"]: r["component"] for r in df.collect()}
    so_far = []
    for load in range(5):
        low = 200 - 40 * load  # later loads bring smaller ids, so components change their least node
        new = [(rng.randint(low, low + 120), rng.randint(low, low + 120)) for _ in range(25)] + [(7, 7), (None, 3)]
        so_far += new
        frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
        for _ in range(2 if load == 3 else 1):
            linked.add_edges(frame(new), "a", "b", str(path), buckets=8)
        every = [p for p in so_far if None not in p and p[0] != p[1]]
        wanted = groups(graph.connected_components(frame(every), "a", "b"))
        assert groups(linked.components_so_far(spark, str(path), frame(new).schema["a"].dataType)) == wanted


def test_rows_of_a_later_load_join_only_their_own_buckets(spark, tmp_path):
    path, rules = tmp_path / "links", [matching.KeyRule(["doc"], F.col("doc") != ""), matching.KeyRule(["name"], F.col("name").isNotNull())]
    load = lambda values: spark.createDataFrame(values, "id long, doc string, name string")
    first = [(i, f"d{i // 2}", f"n{i}") for i in range(10, 210)]
    linked.add_rows(load(first), "id", rules, str(path), buckets=32)
    before = {p.relative_to(path): p.read_bytes() for p in path.rglob("*.parquet")}
    second = [(5, "d6", "n99"), (6, "", None), (300, "new", None), (301, "new", "n99")]
    linked.add_rows(load(second), "id", rules, str(path), buckets=32)
    got = {r["id"]: (r["cluster_id"], r["cluster_size"]) for r in linked.stored_clusters(load(first + second), "id", str(path)).collect()}
    wanted = {r["id"]: (r["cluster_id"], r["cluster_size"]) for r in matching.exact_rule_dedup(load(first + second), "id", rules).collect()}
    assert got == wanted and got[301] == (5, 7) and got[6] == (6, 1)
    after = {p.relative_to(path): p.read_bytes() for p in path.rglob("*.parquet")}
    nodes = [p for p in before if p.parts[0] == "nodes"]
    assert sum(after.get(p) == before[p] for p in nodes) > len(nodes) - 5


def test_projects_of_persons_are_merged_without_listing_them(spark, monkeypatch):
    monkeypatch.setattr(core, "FAMILIES_A_TASK", 40)
    rng = random.Random(3)
    day = lambda: rng.choice([None, *[dt.date(2020, 1, d) for d in (1, 2, 3)]])
    members = [(rng.choice([None, *range(90)]), rng.choice([None, *range(25)]), rng.choice([None, None, dt.date(2021, 1, 1)])) for _ in range(300)]
    held = [(rng.choice([None, *range(20)]), rng.choice([None, *range(6)]), rng.random() < 0.5, day(), rng.choice([None, 1, 2])) for _ in range(250)]
    people = spark.createDataFrame(members, "person_id int, family_id int, left_on date")
    projects = spark.createDataFrame(held, "family_id int, project_id int, is_active boolean, registered date, unit_id int")
    items = core.family_items(projects, ["project_id", "is_active"], ["registered", "unit_id"], "projects")
    merged = core.person_projects(people, items)
    got = {r["person_id"]: [(p["project_id"], p["registered"], p["unit_id"], p["is_active"]) for p in r["projects"]] for r in merged.collect()}
    order = lambda values: tuple((v is not None, v or 0 if not isinstance(v, dt.date) else v.toordinal()) for v in values)
    wanted = {}
    for person, family in {m[:2] for m in members if m[1] is not None and m[2] is None}:
        for f, project, active, registered, unit in held:
            if f == family:
                best = wanted.setdefault(person, {})
                best[project] = max(best.get(project, (registered, unit, active)), (registered, unit, active), key=order)
    assert got == {p: [(k, *best[k]) for k in sorted(best, key=lambda k: order((k,)))] for p, best in wanted.items()}
    assert "Generate" not in merged._jdf.queryExecution().toString()


def test_statistics_and_keys_of_a_stored_table_do_not_pass_the_driver(spark, tmp_path, monkeypatch):
    spark.range(400_000).select(F.col("id").alias("person_id")).write.parquet(str(tmp_path / "persons"))
    persons = spark.read.parquet(str(tmp_path / "persons")).withColumn("person_sk", F.md5(F.col("person_id").cast("string")))
    monkeypatch.setattr(type(persons), "observe", None)
    stored, known = skew.stored_with_statistics(spark.range(50).withColumnRenamed("id", "person_id"), "counted", ["person_id"])
    # a file of 2 MB, of which 16 MB of keys are made
    joined = skew.skew_join(stored, core.person_keys(persons), ["person_id"], ["person_id"], count_on=known)
    assert joined.count() == 50 and "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_key_implied_by_a_shorter_one_is_left_out(spark):
    born = dt.date(2000, 1, 1)
    data = [(1, "12345678901", "n", "m", "f", born), (2, "99999999999", "n", "m", "f", born), (3, "1", "n", "", "f", None), (4, None, "n", "m", "f", born)]
    df = spark.createDataFrame(data, "id int, doc string, nm string, mo string, fa string, born date")
    keys = matching.rule_keys(df, "id", matching.person_rules("doc", "nm", "mo", "fa", "born"))
    found = {i: sorted(r["rule"] for r in keys.filter(F.col("id") == i).collect()) for i in range(1, 5)}
    assert found == {1: [0, 1, 4], 2: [1, 2, 3, 4, 5], 3: [], 4: [1, 4]}


def test_leaves_take_no_part_in_the_rounds_of_components(spark, monkeypatch):
    sizes, written = [], graph._written
    monkeypatch.setattr(graph, "_written", lambda edges: sizes.append((found := written(edges))[2][0]) or found)
    stars = [(hub, hub + i) for hub in range(0, 5_000, 1_000) for i in range(1, 200)] + [(0, 1_000), (2_000, 2_001)]
    got = dict(rows(graph.connected_components(spark.createDataFrame(stars, "a int, b int"), "a", "b")))
    assert got == union_find({n for e in stars for n in e}, stars)
    assert sizes[0] == len(stars) and max(sizes[1:]) <= 1
