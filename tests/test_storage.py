"""Sources, sinks, streaming, rules and the model registry."""

from __future__ import annotations

import datetime as dt
import json
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from caseloom.models.registry import Model, Warehouse
from caseloom.operators import incremental, outbound, stored
from caseloom.operators.incremental import latest_partition, overwrite_partitions, partitions_missing
from caseloom.operators.outbound import update_batches
from caseloom.quality import rules
from caseloom.sinks import tables, wap
from caseloom.sources import features, lines
from caseloom.sources import tables as source_tables
from caseloom.streaming import manifest
from caseloom.streaming.ingest import SLOTS, ingest_new_files, ingested_lines, quarantined_files


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_partition_dates(spark):
    names = {
        "BEC.E2.BOD1.F03.C2508.P1466.A3304557.C.ZIP": dt.date(2025, 8, 1),
        "X.C251.A250831.zip": dt.date(2025, 8, 31),
        "X.A9912311.zip": dt.date(1999, 12, 31),
        "X.Axx240230240229.zip": dt.date(2024, 2, 29),
        "X.C2513.zip": None,
        "report.zip": None,
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["d"] for r in df.select("n", lines.partition_date(F.col("n")).alias("d")).collect()}
    assert got == names


def test_line_kinds(spark):
    df = spark.createDataFrame([("1;a",), ('"2";b',), ("H;1",), ("  ",), (None,), ("3",)], "line string")
    kinds = [r[0] for r in df.select(lines.line_kind(F.col("line"))).collect()]
    assert kinds == ["data", "data", "frame", "blank", "blank", "data"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.ZIP", "w") as z:
        z.writestr("x/one.TXT", "1;a\r\n\nH\n")
        z.writestr("two.dat", "2;é")
        z.writestr("skip.pdf", "3;z")
    got = lines.read_archives(spark, str(tmp_path))
    assert rows(got.select("member", "line")) == [("two.dat", "2;é"), ("x/one.TXT", ""), ("x/one.TXT", "1;a"), ("x/one.TXT", "H")]


def test_feature_pages(spark, tmp_path):
    page = {
        "features": [
            {"attributes": {"id": 1, "n": None}, "geometry": {"x": -43.5, "y": -22.5}},
            {"attributes": {"id": 2, "n": "b"}, "geometry": {"rings": [[[0, 0], [4, 0], [4, 4], [0, 4]]]}},
            {"attributes": {"id": 3, "n": "c"}, "geometry": {"paths": [[[0, 0], [200, 2]], [[9, 9]]]}},
            {"attributes": {"id": 4}, "geometry": None},
        ],
        "exceededTransferLimit": False,
    }
    (tmp_path / "p0.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "p1.json").write_text(json.dumps({"features": []}))
    got = features.with_geometry(features.read_feature_pages(spark, str(tmp_path), [{"name": "id"}, {"name": "n"}]))
    by_id = {r["id"]: r for r in got.collect()}
    assert set(by_id) == {"1", "2", "3", "4"} and by_id["1"]["n"] is None
    assert by_id["1"]["geometry"] == "POINT (-43.5 -22.5)" and by_id["1"]["out_of_range"] is False
    assert (by_id["2"]["longitude"], by_id["2"]["latitude"]) == (2.0, 2.0)
    assert by_id["3"]["geometry"].startswith("LINESTRING (0.0 0.0, 200.0 2.0)") and by_id["3"]["longitude"] == 100.0
    assert by_id["4"]["geometry"] is None


def test_truncated_extract_is_an_error(spark, tmp_path):
    feature = {"attributes": {"id": 1}, "geometry": None}
    (tmp_path / "p0.json").write_text(json.dumps({"features": [feature], "exceededTransferLimit": True}))
    with pytest.raises(RuntimeError, match="truncated"):
        features.read_feature_pages(spark, str(tmp_path), [{"name": "id"}])
    (tmp_path / "p1.json").write_text(json.dumps({"features": [feature]}))
    assert features.read_feature_pages(spark, str(tmp_path), [{"name": "id"}]).count() == 2
    (tmp_path / "p2.json").write_text(json.dumps({"features": [], "exceededTransferLimit": True}))
    with pytest.raises(RuntimeError, match="truncated"):
        features.read_feature_pages(spark, str(tmp_path), [{"name": "id"}])


def test_publish_twice_equals_once(spark, tmp_path):
    staged, final = str(tmp_path / "s"), str(tmp_path / "f")
    load = lambda data: spark.createDataFrame(data, "line string, p string")
    overwrite_partitions(load([("old", "1"), ("keep", "0")]), final, ["p"])
    for _ in range(2):
        wap.write_staged(load([("new", "1"), ("", "2")]), staged, "p")
        wap.publish(spark, staged, final, "p", "line")
    assert rows(spark.read.parquet(final).select("line", F.col("p").cast("string"))) == [("", "2"), ("keep", "0"), ("new", "1")]
    wap.clear_staged(spark, staged)
    assert spark.read.parquet(staged).count() == 0


def test_audit_blocks_null_partition(spark, tmp_path):
    staged = str(tmp_path / "s")
    wap.write_staged(spark.createDataFrame([("a", None)], "line string, p string"), staged, "p")
    with pytest.raises(RuntimeError):
        wap.publish(spark, staged, str(tmp_path / "f"), "p", "line")


def test_swap_append_and_empty(spark, tmp_path):
    df = spark.range(3)
    tables.swap_table(df, "swapped", str(tmp_path / "t"))
    tables.swap_table(spark.range(5), "swapped", str(tmp_path / "t"))
    assert spark.table("swapped").count() == 5
    tables.swap_table(spark.range(2).select(F.col("id").alias("b"), F.lit("x").alias("t")), "swapped", str(tmp_path / "t"))
    assert rows(spark.table("swapped")) == [(0, "x"), (1, "x")]
    kept = sorted(p.name for p in (tmp_path / "t").iterdir())
    with pytest.raises(Exception, match="bad row"):
        tables.swap_table(spark.range(2).select("id", F.raise_error(F.lit("bad row")).alias("t")), "swapped", str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == kept and spark.table("swapped").count() == 2
    path = str(tmp_path / "a")
    tables.write_or_empty(spark, None, df.schema, path)
    assert spark.read.parquet(path).count() == 0
    tables.append_rows(df, path)
    tables.append_rows(df, path)
    assert spark.read.parquet(path).count() == 6
    spark.sql("DROP VIEW swapped")


def test_swapped_table_is_never_missing_and_keeps_versions_for_running_readers(spark, tmp_path):
    base = tmp_path / "versions"
    tables.swap_table(spark.range(3), "versioned", str(base))
    begun = spark.table("versioned")  # a reader that goes on after two replacements, one with other columns
    seen = []

    def watch():
        while not done.is_set():
            seen.append((spark.catalog.tableExists("versioned"), len(spark.table("versioned").columns)))

    done = threading.Event()
    watcher = threading.Thread(target=watch)
    watcher.start()
    for n in range(2):
        tables.swap_table(spark.range(10 + n).withColumn("n", F.lit(n)), "versioned", str(base))
    done.set()
    watcher.join()
    assert begun.count() == 3 and spark.table("versioned").count() == 11
    assert {s for s in seen} <= {(True, 1), (True, 2)}
    for n in range(3):
        tables.swap_table(spark.range(n), "versioned", str(base), keep=1)
    assert len(list(base.iterdir())) == 2 and spark.table("versioned").count() == 2
    spark.sql("DROP VIEW versioned")


def test_partitions(spark):
    landed = spark.createDataFrame([(1,), (2,), (3,), (3,)], "p int")
    assert rows(partitions_missing(landed, landed.filter("p = 1"), landed.filter("p = 2"), partition="p")) == [(3,)]
    assert latest_partition(landed, "p").count() == 2
    assert latest_partition(landed.filter("p > 9"), "p").count() == 0


def test_latest_partition_is_pruned_by_a_subquery(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40).select("id", (F.col("id") % 8).alias("p")).write.partitionBy("p").parquet(path)
    newest = latest_partition(spark.read.parquet(path), "p")
    scan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p#" in scan and "Subquery" in scan.split("PartitionFilters")[1].split("\n")[0]
    assert newest.select("id").distinct().count() == 5
    assert {f.split("p=")[1][0] for f in newest.select("_metadata.file_path").distinct().toPandas()["file_path"]} == {"7"}


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, final, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    landing.mkdir()
    (landing / "F.C2501.TXT").write_text("1;a\nHEADER\n\n2;b\n")
    ingest_new_files(spark, str(landing), final, checkpoint)
    (landing / "F.C2502.TXT").write_text("3;c\n")
    ingest_new_files(spark, str(landing), final, checkpoint)
    ingest_new_files(spark, str(landing), final, checkpoint)
    got = spark.read.parquet(final).select("line", F.col("part_date").cast("string"))
    assert rows(got) == [("1;a", "2025-01-01"), ("2;b", "2025-01-01"), ("3;c", "2025-02-01")]


def test_stream_keeps_earlier_files_of_a_partition_and_sets_undated_ones_apart(spark, tmp_path):
    landing, final, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    landing.mkdir()
    (landing / "P1.C2501.TXT").write_text("1;a\n2;b\n")
    ingest_new_files(spark, str(landing), final, checkpoint)
    (landing / "P2.C2501.TXT").write_text("3;c\n")
    (landing / "NAMELESS.TXT").write_text("4;d\n")
    ingest_new_files(spark, str(landing), final, checkpoint)
    assert rows(spark.read.parquet(final).select("line")) == [("1;a",), ("2;b",), ("3;c",)]
    assert rows(spark.read.parquet(f"{final}-rejected").select("line")) == [("4;d",)]
    assert quarantined_files(spark, f"{final}-quarantine").count() == 0


def test_ingest_keeps_bad_files_apart_and_replaces_redelivered_ones(spark, tmp_path):
    landing, final, checkpoint = tmp_path / "landing", str(tmp_path / "final"), str(tmp_path / "checkpoint")
    refused = lambda: rows(quarantined_files(spark, f"{final}-quarantine").select(F.element_at(F.split("file_path", "/"), -1), "reason"))
    lines = lambda: rows(ingested_lines(spark, final).select("line"))
    ingest_new_files(spark, str(landing / "*"), final, checkpoint)  # nothing has landed yet
    landing.mkdir()
    ingest_new_files(spark, str(landing / "*"), final, checkpoint)
    assert lines() == refused() == []
    (landing / "X.C2402.TXT").write_text("")
    (landing / "H.C2402.TXT").write_text("HEADER\n\n")
    (landing / "A [1] b.C2401.TXT").write_text("1;a\n2;b\n")
    (landing / "B.C2401.TXT").write_text("3;c\n")
    ingest_new_files(spark, str(landing / "*"), final, checkpoint)
    assert lines() == [("1;a",), ("2;b",), ("3;c",)]
    assert refused() == [("H.C2402.TXT", "no data lines"), ("X.C2402.TXT", "empty file")]
    # later runs go on; a new delivery replaces the lines of its file, an unsound one does not
    (landing / "X.C2402.TXT").write_text("4;d\n")
    (landing / "A [1] b.C2401.TXT").write_text("1;A\n2;B\n5;E\n")
    (landing / "B.C2401.TXT").write_text("END\n")
    ingest_new_files(spark, str(landing / "*"), final, checkpoint)
    assert lines() == [("1;A",), ("2;B",), ("3;c",), ("4;d",), ("5;E",)]
    assert refused() == [("B.C2401.TXT", "no data lines"), ("H.C2402.TXT", "no data lines"), ("X.C2402.TXT", "empty file")]
    ingest_new_files(spark, str(landing / "*"), final, checkpoint)
    assert len(lines()) == 5 and len(refused()) == 3
    days = {str(r[0]) for r in ingested_lines(spark, final).select("part_date").distinct().collect()}
    assert days == {"2024-01-01", "2024-02-01"}


def test_ingest_folders_do_not_grow_with_the_number_of_files(spark, tmp_path):
    landing, final, checkpoint = tmp_path / "landing", tmp_path / "final", str(tmp_path / "checkpoint")
    landing.mkdir()
    for run in range(3):
        for n in range(30):
            (landing / f"F{run}x{n}.C2401.TXT").write_text(f"{run}{n};a\n")
        ingest_new_files(spark, str(landing / "*"), str(final), checkpoint)
    assert ingested_lines(spark, str(final)).count() == 90
    assert len(list(final.glob("part_date=*/bucket=*"))) <= SLOTS and len(list(final.glob("*/*/*.parquet"))) <= 2 * SLOTS


def test_a_file_that_vanishes_before_its_batch_is_refused(spark, tmp_path):
    landing, final, checkpoint = tmp_path / "landing", str(tmp_path / "final"), str(tmp_path / "checkpoint")
    landing.mkdir()
    (landing / "G.C2401.TXT").write_text("1;a\n")
    manifest.record_arrivals(spark, str(landing / "*"), f"{checkpoint}-manifest")
    (landing / "G.C2401.TXT").unlink()
    ingest_new_files(spark, str(landing / "*"), final, checkpoint)
    assert ingested_lines(spark, final).count() == 0
    assert [r["reason"] for r in quarantined_files(spark, f"{final}-quarantine").collect()] == ["no data lines"]


def contents(path):
    """Bytes of every data file of a store, by folder."""
    return {p.relative_to(path): p.read_bytes() for p in path.rglob("*.parquet")}


def test_merge_buckets_leaves_other_buckets_as_they_are(spark, tmp_path):
    path, schema = tmp_path / "t", "k long, d string, v int"
    load = lambda values: spark.createDataFrame(values, schema)
    stored.merge_buckets(load([(i, "x", 1) for i in range(200)] + [(None, "x", 1)]), str(path), ["k", "d"], 16)
    before = contents(path)
    assert len({p.parent for p in before}) == 16
    more = load([(3, "x", 2), (None, "x", 2), (900, None, 2)])
    for _ in range(2):
        stored.merge_buckets(more, str(path), ["k", "d"], 16)
        got = {tuple(r) for r in stored.read_store(spark, str(path)).select("k", "d", "v").collect()}
        assert got == {(i, "x", 2 if i == 3 else 1) for i in range(200)} | {(None, "x", 2), (900, None, 2)}
    after = contents(path)
    touched = {r[0] for r in more.select(stored.bucket_of(["k", "d"], 16)).collect()}
    kept = {p for p in before if p.parent.name not in {f"bucket={b}" for b in touched}}
    assert len(kept) >= 13 and all(after.get(p) == before[p] for p in kept)
    stored.merge_buckets(more.limit(0), str(path), ["k", "d"], 16)
    assert contents(path) == after
    with pytest.raises(Exception, match="repeat a key"):
        stored.merge_buckets(load([(1, "x", 1), (1, "x", 2)]), str(path), ["k", "d"], 16)


def test_merge_buckets_below_a_partition(spark, tmp_path):
    path, schema = tmp_path / "t", "day string, k int, v int"
    load = lambda values: spark.createDataFrame(values, schema)
    rows_of = lambda: sorted(tuple(r) for r in stored.read_store(spark, str(path)).select("day", "k", "v").collect())
    merge = lambda df, **more: stored.merge_buckets(df, str(path), ["day", "k"], 4, within=["day"], **more)
    merge(load([("a", i, 1) for i in range(20)] + [("b", i, 1) for i in range(20)]))
    before = contents(path)
    merge(load([("b", 1, 2)]))
    assert rows_of() == sorted([("a", i, 1) for i in range(20)] + [("b", i, 2 if i == 1 else 1) for i in range(20)])
    assert sum(contents(path).get(p) == data for p, data in before.items()) == len(before) - 1
    merge(load([("b", 1, 3), ("b", 1, 4)]), unique=False)  # a key of several rows
    assert [r for r in rows_of() if r[:2] == ("b", 1)] == [("b", 1, 3), ("b", 1, 4)]
    with pytest.raises(ValueError, match="rows without"):
        merge(load([(None, 1, 1)]))
    with pytest.raises(ValueError, match="part of the key"):
        stored.merge_buckets(load([("a", 1, 1)]), str(path), ["k"], 4, within=["day"])


def test_stored_snapshots_are_added_once(spark, tmp_path):
    path, schema = tmp_path / "t", "stamp date, k int"
    snap = lambda day, keys: spark.createDataFrame([(dt.date(2024, 1, day), k) for k in keys], schema)
    stored.append_snapshot_stored(snap(1, range(9)), str(path), "stamp", ["stamp", "k"], 4)
    before = contents(path)
    stored.append_snapshot_stored(snap(1, [77]), str(path), "stamp", ["stamp", "k"], 4)  # the stamp is there
    assert contents(path) == before
    stored.append_snapshot_stored(snap(2, [1, None]), str(path), "stamp", ["stamp", "k"], 4)
    assert stored.read_store(spark, str(path)).count() == 11 and contents(path).items() >= before.items()


def test_history_only_adds_closed_versions(spark, tmp_path):
    path, day = tmp_path / "h", lambda n: F.lit(f"2024-01-{n:02d}").cast("date")
    version = spark.createDataFrame([], "k int, v string, valid_from date, valid_to date").schema
    snap = lambda values: spark.createDataFrame(values, "k int, v string")
    expected = spark.createDataFrame([], version)
    loads = [
        (1, [(i, "a") for i in range(50)]), (2, [(i, "a") for i in range(50)]), (3, [(i, "b" if i == 7 else "a") for i in range(50)] + [(60, None)]),
        (3, [(i, "c" if i == 7 else "a") for i in range(50)] + [(60, None)]), (4, [(60, None)]), (5, [(60, "x"), (7, "a")]), (6, []),
    ]
    closed = {}
    for n, values in loads:
        for _ in range(2 if n in (3, 5) else 1):  # a run again changes nothing
            stored.scd2_update(snap(values), str(path), "k", ["v"], day(n), buckets=8)
        expected = spark.createDataFrame(incremental.scd2_next(expected, snap(values), "k", ["v"], day(n)).collect(), version)
        got = stored.read_history(spark, str(path), version).select(version.names)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, expected.select(version.names).collect())))
        now = contents(path / "closed")
        assert {p: b for p, b in now.items() if f"valid_to=2024-01-{n:02d}" not in str(p)} == {
            p: b for p, b in closed.items() if f"valid_to=2024-01-{n:02d}" not in str(p)
        }
        closed = now
    assert not contents(path / "open")


def test_geometry_without_parts_and_rows_without_key(spark):
    shape = "x double, y double, rings array<array<array<double>>>, paths array<array<array<double>>>"
    df = spark.createDataFrame([((None, None, None, []),), ((None, None, [], None),), ((1.0, 2.0, [], []),)], f"geometry struct<{shape}>")
    assert [r.geometry for r in features.with_geometry(df).collect()] == [None, None, "POINT (1.0 2.0)"]
    with pytest.raises(Exception, match="without|no k"):
        update_batches(spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string"), "k", ["v"]).collect()


def test_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -1), (2, "z", None)], "id int, s string, n int")
    checks = [
        rules.unique("id"), rules.not_null("s"), rules.accepted("s", ["a"], severity="warn"), rules.holds("positive", F.col("n") > 0),
        rules.not_null("n", where="id = 1"), rules.references("id", spark.createDataFrame([(1,)], "k int"), "k"),
        rules.disjoint("id", spark.createDataFrame([(7,)], "k int"), "k"), rules.covered_by("id", df, "id"),
    ]
    result = rules.run_rules("t", df, checks)
    assert {(r["rule"], r["status"], r["n_failed"]) for r in result.collect()} == {
        ("unique_id", "fail", 1), ("not_null_s", "fail", 1), ("accepted_s", "warn", 1), ("positive", "fail", 1), ("not_null_n", "pass", 0),
        ("references_id", "fail", 1), ("disjoint_id", "pass", 0), ("covered_id", "pass", 0),
    }
    assert {r["status"]: r["n_rules"] for r in rules.summary(result).collect()} == {"fail": 4, "warn": 1, "pass": 3}
    with pytest.raises(RuntimeError, match="t.unique_id"):
        rules.raise_on_failure(result)
    row_rules = [c for c in checks if c.row_test is not None]
    for _ in range(2):
        found = rules.store_failures("t", df, row_rules, str(tmp_path / "failed"))
    assert rows(found) == rows(rules.run_rules("t", df, row_rules))
    failed = spark.read.parquet(str(tmp_path / "failed"))
    assert {(r["rule"], r["id"], r["s"]) for r in failed.collect()} == {("not_null_s", 1, None), ("accepted_s", 2, "z"), ("positive", 1, None)}
    with pytest.raises(ValueError, match="unique_id"):
        rules.store_failures("t", df, checks, str(tmp_path / "failed"))
    with pytest.raises(ValueError):
        rules.check_columns(df, ["missing"])


def test_reconcile(spark):
    left, right = spark.range(3).agg(F.count("id").alias("n")), spark.range(5).agg(F.count("id").alias("n"))
    assert rows(rules.reconcile("c", left, right)) == [("c", 3, 5, -2)]


def test_registry_selects_and_runs(spark):
    stored = []

    def store(df, name):
        stored.append(name)
        return df

    house = Warehouse({"src": spark.range(4)})
    house.add(Model("raw", lambda s: s.filter("id > 0"), ["src"], frozenset({"daily"}), stored=False))
    house.add(Model("core", lambda r: r.withColumn("v", F.col("id") * 2), ["raw"], rules=lambda: [rules.unique("id")]))
    house.add(Model("mart", lambda c, r: c.join(r, "id"), ["core", "raw"], frozenset({"daily"}), rules=lambda: [rules.not_null("v")]))
    assert house.select("core") == ["core"]
    assert house.select("+core") == ["raw", "core"]
    assert house.select("core+") == ["core", "mart"]
    assert house.select("tag:daily") == ["raw", "mart"]
    result = house.run("+mart", store)
    assert {(r["table_name"], r["status"]) for r in result.collect()} == {("core", "pass"), ("mart", "pass")}
    assert stored == ["core", "mart"]


def test_undeclared_source_is_refused(spark):
    with pytest.raises(KeyError):
        source_tables.table(spark, "/nowhere", "secret")


def test_merge_stored_rewrites_only_touched_partitions(spark, tmp_path):
    path, key = str(tmp_path / "t"), ["id", "part"]
    files = lambda part: sorted(p.name for p in (tmp_path / "t" / f"part={part}").glob("*.parquet"))
    incremental.merge_stored(spark.createDataFrame([(1, "a", 1), (2, "a", 1), (1, "b", 1), (None, "b", 1)], "id int, part string, v int"), path, key, "part")
    before = files("a"), files("b")
    more = spark.createDataFrame([(None, "b", 2), (3, "b", 2), (1, "c", 2)], "id int, part string, v int")
    for _ in range(2):
        incremental.merge_stored(more, path, key, "part")
        got = {(r["id"], r["part"], r["v"]) for r in spark.read.parquet(path).collect()}
        assert got == {(1, "a", 1), (2, "a", 1), (1, "b", 1), (None, "b", 2), (3, "b", 2), (1, "c", 2)}
    assert files("a") == before[0] and files("b") != before[1]
    incremental.merge_stored(more.limit(0), path, key, "part")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError, match="without part"):
        incremental.merge_stored(more.withColumn("part", F.lit(None).cast("string")), path, key, "part")
    with pytest.raises(ValueError, match="part of the key"):
        incremental.merge_stored(more, path, ["id"], "part")


def test_crosswalk_keeps_first_entries(spark, tmp_path):
    path, at = str(tmp_path / "crosswalk"), lambda d: F.lit(f"2024-01-0{d}").cast("timestamp")
    assert outbound.read_crosswalk(spark, path, "k").count() == 0
    outbound.record_adds(spark.createDataFrame([(1, 11), (2, 12)], "k int, external_id long"), path, "k", at(1))
    outbound.record_adds(spark.createDataFrame([(2, 99), (3, 13)], "k int, external_id long"), path, "k", at(2))
    entries = {(r["k"], r["external_id"], r["synced_at"].day) for r in outbound.read_crosswalk(spark, path, "k").collect()}
    assert entries == {(1, 11, 1), (2, 12, 1), (3, 13, 2)}
    df = spark.createDataFrame([(3, "x"), (4, "y"), (None, "z")], "k int, t string")
    assert {r["t"] for r in outbound.pending_adds(df, outbound.read_crosswalk(spark, path, "k"), "k").collect()} == {"y", "z"}


def test_consistent_flag(spark):
    df = spark.createDataFrame([(1, "Sim", "7"), (2, "Sim", " "), (3, "Sim", None), (4, "Não", ""), (5, None, None), (6, None, "7")], "id int, f string, t string")
    rule = rules.consistent("c", F.col("f"), F.col("t"))
    assert {r["id"] for r in rule.run(df).collect()} == {2, 3, 6}
