"""Change detection, keyed and partition-wise loads, history, outbound sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from caseloom.operators.delta import change_log, changed_rows, with_change_id
from caseloom.operators.incremental import (
    latest_partition,
    merge_by_key,
    merge_stored,
    overwrite_partitions,
    partitions_missing,
)
from caseloom.operators.outbound import pending_adds, read_crosswalk, record_adds, update_batches
from caseloom.operators.stored import merge_buckets, read_history, read_store, scd2_update
from caseloom.plans.registry import query
from caseloom.session import cut_lineage, run_path
from caseloom.sinks.tables import swap_table, write_or_empty
from caseloom.sinks.wap import audit, clear_staged, publish, write_staged
from caseloom.sources.tables import table, with_capture_time

COMPARED = ["name", "segment", "nation", "balance"]


def computed_state(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("objectid"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance"),
    )


def current_state(spark, sf):
    """The same rows as the external system holds them: text ids, 'None' for NULL, some stale."""
    key = F.col("c_custkey")
    segment = F.when(key % 11 == 0, F.when(key % 2 == 0, "None")).when(key % 13 == 0, "OLD").otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").select(
        key.cast("string").alias("objectid"),
        F.col("c_name").alias("name"),
        segment.alias("segment"),
        F.when(key % 17 == 0, "None").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
        F.when(key % 19 == 0, "0.00").otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("balance"),
    )


STATES_SQL = """
    n AS (SELECT c_custkey AS objectid, c_name AS name, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
                 CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance FROM customer),
    o AS (SELECT CAST(c_custkey AS VARCHAR) AS objectid, c_name AS name,
                 CASE WHEN c_custkey % 11 = 0 THEN (CASE WHEN c_custkey % 2 = 0 THEN 'None' END) WHEN c_custkey % 13 = 0 THEN 'OLD' ELSE c_mktsegment END AS segment,
                 CASE WHEN c_custkey % 17 = 0 THEN 'None' ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
                 CASE WHEN c_custkey % 19 = 0 THEN '0.00' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS balance FROM customer)
"""
DIFFERS_SQL = " OR ".join(
    f"coalesce(nullif(n.{c}, 'None'), '') <> coalesce(nullif(o.{c}, 'None'), '')" for c in COMPARED
)
LOG_SQL = " UNION ALL ".join(
    f"SELECT CAST(n.objectid AS VARCHAR) AS source_id, 'customer' AS product, '{c}' AS column_name, nullif(nullif(o.{c}, 'None'), '') AS old_value,"
    f" nullif(nullif(n.{c}, 'None'), '') AS new_value FROM n JOIN o ON CAST(n.objectid AS VARCHAR) = o.objectid"
    f" WHERE coalesce(nullif(n.{c}, 'None'), '') <> coalesce(nullif(o.{c}, 'None'), '')"
    for c in COMPARED
)


@query(
    "delta_feedback",
    f"WITH {STATES_SQL} SELECT n.* FROM n JOIN o ON CAST(n.objectid AS VARCHAR) = o.objectid WHERE {DIFFERS_SQL}",
)
def delta_feedback(spark, sf):
    return changed_rows(computed_state(spark, sf), current_state(spark, sf), "objectid", COMPARED)


@query("unpivot_changes", f"WITH {STATES_SQL} {LOG_SQL}")
def unpivot_changes(spark, sf):
    return change_log(computed_state(spark, sf), current_state(spark, sf), "objectid", COMPARED, "customer")


@query(
    "change_log",
    f"""
    WITH {STATES_SQL}, l AS ({LOG_SQL}) SELECT column_name, count(*) AS n_changes, count(*) AS n_ids, count(old_value) AS n_old, count(new_value) AS n_new FROM l GROUP BY 1
    """,
)
def change_history(spark, sf):
    log = with_change_id(change_log(computed_state(spark, sf), current_state(spark, sf), "objectid", COMPARED, "customer"))
    path = run_path(spark, "changes")
    # a second run logs some changes again: the hashed key lets it replace, not repeat
    merge_buckets(log, path, ["change_id"])
    merge_buckets(log.filter("column_name <> 'segment'"), path, ["change_id"])
    history = read_store(spark, path)
    return history.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_changes"),
        F.count_distinct("change_id").alias("n_ids"),
        F.count("old_value").alias("n_old"),
        F.count("new_value").alias("n_new"),
    )


def monthly_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("part_date"),
    )


@query(
    "incremental_merge",
    """
    WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey END AS o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                      CAST(date_trunc('month', o_orderdate) AS DATE) AS part_date FROM orders)
    SELECT o_custkey, part_date, CASE WHEN part_date >= DATE '2000-01-01' THEN 'second' ELSE 'first' END AS load_no, count(*) AS n_orders,
           CAST(sum(price) AS DOUBLE) AS amount FROM m GROUP BY 1, 2
    """,
)
def incremental_merge(spark, sf):
    """A first load of all months, then a second load that replaces the recent ones by a key with NULLs in it."""
    months = monthly_orders(spark, sf).groupBy("o_custkey", "part_date").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("price").cast("double").alias("amount")
    )
    first = months.withColumn("load_no", F.lit("first"))
    second = months.filter("part_date >= date'2000-01-01'").withColumn("load_no", F.lit("second"))
    return merge_by_key(first, second, ["o_custkey", "part_date"])


@query(
    "insert_overwrite_partitions",
    """
    WITH m AS (SELECT o_orderkey, date_trunc('year', o_orderdate) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
    SELECT CAST(y AS DATE) AS part_date, CASE WHEN year(y) >= 2000 THEN 'second' ELSE 'first' END AS load_no, count(*) AS n_orders,
           CAST(sum(price) AS DOUBLE) AS amount FROM m GROUP BY 1, 2
    """,
)
def insert_overwrite(spark, sf):
    path = run_path(spark, "overwrite")
    years = monthly_orders(spark, sf).withColumn("part_date", F.trunc("part_date", "year"))
    recent = years.filter("part_date >= date'2000-01-01'")
    overwrite_partitions(years.withColumn("load_no", F.lit("first")), path, ["part_date"])
    for _ in range(2):  # the same delivery twice
        overwrite_partitions(recent.withColumn("load_no", F.lit("second")), path, ["part_date"])
    return spark.read.parquet(path).groupBy("part_date", "load_no").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("price").cast("double").alias("amount")
    )


@query(
    "scd2_snapshot",
    """
    WITH a AS (SELECT c_custkey, c_mktsegment AS segment, c_nationkey AS nation FROM customer WHERE c_custkey % 10 <> 9),
    b AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment, c_nationkey AS nation FROM customer WHERE c_custkey % 10 <> 8)
    SELECT a.c_custkey, a.segment, a.nation, DATE '2024-01-01' AS valid_from, CASE WHEN b.c_custkey IS NULL OR a.segment <> b.segment THEN DATE '2024-02-01' END AS valid_to
    FROM a LEFT JOIN b ON a.c_custkey = b.c_custkey
    UNION ALL SELECT b.c_custkey, b.segment, b.nation, DATE '2024-02-01', NULL FROM b LEFT JOIN a ON a.c_custkey = b.c_custkey
    WHERE a.c_custkey IS NULL OR a.segment <> b.segment
    """,
)
def scd2_snapshot(spark, sf):
    people = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")
    )
    before = people.filter("c_custkey % 10 <> 9")
    after = people.filter("c_custkey % 10 <> 8").withColumn(
        "segment", F.when(F.col("c_custkey") % 5 == 0, "MOVED").otherwise(F.col("segment"))
    )
    path, columns = run_path(spark, "history"), ["segment", "nation"]
    day = lambda text: F.lit(text).cast("date")
    for load, as_of in ((before, "2024-01-01"), (before, "2024-01-15"), (after, "2024-02-01")):  # nothing changed in the second
        scd2_update(load, path, "c_custkey", columns, day(as_of), buckets=16)
    version = before.select("*", F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return read_history(spark, path, version.schema)


def staged_lines(spark, sf):
    """Raw lines of orders by year, some blank."""
    line = F.when(F.col("o_orderkey") % 50 == 0, "  ").otherwise(F.concat_ws(";", "o_orderkey", "o_orderstatus"))
    return table(spark, sf, "orders").select(line.alias("line"), F.trunc(F.to_date("o_orderdate"), "year").alias("part_date"))


@query(
    "wap_audit",
    """
    WITH l AS (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS part_date, o_orderkey % 50 = 0 AS blank FROM orders)
    SELECT part_date, count(*) AS n_rows, count(*) FILTER (WHERE blank) AS n_blank, CASE WHEN bool_or(blank) THEN 'warn' ELSE 'pass' END AS status FROM l GROUP BY 1
    UNION ALL SELECT DATE '2030-01-01', 0, 0, 'fail'
    """,
)
def wap_audit(spark, sf):
    staged = staged_lines(spark, sf)
    expected = staged.select("part_date").distinct().unionByName(spark.range(1).select(F.lit("2030-01-01").cast("date").alias("part_date")))
    return audit(staged, "part_date", "line", expected)


@query(
    "wap_publish",
    """
    SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS part_date, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 50 = 0) AS n_blank, 0 AS n_staged
    FROM orders GROUP BY 1
    """,
)
def wap_publish(spark, sf):
    staged, final = run_path(spark, "staged"), run_path(spark, "final")
    promised = table(spark, sf, "orders").select(F.trunc(F.to_date("o_orderdate"), "year").alias("part_date"))
    for _ in range(2):  # publishing twice equals publishing once
        write_staged(staged_lines(spark, sf), staged, "part_date")
        publish(spark, staged, final, "part_date", "line", promised)
    clear_staged(spark, staged)
    left = spark.read.parquet(staged).agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    published = spark.read.parquet(final)
    return published.groupBy("part_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.trim("line") == "").alias("n_blank")
    ).withColumn("n_staged", left)


MONTH_SQL = "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS part_date FROM orders"


@query(
    "pending_partitions",
    f"""
    WITH m AS ({MONTH_SQL}) SELECT part_date FROM m
    WHERE NOT (year(part_date) < 1998) AND NOT (month(part_date) <= 3 AND year(part_date) <= 2000)
    """,
)
def pending_partitions(spark, sf):
    landed = monthly_orders(spark, sf)
    staging = landed.filter("year(part_date) < 1998")
    mart = landed.filter("month(part_date) <= 3 and year(part_date) <= 2000")
    return partitions_missing(landed, staging, mart, partition="part_date")


@query("staging_gap", f"WITH m AS ({MONTH_SQL}) SELECT part_date FROM m WHERE year(part_date) >= 2001")
def staging_gap(spark, sf):
    staging = monthly_orders(spark, sf)
    return partitions_missing(staging, staging.filter("year(part_date) < 2001"), partition="part_date")


@query(
    "outbound_update_batches",
    f"""
    WITH {STATES_SQL}, d AS (SELECT n.objectid, n.segment, n.nation FROM n JOIN o ON CAST(n.objectid AS VARCHAR) = o.objectid WHERE {DIFFERS_SQL}),
    b AS (SELECT (row_number() OVER (ORDER BY objectid) - 1) // 100 AS batch, * FROM d)
    SELECT batch, count(*) AS n_rows, min(objectid) AS first_id, max(objectid) AS last_id, count(segment) AS n_segment,
           min('{{"attributes":{{"objectid":' || objectid || ',"segment":' || coalesce('"' || segment || '"', 'null') || ',"entered":' || (788918400000 + objectid * 86400000) || '}}}}') AS first_payload
    FROM b GROUP BY 1
    """,
)
def outbound_update_batches(spark, sf):
    changed = changed_rows(computed_state(spark, sf), current_state(spark, sf), "objectid", COMPARED)
    dated = changed.select(
        "objectid",
        F.coalesce("segment", F.lit("NaN")).alias("segment"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("objectid").cast("int")).cast("string").alias("entered"),
    )
    batches = update_batches(dated, "objectid", ["segment", "entered"], ["entered"])
    return batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("objectid").alias("first_id"),
        F.max("objectid").alias("last_id"),
        F.count("segment").alias("n_segment"),
        F.min("payload").alias("first_payload"),
    )


@query(
    "stored_merge",
    """
    WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_trunc('year', o_orderdate) AS DATE) AS part_date,
                      count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY ALL)
    SELECT *, CASE WHEN part_date >= DATE '2000-01-01' AND o_custkey % 3 = 0 THEN 'second' ELSE 'first' END AS load_no FROM m
    """,
)
def stored_merge(spark, sf):
    """A stored table of monthly totals: a second load, delivered twice, replaces and adds rows in recent years."""
    path, key = run_path(spark, "merge"), ["o_custkey", "month", "part_date"]
    months = table(spark, sf, "orders").groupBy(
        "o_custkey",
        F.trunc(F.to_date("o_orderdate"), "month").alias("month"),
        F.trunc(F.to_date("o_orderdate"), "year").alias("part_date"),
    ).agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount"))
    recent = F.col("part_date") >= F.lit("2000-01-01").cast("date")
    merge_stored(months.filter(~recent | (F.col("o_custkey") % 6 != 0)).withColumn("load_no", F.lit("first")), path, key, "part_date")
    for _ in range(2):
        merge_stored(months.filter(recent & (F.col("o_custkey") % 3 == 0)).withColumn("load_no", F.lit("second")), path, key, "part_date")
    return spark.read.parquet(path)


@query(
    "outbound_adds_crosswalk",
    """
    WITH a AS (SELECT c_custkey, c_name, 0 AS run FROM customer WHERE c_custkey % 3 <> 0
               UNION ALL SELECT c_custkey, c_name, 1 FROM customer WHERE c_custkey % 3 = 0 AND c_acctbal >= 0),
    b AS (SELECT *, (row_number() OVER (PARTITION BY run ORDER BY c_custkey) - 1) // 100 AS batch FROM a)
    SELECT c_custkey, batch, '{"attributes":{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}}' AS payload,
           CAST(c_custkey + 1000000 AS BIGINT) AS external_id, DATE '2024-01-01' + run AS synced_on
    FROM b
    """,
)
def outbound_adds_crosswalk(spark, sf):
    """Three daily runs: each sends the rows of the newest day that the crosswalk lacks and records the answers."""
    path, day = run_path(spark, "crosswalk"), lambda n: F.lit(f"2024-01-0{n}").cast("date")
    people = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    first = people.filter("c_custkey % 3 <> 0").withColumn("day", day(1))
    second = people.filter("c_acctbal >= 0").withColumn("day", day(2))
    sent = []
    for run, landed in enumerate([first, first.unionByName(second), first.unionByName(second.withColumn("day", day(3)))], 1):
        adds = pending_adds(latest_partition(landed, "day"), read_crosswalk(spark, path, "c_custkey"), "c_custkey")
        batches = cut_lineage(update_batches(adds, "c_custkey", ["c_name"]), "batches")
        # the external system answers with an object id per row
        record_adds(batches.withColumn("external_id", F.col("c_custkey") + 1_000_000), path, "c_custkey", day(run).cast("timestamp"))
        sent.append(batches.select("c_custkey", "batch", "payload"))
    crosswalk = read_crosswalk(spark, path, "c_custkey").select("c_custkey", "external_id", F.to_date("synced_at").alias("synced_on"))
    return sent[0].unionByName(sent[1]).unionByName(sent[2]).join(crosswalk, "c_custkey")


@query(
    "table_swap",
    """
    SELECT 1 AS version, c_nationkey, count(*) AS n_rows, NULL AS captured FROM customer WHERE c_custkey % 2 = 0 GROUP BY 2
    UNION ALL SELECT 2, c_nationkey, count(*), '2024-01-30 12:00:00' FROM customer WHERE c_custkey % 2 = 0 GROUP BY 2
    UNION ALL SELECT 3, c_nationkey, count(*), '2024-01-31 12:00:00' FROM customer GROUP BY 2
    """,
)
def table_swap(spark, sf):
    """What readers of a table see after each replacement; the second one adds a capture time."""
    name, base = f"swap_{uuid.uuid4().hex}", run_path(spark, "swap")
    people = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    even, at = people.filter("c_custkey % 2 = 0"), lambda day: F.lit(f"2024-01-{day} 12:00:00").cast("timestamp")
    seen = None
    for version, load in enumerate([even, with_capture_time(even, at(30)), with_capture_time(people, at(31))], 1):
        swap_table(load, name, base)
        now = spark.table(name)
        stamp = F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss") if "captured_at" in now.columns else F.lit(None).cast("string")
        counted = now.groupBy("c_nationkey", stamp.alias("captured")).agg(F.count(F.lit(1)).alias("n_rows"))
        counted = cut_lineage(counted.withColumn("version", F.lit(version)), "version")
        seen = counted if seen is None else seen.unionByName(counted)
    spark.sql(f"DROP VIEW {name}")
    return seen


@query(
    "empty_source_tables",
    """
    SELECT s.status, count(o_orderkey) AS n_rows, 'o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string' AS columns
    FROM (VALUES ('F'), ('O'), ('P'), ('X')) s(status) LEFT JOIN orders ON o_orderstatus = s.status GROUP BY 1
    """,
)
def empty_source_tables(spark, sf):
    """A load per status: a status without rows still leaves a table with the columns of the source."""
    orders, counted = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), None
    for status in ("F", "O", "P", "X"):
        path, rows = run_path(spark, "load"), orders.filter(F.col("o_orderstatus") == status)
        write_or_empty(spark, None if rows.isEmpty() else rows, orders.schema, path)
        stored = spark.read.parquet(path)  # columns as the table has them
        columns = ",".join(f"{n}:{t}" for n, t in stored.dtypes)
        one = stored.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(status).alias("status"), "n_rows", F.lit(columns).alias("columns"))
        counted = one if counted is None else counted.unionByName(one)
    return counted
