"""Aggregates, windows restated as aggregates, unions and the daily occupancy mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.codes import bands
from caseloom.functions.dates import stay_days
from caseloom.functions.documents import doc_digits, doc_status
from caseloom.operators.capacity import occupancy
from caseloom.operators.bitmaps import id_bitmaps, id_counts, merged_bitmaps
from caseloom.operators.explode import bounded_text_list
from caseloom.operators.incremental import append_snapshot, overwrite_partitions
from caseloom.operators.skew import attach_group, best_row, key_statistics, skew_join
from caseloom.operators.timeline import group_total, occupancy_by_day, track_interactions
from caseloom.functions.keys import surrogate_key
from caseloom.plans.joins import cents
from caseloom.models.marts import provider_unit_mart
from caseloom.plans.projections import EVENTS_AS_OF, event_cycles
from caseloom.plans.registry import query
from caseloom.session import run_path
from caseloom.sources.tables import table

def count_rows(name: str):
    return F.count(F.lit(1)).alias(name)


@query(
    "basic_group_agg",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, min(l_extendedprice) AS lowest,
           max(CAST(l_shipdate AS DATE)) AS last_ship, count(DISTINCT l_orderkey) AS n_orders
    FROM lineitem GROUP BY 1, 2
    """,
)
def basic_group_agg(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        count_rows("n_lines"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        F.sum(cents("l_extendedprice")).cast("double").alias("amount"),
        F.min("l_extendedprice").alias("lowest"),
        F.max(F.to_date("l_shipdate")).alias("last_ship"),
        F.count_distinct("l_orderkey").alias("n_orders"),
    )


@query(
    "two_level_agg",
    """
    WITH a AS (SELECT l_suppkey, l_orderkey, l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)
    SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS n_lines, count(*) AS n_visits FROM a GROUP BY 1
    """,
)
def two_level_agg(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    visits = returned.groupBy("l_suppkey", "l_orderkey", "l_partkey").agg(count_rows("n"))
    return visits.groupBy("l_suppkey").agg(F.sum("n").alias("n_lines"), count_rows("n_visits"))


@query(
    "conditional_distinct_counts",
    """
    SELECT year(o_orderdate) AS order_year, count(DISTINCT o_custkey) AS n_people,
           count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END) AS n_urgent,
           count(DISTINCT CASE WHEN o_orderstatus IN ('P', 'O') THEN o_custkey END) AS n_open,
           count(DISTINCT CASE WHEN month(o_orderdate) = 7 AND o_totalprice > 200000 THEN o_custkey END) AS n_july_large
    FROM orders GROUP BY 1
    """,
)
def conditional_distinct_counts(spark, sf):
    # one row per (year, person) with its flags, so each count is a plain sum
    flags = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("order_year"), "o_custkey").agg(
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.bool_or(F.col("o_orderstatus").isin("P", "O")).alias("open"),
        F.bool_or((F.month("o_orderdate") == 7) & (F.col("o_totalprice") > 200_000)).alias("july_large"),
    )
    return flags.groupBy("order_year").agg(
        F.count("o_custkey").alias("n_people"),
        F.count_if("urgent").alias("n_urgent"),
        F.count_if("open").alias("n_open"),
        F.count_if("july_large").alias("n_july_large"),
    )


@query(
    "stored_distinct_bitmaps",
    """
    SELECT year(o_orderdate) AS order_year, CAST(CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS INTEGER) AS half, count(DISTINCT o_custkey) AS n_people,
           count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END) AS n_urgent,
           count(DISTINCT CASE WHEN o_totalprice > 200000 THEN o_custkey END) AS n_large
    FROM orders GROUP BY 1, 2
    """,
)
def stored_distinct_bitmaps(spark, sf):
    """Monthly bitmaps, stored in two loads of which the second touches its own months only, merged to half years."""
    path, names = run_path(spark, "bitmaps"), ["n_people", "n_urgent", "n_large"]
    orders = table(spark, sf, "orders").withColumn("part_date", F.trunc(F.to_date("o_orderdate"), "month"))
    tests = dict(zip(names, [F.lit(True), F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 200_000], strict=True))
    later = F.col("part_date") >= F.lit("2000-01-01").cast("date")
    for load in (orders.filter(~later), orders.filter(later)):
        overwrite_partitions(id_bitmaps(load, ["part_date"], "o_custkey", tests), path, ["part_date"])
    months = spark.read.parquet(path).withColumns(
        {"order_year": F.year("part_date").cast("long"), "half": F.when(F.month("part_date") <= 6, 1).otherwise(2)}
    )
    group = ["order_year", "half"]
    return id_counts(merged_bitmaps(months, group, names), group, names)


@query(
    "max_by_latest",
    """
    SELECT o_custkey, arg_max(o_orderstatus, epoch_ms(o_orderdate) // 86400000 * 100000000 + o_orderkey) AS last_status,
           arg_max(o_orderkey, epoch_ms(o_orderdate) // 86400000 * 100000000 + o_orderkey) AS last_order, max(CAST(o_orderdate AS DATE)) AS last_date
    FROM orders GROUP BY 1
    """,
)
def max_by_latest(spark, sf):
    newest = F.struct("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", newest).alias("last_status"),
        F.max_by("o_orderkey", newest).alias("last_order"),
        F.max(F.to_date("o_orderdate")).alias("last_date"),
    )


@query(
    "ordered_string_agg",
    """
    SELECT user_id, string_agg(DISTINCT event_type, ' | ' ORDER BY event_type) AS kinds, count(DISTINCT event_type) AS n_kinds
    FROM events GROUP BY 1
    """,
)
def ordered_string_agg(spark, sf):
    events = table(spark, sf, "events")
    kinds = bounded_text_list(events, ["user_id"], "event_type", " | ", "kinds")
    return kinds.withColumn("n_kinds", F.size(F.split("kinds", r" \| ")).cast("long"))


@query(
    "ordered_array_agg",
    """
    WITH p AS (SELECT o_custkey, o_orderpriority, min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1, 2)
    SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY d, o_orderpriority) AS by_first_use,
           arg_min(o_orderpriority, strftime(d, '%Y%m%d') || o_orderpriority) AS first_used
    FROM p GROUP BY 1
    """,
)
def ordered_array_agg(spark, sf):
    # one entry per customer and priority: the list is as long as the code table
    first_use = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.min(F.to_date("o_orderdate")).alias("d"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("d", "o_orderpriority"))), lambda s: s["o_orderpriority"])
    return first_use.groupBy("o_custkey").agg(ordered.alias("codes")).select(
        "o_custkey", F.array_join("codes", ",").alias("by_first_use"), F.get("codes", F.lit(0)).alias("first_used")
    )


@query(
    "first_struct_by_order",
    """
    SELECT user_id, CAST(ts AS DATE) AS first_day, value AS first_value, props AS first_props FROM events
    WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
    """,
)
def first_struct_by_order(spark, sf):
    bought = table(spark, sf, "events").filter("event_type = 'purchase'")
    first = F.struct(F.to_date("ts").alias("first_day"), F.col("value").alias("first_value"), F.col("props").alias("first_props"))
    return bought.groupBy("user_id").agg(F.min_by(first, F.struct("ts", "event_id")).alias("s")).select("user_id", "s.*")


@query(
    "topk_ranking",
    """
    SELECT p_brand, count(DISTINCT l_orderkey) AS n_orders FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY n_orders DESC, p_brand LIMIT 3
    """,
)
def topk_ranking(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    lines = returned.distinct()
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    pairs = skew_join(lines, brands, ["p_partkey"], ["l_orderkey"], how="inner", count_on=returned).select("p_brand", "l_orderkey").distinct()
    return pairs.groupBy("p_brand").agg(count_rows("n_orders")).orderBy(F.desc("n_orders"), "p_brand").limit(3)


@query(
    "occupancy_rate",
    """
    WITH u AS (SELECT s_suppkey AS unit, CAST(CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE s_suppkey % 50 + 400 END AS BIGINT) AS places,
                      CAST(s_nationkey AS BIGINT) AS blocked FROM supplier),
    o AS (SELECT l_suppkey AS unit, count(*) AS occupied FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
    SELECT u.unit, places, blocked, coalesce(occupied, 0) AS occupied, places - (coalesce(occupied, 0) + blocked) AS free,
           round((coalesce(occupied, 0) + blocked) / nullif(places, 0) * 100, 2) AS rate
    FROM u LEFT JOIN o ON u.unit = o.unit
    """,
)
def occupancy_rate(spark, sf):
    places = F.when(F.col("s_suppkey") % 10 == 0, 0).otherwise(F.col("s_suppkey") % 50 + 400).cast("long")
    units = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("unit"), places.alias("places"), F.col("s_nationkey").cast("long").alias("blocked")
    )
    stays = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("unit"), "l_linestatus")
    return occupancy(units, stays, "unit", F.col("l_linestatus") == "O", "places", "blocked")


@query(
    "origin_sets",
    """
    WITH u AS (SELECT o_custkey AS person, 'urgent order' AS origin FROM orders WHERE o_orderpriority = '1-URGENT'
               UNION ALL SELECT user_id, 'event' FROM events WHERE event_type = 'signup'
               UNION ALL SELECT c_custkey, 'debt' FROM customer WHERE c_acctbal < 0)
    SELECT person, string_agg(DISTINCT origin, ',' ORDER BY origin) AS origins FROM u GROUP BY 1
    """,
)
def origin_sets(spark, sf):
    def tagged(df, key, origin):
        return df.select(F.col(key).alias("person"), F.lit(origin).alias("origin"))

    people = (
        tagged(table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'"), "o_custkey", "urgent order")
        .unionByName(tagged(table(spark, sf, "events").filter("event_type = 'signup'"), "user_id", "event"))
        .unionByName(tagged(table(spark, sf, "customer").filter("c_acctbal < 0"), "c_custkey", "debt"))
    )
    return people.groupBy("person").agg(F.array_join(F.array_sort(F.collect_set("origin")), ",").alias("origins"))


@query(
    "monthly_distinct_snapshot",
    """
    WITH a AS (SELECT DISTINCT year(o_orderdate) AS yr, month(o_orderdate) AS mon,
                      CASE WHEN o_custkey % 9 = 0 THEN '' ELSE lpad(CAST(o_custkey AS VARCHAR), 11, '0') END AS doc,
                      CASE WHEN o_custkey % 9 = 0 THEN 'empty' ELSE 'ok' END AS doc_status, o_orderstatus AS axis, 'orders' AS source
               FROM orders WHERE year(o_orderdate) >= 2000),
    b AS (SELECT DISTINCT year(ts) AS yr, month(ts) AS mon, lpad(CAST(user_id AS VARCHAR), 11, '0') AS doc, 'ok' AS doc_status,
                 CAST(NULL AS VARCHAR) AS axis, 'events' AS source FROM events)
    SELECT source, yr, mon, doc_status, axis, count(*) AS n_people, DATE '2024-01-30' AS snapshot_day
    FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL
    """,
)
def monthly_distinct_snapshot(spark, sf):
    stamp = F.lit(EVENTS_AS_OF).cast("date").alias("snapshot_day")

    def people(df, day, doc, axis, source):
        return df.select(
            stamp,
            F.year(day).cast("long").alias("yr"),
            F.month(day).cast("long").alias("mon"),
            doc_digits(doc).alias("doc"),
            doc_status(doc).alias("doc_status"),
            axis.alias("axis"),
            F.lit(source).alias("source"),
        ).distinct()

    order_doc = F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey").cast("string"))
    orders = table(spark, sf, "orders").filter(F.year("o_orderdate") >= 2000)
    both = people(orders, F.col("o_orderdate"), order_doc, F.col("o_orderstatus"), "orders").unionByName(
        people(table(spark, sf, "events"), F.col("ts"), F.col("user_id").cast("string"), F.lit(None).cast("string"), "events")
    )
    key = ["doc", "yr", "mon", "source", "doc_status", "axis", "snapshot_day"]
    empty = spark.createDataFrame([], both.schema)
    first = append_snapshot(empty, both, "snapshot_day", key)
    return first.groupBy("source", "yr", "mon", "doc_status", "axis", "snapshot_day").agg(count_rows("n_people"))


@query(
    "fact_metric_rollup",
    """
    WITH b AS (SELECT DISTINCT l_suppkey, CAST(l_partkey % 25 AS INTEGER) AS unit FROM lineitem WHERE l_quantity > 48),
    v AS (SELECT l_suppkey, CAST(l_partkey % 25 AS INTEGER) AS unit, count(DISTINCT l_orderkey) AS n_visits FROM lineitem
          WHERE coalesce(nullif(l_returnflag, 'N'), 'X') <> 'R' GROUP BY 1, 2),
    e AS (SELECT l_suppkey, CAST(l_partkey % 25 AS INTEGER) AS unit, count(DISTINCT l_orderkey * 10 + l_linenumber) AS n_notes
          FROM lineitem WHERE l_linestatus = 'F' AND l_tax >= 0.07 GROUP BY 1, 2)
    SELECT md5(b.l_suppkey || '-' || b.unit) AS provider_unit_sk, b.l_suppkey AS provider_id, upper(s_name) AS provider_name,
           b.unit AS unit_id, n_name AS unit_name, coalesce(n_visits, 0) AS n_visits, coalesce(n_notes, 0) AS n_notes
    FROM b LEFT JOIN supplier ON s_suppkey = b.l_suppkey LEFT JOIN nation ON n_nationkey = b.unit
    LEFT JOIN v ON v.l_suppkey = b.l_suppkey AND v.unit = b.unit LEFT JOIN e ON e.l_suppkey = b.l_suppkey AND e.unit = b.unit
    """,
)
def fact_metric_rollup(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("provider_id"),
        (F.col("l_partkey") % 25).cast("int").alias("unit_id"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_tax",
    )
    bridge = lines.filter("l_quantity > 48").select("provider_id", "unit_id").distinct()
    visits = lines.filter(F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("X")) != "R").withColumnRenamed("l_orderkey", "visit_id")
    notes = lines.filter("l_linestatus = 'F' and l_tax >= 0.07").withColumn("note_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    providers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("provider_id"), F.upper("s_name").alias("provider_name"))
    units = table(spark, sf, "nation").select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit_name"))
    return provider_unit_mart(bridge, providers, units, visits, notes)


@query(
    "interaction_tracking",
    """
    WITH i AS (SELECT user_id AS person, CAST(user_id % 25 AS INTEGER) AS unit, 'note' AS kind, CAST(ts AS DATE) AS d FROM events WHERE props IS NOT NULL AND event_type <> 'error'
               UNION ALL SELECT o_custkey, CAST(o_orderkey % 25 AS INTEGER), 'visit', CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus <> 'P')
    SELECT person, unit, bool_or(kind = 'visit') AS has_visit, bool_or(kind = 'note') AS has_note, count(*) FILTER (WHERE kind = 'visit') AS n_visit,
           count(*) FILTER (WHERE kind = 'note') AS n_note, min(d) AS first_date, max(d) AS last_date
    FROM i GROUP BY 1, 2
    """,
)
def interaction_tracking(spark, sf):
    notes = table(spark, sf, "events").filter("props is not null and event_type <> 'error'").select(
        F.col("user_id").alias("person"), (F.col("user_id") % 25).cast("int").alias("unit"), F.lit("note").alias("kind"), F.to_date("ts").alias("d")
    )
    visits = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_custkey").alias("person"), (F.col("o_orderkey") % 25).cast("int").alias("unit"), F.lit("visit").alias("kind"),
        F.to_date("o_orderdate").alias("d"),
    )
    return track_interactions(notes.unionByName(visits), ["person", "unit"], "kind", "d", ["visit", "note"])


@query(
    "date_spine_occupancy",
    """
    WITH c AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events GROUP BY 1, 2),
    x AS (SELECT user_id, event_type, e, date_diff('day', s, e) + 1 AS stay, CAST(u.d AS DATE) AS ref_date
          FROM c, unnest(generate_series(s, least(e, DATE '2024-01-30'), INTERVAL 1 DAY)) AS u(d))
    SELECT ref_date, event_type, coalesce(n_name, 'unknown') AS place,
           CASE WHEN stay <= 7 THEN 'up to 7 days' WHEN stay <= 14 THEN '8 to 14 days' WHEN stay <= 28 THEN '15 to 28 days'
                ELSE 'over 28 days' END AS band,
           count(*) AS n_cycles, count(*) FILTER (WHERE e = DATE '2024-01-30') AS n_open, count(DISTINCT user_id) AS n_users
    FROM x LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2, 3, 4
    """,
)
def date_spine_occupancy(spark, sf):
    cycles = event_cycles(spark, sf)
    limits = [(7, "up to 7 days"), (14, "8 to 14 days"), (28, "15 to 28 days")]
    stay = stay_days(F.col("start_day"), F.coalesce("end_day", F.lit(EVENTS_AS_OF).cast("date")))
    places = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    places = places.select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("place"))
    known = cycles.withColumn("band", bands(stay, limits, "over 28 days")).join(places, "user_id", "left")
    known = known.withColumn("place", F.coalesce("place", F.lit("unknown")))
    # a user has one cycle per type, so users are counted without a distinct
    measures = {"n_cycles": F.lit(1), "n_open": F.when(F.col("end_day").isNull(), 1).otherwise(0), "n_users": F.when(F.col("user_id").isNotNull(), 1).otherwise(0)}
    return occupancy_by_day(known, ["event_type", "place", "band"], "start_day", "end_day", EVENTS_AS_OF, measures)


@query(
    "latest_row",
    """
    SELECT * EXCLUDE (ts), CAST(ts AS DATE) AS day FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest_row(spark, sf):
    newest = best_row(table(spark, sf, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return newest.withColumn("day", F.to_date("ts")).drop("ts")


@query(
    "prioritized_latest_row",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey) = 1
    """,
)
def prioritized_latest_row(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    active_first = F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    return best_row(orders, ["o_custkey"], [active_first, F.col("day"), -F.col("o_orderkey")])


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "double_rank_dedup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1
        AND row_number() OVER (PARTITION BY l_partkey, l_returnflag, CAST(l_shipdate AS DATE) ORDER BY l_shipdate, l_linenumber, l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1
    """,
)
def double_rank_dedup(spark, sf):
    rest = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = table(spark, sf, "lineitem").select(*LINE, *rest, "l_returnflag", "l_shipdate", F.to_date("l_shipdate").alias("day"))
    by_order = F.struct("l_shipdate", "l_linenumber", "l_partkey", *rest)
    by_part = F.struct("l_shipdate", "l_linenumber", "l_orderkey", "l_suppkey", *rest)
    by_supplier, by_day = ["l_orderkey", "l_suppkey"], ["l_partkey", "l_returnflag", "day"]
    known = key_statistics(lines, by_supplier, by_day)
    ranked = attach_group(lines, by_supplier, {"first_a": F.min(by_order)}, LINE, count_on=known)
    ranked = attach_group(ranked, by_day, {"first_b": F.min(by_part)}, LINE, count_on=known)
    return ranked.filter((F.col("first_a") == by_order) & (F.col("first_b") == by_part)).select(*LINE)


@query(
    "duplicate_flag",
    """
    SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE), hour(ts) ORDER BY event_id) > 1
           THEN 'duplicate' ELSE 'first' END AS mark
    FROM events
    """,
)
def duplicate_flag(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"), F.hour("ts").alias("h"))
    first = attach_group(events, ["user_id", "event_type", "day", "h"], {"first_id": F.min("event_id")}, ["event_id"])
    mark = F.when(F.col("event_id") == F.col("first_id"), "first").otherwise("duplicate")
    return first.select("event_id", "user_id", mark.alias("mark"))


@query(
    "family_total_window",
    """
    WITH t AS (SELECT o_orderkey, o_custkey, date_trunc('year', o_orderdate) AS yr, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
    w AS (SELECT o_orderkey, o_custkey, sum(v) OVER (PARTITION BY o_custkey, yr) AS total FROM t)
    SELECT o_orderkey, o_custkey, CAST(total AS DOUBLE) AS family_total,
           CASE WHEN total <= 100000 THEN 'ate 100k' WHEN total <= 400000 THEN '100k a 400k' ELSE 'acima de 400k' END AS family_band
    FROM w
    """,
)
def family_total_window(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("yr"), cents("o_totalprice").alias("v")
    )
    total = group_total(orders, ["o_custkey", "yr"], F.col("v"), "family_total", ["o_orderkey"])
    band = bands(F.col("family_total"), [(100_000, "ate 100k"), (400_000, "100k a 400k")], "acima de 400k")
    return total.select("o_orderkey", "o_custkey", F.col("family_total").cast("double").alias("family_total"), band.alias("family_band"))


@query(
    "tagged_union",
    """
    WITH u AS (SELECT 'order' AS origin, o_custkey AS person, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS code, CAST(NULL AS BIGINT) AS family FROM orders
               UNION ALL SELECT 'event', user_id, CAST(ts AS DATE), NULL, NULL FROM events
               UNION ALL SELECT 'talk', NULL, NULL, role, conv_id FROM conversations)
    SELECT origin, count(*) AS n_rows, count(person) AS n_person, count(day) AS n_day, count(code) AS n_code, count(family) AS n_family,
           count(DISTINCT md5(origin || '-' || coalesce(CAST(person AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || coalesce(CAST(family AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS n_keys
    FROM u GROUP BY 1
    """,
)
def tagged_union(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.lit("order").alias("origin"), F.col("o_custkey").alias("person"), F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("code")
    )
    events = table(spark, sf, "events").select(F.lit("event").alias("origin"), F.col("user_id").alias("person"), F.to_date("ts").alias("day"))
    talks = table(spark, sf, "conversations").select(F.lit("talk").alias("origin"), F.col("role").alias("code"), F.col("conv_id").alias("family"))
    union = orders.unionByName(events, allowMissingColumns=True).unionByName(talks, allowMissingColumns=True)
    keyed = union.withColumn("sk", surrogate_key(F.col("origin"), F.col("person"), F.col("family")))
    return keyed.groupBy("origin").agg(
        count_rows("n_rows"),
        *[F.count(c).alias(f"n_{c}") for c in ("person", "day", "code", "family")],
        F.count_distinct("sk").alias("n_keys"),
    )
