"""Joins: star, outer, semi and anti, patterns, fallbacks, propagation."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.text import contains_any, strip_accents
from caseloom.operators.delta import leavers, new_entrants
from caseloom.operators.skew import best_row, key_statistics, skew_join
from caseloom.operators.timeline import first_where, propagate_forward
from caseloom.plans.registry import query
from caseloom.sources.tables import table


def cents(col: str):
    """Money as exact decimals, so sums do not depend on row order."""
    return F.col(col).cast("decimal(18,2)")


@query(
    "inner_join_filtering_dim",
    """
    SELECT c_mktsegment AS segment, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_acctbal > 0 AND lower(c_name) NOT LIKE '%99' GROUP BY 1
    """,
)
def inner_join_filtering_dim(spark, sf):
    people = table(spark, sf, "customer").filter((F.col("c_acctbal") > 0) & ~F.lower("c_name").like("%99"))
    # one row per customer before the join: a hot customer never travels as rows
    totals = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("amount")
    )
    return (
        totals.join(people, "c_custkey")
        .groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(F.sum("n").alias("n_orders"), F.sum("amount").cast("double").alias("revenue"))
    )


@query(
    "star_left_join",
    """
    SELECT r_name AS region, c_mktsegment AS segment, p_type AS part_type, s_acctbal > 5000 AS big_supplier, o_orderstatus AS status,
           count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY ALL
    """,
)
def star_left_join(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", cents("l_extendedprice").alias("price")
    )
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("part_type"))
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), (F.col("s_acctbal") > 5000).alias("big_supplier")
    )
    measures = [
        F.sum("n_lines").alias("n_lines"), F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount")
    ]
    # pre-aggregate to one row per (order, part, supplier), then join the narrow dimensions
    facts = lines.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        F.sum("price").alias("amount"),
    )
    known = key_statistics(lines, ["l_partkey"], ["l_suppkey"])
    facts = skew_join(facts, parts, ["l_partkey"], ["l_orderkey", "l_suppkey"], count_on=known)
    facts = skew_join(facts, suppliers, ["l_suppkey"], ["l_orderkey", "l_partkey"], count_on=known)
    per_order = facts.groupBy("l_orderkey", "part_type", "big_supplier").agg(*measures)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    # a customer without orders is not wanted, an order without customer is
    per_customer = (
        per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"], "left")
        .groupBy("o_custkey", "status", "part_type", "big_supplier")
        .agg(*measures)
    )
    geography = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    customers = table(spark, sf, "customer").join(geography, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    dim = customers.select("c_custkey", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"))
    wide = per_customer.join(dim, per_customer["o_custkey"] == dim["c_custkey"], "left")
    return (
        wide.groupBy("region", "segment", "part_type", "big_supplier", "status")
        .agg(*measures)
        .withColumn("amount", F.col("amount").cast("double"))
    )


@query(
    "full_outer_origin",
    """
    WITH o AS (SELECT o_custkey AS person, count(*) AS n_orders, min(CAST(o_orderdate AS DATE)) AS first_order,
                      min(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderdate AS DATE) END) AS first_urgent
               FROM orders GROUP BY 1),
    e AS (SELECT user_id AS person, count(*) AS n_events, max(CAST(ts AS DATE)) AS last_event FROM events GROUP BY 1)
    SELECT coalesce(o.person, e.person) AS person,
           CASE WHEN o.person IS NOT NULL AND e.person IS NOT NULL THEN 'both' WHEN o.person IS NOT NULL THEN 'orders'
                ELSE 'events' END AS origin,
           o.person IS NOT NULL AS has_orders, e.person IS NOT NULL AS has_events,
           n_orders, first_order, first_urgent, n_events, last_event
    FROM o FULL JOIN e ON o.person = e.person
    """,
)
def full_outer_origin(spark, sf):
    day = F.to_date("o_orderdate")
    ordered = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("person")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min(day).alias("first_order"),
        F.min(F.when(F.col("o_orderpriority") == "1-URGENT", day)).alias("first_urgent"),
    )
    seen = table(spark, sf, "events").groupBy(F.col("user_id").alias("person")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max(F.to_date("ts")).alias("last_event")
    )
    both = ordered.withColumn("has_orders", F.lit(True)).join(seen.withColumn("has_events", F.lit(True)), "person", "full")
    flagged = both.withColumns(
        {"has_orders": F.coalesce("has_orders", F.lit(False)), "has_events": F.coalesce("has_events", F.lit(False))}
    )
    origin = F.when(F.col("has_orders") & F.col("has_events"), "both").when(F.col("has_orders"), "orders").otherwise("events")
    return flagged.withColumn("origin", origin)


# Pattern list: a fixed small table, part of the query.
PATTERNS = {
    r"\bring\b": "Ring line",
    r"^(hot|cold)\b": "Thermal line",
    r"widgets?$": "Widget line",
    r"g(ear|izmo)": "Machine line",
    r"bolt|rod": "Fastener line",
}


@query(
    "regex_theta_join",
    r"""
    WITH pat(pattern, label) AS (VALUES ('\bring\b', 'Ring line'), ('^(hot|cold)\b', 'Thermal line'),
         ('widgets?$', 'Widget line'), ('g(ear|izmo)', 'Machine line'), ('bolt|rod', 'Fastener line'))
    SELECT label, count(*) AS n_parts, count(DISTINCT p_name) AS n_names
    FROM part JOIN pat ON regexp_matches(lower(strip_accents(p_name)), pattern) GROUP BY 1
    """,
)
def regex_theta_join(spark, sf):
    # every pattern is tested in the projection, so no join is needed
    name = F.lower(strip_accents(F.col("p_name")))
    hits = F.array_compact(F.array(*[F.when(name.rlike(p), F.lit(label)) for p, label in PATTERNS.items()]))
    labelled = table(spark, sf, "part").select("p_name", F.explode(hits).alias("label"))
    return labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_parts"), F.count_distinct("p_name").alias("n_names")
    )


@query(
    "normalized_key_join",
    """
    WITH c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN '  Nation_' || c_nationkey WHEN c_custkey % 3 = 1 THEN 'nation_' || c_nationkey || ' '
                      ELSE 'NATION_' || c_nationkey END AS place FROM customer)
    SELECT n_nationkey, n_name, count(*) AS n_customers FROM c JOIN nation ON lower(trim(place)) = lower(trim(n_name)) GROUP BY ALL
    """,
)
def normalized_key_join(spark, sf):
    key, number = F.col("c_custkey") % 3, F.col("c_nationkey").cast("string")
    place = (
        F.when(key == 0, F.concat(F.lit("  Nation_"), number))
        .when(key == 1, F.concat(F.lit("nation_"), number, F.lit(" ")))
        .otherwise(F.concat(F.lit("NATION_"), number))
    )
    counts = table(spark, sf, "customer").groupBy(F.lower(F.trim(place)).alias("place_key")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    nations = table(spark, sf, "nation").withColumn("place_key", F.lower(F.trim("n_name")))
    return nations.join(counts, "place_key").select("n_nationkey", "n_name", "n_customers")


@query(
    "explode_outer_bridge",
    """
    WITH s AS (SELECT s_suppkey, CASE WHEN s_acctbal < 2000 THEN NULL WHEN s_acctbal < 4000 THEN ''
                      ELSE s_nationkey || ', ' || (s_nationkey + 1) || ',' || s_suppkey END AS list FROM supplier)
    SELECT s_suppkey, trim(token) AS token FROM s, unnest(string_split(coalesce(list, ''), ',')) AS u(token)
    """,
)
def explode_outer_bridge(spark, sf):
    nation = F.col("s_nationkey")
    listed = F.concat(
        nation.cast("string"), F.lit(", "), (nation + 1).cast("string"), F.lit(","), F.col("s_suppkey").cast("string")
    )
    text = F.when(F.col("s_acctbal") < 2000, F.lit(None)).when(F.col("s_acctbal") < 4000, "").otherwise(listed)
    rows = table(spark, sf, "supplier").select("s_suppkey", F.coalesce(text, F.lit("")).alias("list"))
    return rows.select("s_suppkey", F.explode_outer(F.split("list", ",")).alias("token")).withColumn("token", F.trim("token"))


@query(
    "fallback_attribution",
    """
    WITH marked AS (SELECT o_custkey, arg_max(CAST(o_orderkey % 25 AS INTEGER), epoch_ms(o_orderdate) // 86400000 * 100000000 + o_orderkey) AS unit
                    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' GROUP BY 1),
    c AS (SELECT c_custkey, m.unit AS marked_unit, CASE WHEN c_acctbal > 3000 THEN c_nationkey END AS home_unit,
                 CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 7 END AS operator_unit
          FROM customer LEFT JOIN marked m ON c_custkey = o_custkey)
    SELECT c_custkey, coalesce(marked_unit, home_unit, operator_unit) AS unit_id,
           CASE WHEN marked_unit IS NOT NULL THEN 'marked' WHEN home_unit IS NOT NULL THEN 'home'
                WHEN operator_unit IS NOT NULL THEN 'operator' ELSE 'none' END AS origin,
           a.n_name AS unit_name, h.n_name AS home_name, a.n_regionkey = 3 AS in_region_three
    FROM c LEFT JOIN nation a ON a.n_nationkey = coalesce(marked_unit, home_unit, operator_unit)
    LEFT JOIN nation h ON h.n_nationkey = home_unit
    """,
)
def fallback_attribution(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'")
    marked = best_row(
        urgent.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]
    ).select(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 25).cast("int").alias("marked_unit"))
    people = table(spark, sf, "customer").join(marked, "c_custkey", "left").select(
        "c_custkey",
        "marked_unit",
        F.when(F.col("c_acctbal") > 3000, F.col("c_nationkey")).alias("home_unit"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit(7)).alias("operator_unit"),
    )
    chain = ["marked_unit", "home_unit", "operator_unit"]
    origin = F.lit("none")
    for name in reversed(chain):
        origin = F.when(F.col(name).isNotNull(), name.removesuffix("_unit")).otherwise(origin)
    chosen = people.withColumn("unit_id", F.coalesce(*chain)).withColumn("origin", origin)
    units = table(spark, sf, "nation")
    attributed = units.select(
        F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit_name"), (F.col("n_regionkey") == 3).alias("in_region_three")
    )
    home = units.select(F.col("n_nationkey").alias("home_unit"), F.col("n_name").alias("home_name"))
    return (
        chosen.join(attributed, "unit_id", "left")
        .join(home, "home_unit", "left")
        .select("c_custkey", "unit_id", "origin", "unit_name", "home_name", "in_region_three")
    )


@query(
    "forward_propagation",
    """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events),
    rows_ AS (SELECT user_id, day, count(*) AS n_events, max(CASE WHEN event_type = 'purchase' THEN v END) AS own FROM d GROUP BY 1, 2),
    f AS (SELECT user_id, day AS first_day, v AS first_value FROM d WHERE event_type = 'purchase'
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day, event_id) = 1)
    SELECT r.user_id, r.day, n_events, first_day,
           CAST(coalesce(own, CASE WHEN first_day <= r.day THEN first_value END) AS DOUBLE) AS purchase_value,
           coalesce(first_day <= r.day, false) AS reached
    FROM rows_ r LEFT JOIN f ON r.user_id = f.user_id
    """,
)
def forward_propagation(spark, sf):
    days = table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_id", "event_type", cents("value").alias("v")
    )
    bought = F.col("event_type") == "purchase"
    rows = days.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("n_events"), F.max(F.when(bought, F.col("v"))).alias("purchase_value")
    )
    firsts = first_where(days, ["user_id"], bought, ["day", "event_id"], ["day", "v"])
    firsts = firsts.withColumnsRenamed({"day": "first_day", "v": "first_value"})
    filled = propagate_forward(rows, firsts, "user_id", "day", "first_day", {"purchase_value": "first_value"})
    return filled.withColumn("purchase_value", F.col("purchase_value").cast("double"))


@query(
    "suggested_status",
    """
    WITH l AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_returned FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL THEN o_orderstatus
                            WHEN any_returned = 1 THEN 'verified' ELSE 'not verified' END AS status
    FROM orders LEFT JOIN l ON o_orderkey = l_orderkey
    """,
)
def suggested_status(spark, sf):
    returned = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("any_returned")
    )
    manual = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    suggestion = F.when(F.col("any_returned") == 1, "verified").otherwise("not verified")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return orders.join(returned, "o_orderkey", "left").select("o_orderkey", F.coalesce(manual, suggestion).alias("status"))


def _presence(spark, sf):
    """Member keys (user and type) by day, the keys known after the first day, and the last day."""
    events = table(spark, sf, "events")
    # both days from one aggregate of the stored column
    span = events.agg(F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last")).first()
    seen = events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("member"), F.to_date("ts").alias("day")
    ).distinct()
    return seen, seen.filter(F.col("day") == F.lit(span["first"])).select("member"), F.lit(span["last"])


PRESENCE_SQL = """
    WITH p AS (SELECT DISTINCT user_id || '-' || event_type AS member, CAST(ts AS DATE) AS day FROM events),
    known AS (SELECT member FROM p WHERE day = (SELECT min(day) FROM p))
"""


@query(
    "new_entrants_anti_join",
    PRESENCE_SQL
    + """
    SELECT member, day FROM p WHERE day = (SELECT max(day) FROM p)
    AND NOT EXISTS (SELECT 1 FROM known k WHERE k.member = p.member)
    """,
)
def new_entrants_anti_join(spark, sf):
    seen, known, last = _presence(spark, sf)
    return new_entrants(seen.filter(F.col("day") == last), known, "member")


@query(
    "leavers_last_seen",
    PRESENCE_SQL
    + """
    SELECT k.member, (SELECT max(day) FROM p WHERE p.member = k.member) AS last_seen FROM known k
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.member = k.member AND p.day = (SELECT max(day) FROM p))
    """,
)
def leavers_last_seen(spark, sf):
    seen, known, last = _presence(spark, sf)
    return leavers(known, seen, "member", "day", last)


@query(
    "admin_account_filter",
    """
    WITH a AS (SELECT s_suppkey AS login_id, CASE s_suppkey % 5 WHEN 0 THEN 'Admin ' WHEN 1 THEN 'x_teste_' WHEN 2 THEN 'SUPORTE'
                      ELSE '' END || s_name AS name FROM supplier)
    SELECT login_id, name FROM a WHERE NOT regexp_matches(name, '(?i)teste|suporte|admin')
    """,
)
def admin_account_filter(spark, sf):
    key = F.col("s_suppkey") % 5
    prefix = F.when(key == 0, "Admin ").when(key == 1, "x_teste_").when(key == 2, "SUPORTE").otherwise("")
    accounts = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("login_id"), F.concat(prefix, "s_name").alias("name"))
    return accounts.filter(~contains_any(F.col("name"), "teste", "suporte", "admin"))
