"""Code lists, shared providers, nested collections and capacity."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.codes import KEEP, Domain, map_list
from caseloom.functions.dates import age
from caseloom.functions.keys import surrogate_key
from caseloom.operators.capacity import code_flags, unify_capacity
from caseloom.operators.explode import explode_codes, explode_id_list, explode_shared, nest_children
from caseloom.operators.skew import best_row, skew_join
from caseloom.plans.projections import ORDERS_AS_OF
from caseloom.plans.registry import query
from caseloom.sources.tables import table


@query(
    "nest_children",
    """
    SELECT l_orderkey, count(*) AS n_items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
           min(l_linenumber) AS first_line, bool_or(l_returnflag = 'R') AS any_returned
    FROM lineitem GROUP BY 1
    """,
)
def nest(spark, sf):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    nested = nest_children(table(spark, sf, "lineitem"), ["l_orderkey"], [*order, "l_returnflag"], order)
    read = nested.select(
        "l_orderkey",
        F.size("items").cast("long").alias("n"),
        F.aggregate("items", F.lit(0).cast("long"), lambda s, i: s + i["l_quantity"].cast("long")).alias("q"),
        F.array_min(F.transform("items", lambda i: i["l_linenumber"])).alias("f"),
        F.exists("items", lambda i: i["l_returnflag"] == "R").alias("r"),
    )
    return read.groupBy("l_orderkey").agg(
        F.sum("n").alias("n_items"), F.sum("q").alias("quantity"), F.min("f").alias("first_line"), F.bool_or("r").alias("any_returned")
    )


BENEFITS = Domain({"1": "family grant", "2": "elderly grant", "7": "food card", "10": "rent aid"})

CODE_TEXT_SQL = """
    CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' n ' WHEN 3 THEN 'N'
    ELSE (c_custkey % 11) || ', ' || (c_custkey % 3) || ',, ' || c_nationkey END
"""


def code_text():
    key = F.col("c_custkey") % 8
    listed = F.concat(
        (F.col("c_custkey") % 11).cast("string"), F.lit(", "), (F.col("c_custkey") % 3).cast("string"),
        F.lit(",, "), F.col("c_nationkey").cast("string"),
    )
    return F.when(key == 0, F.lit(None)).when(key == 1, "").when(key == 2, " n ").when(key == 3, "N").otherwise(listed)


@query(
    "explode_codes",
    f"""
    WITH t AS (SELECT c_custkey, {CODE_TEXT_SQL} AS codes FROM customer),
    x AS (SELECT c_custkey, trim(u.c) AS code FROM t, unnest(string_split(codes, ',')) AS u(c)
          WHERE codes IS NOT NULL AND upper(trim(codes)) <> 'N' AND trim(u.c) <> '')
    SELECT c_custkey, code, CASE code WHEN '1' THEN 'family grant' WHEN '2' THEN 'elderly grant' WHEN '7' THEN 'food card'
                                      WHEN '10' THEN 'rent aid' END AS label
    FROM x
    """,
)
def codes(spark, sf):
    people = table(spark, sf, "customer").withColumn("codes", code_text())
    return explode_codes(people, ["c_custkey"], "codes", BENEFITS)


@query(
    "flag_pivot_from_codes",
    """
    WITH t AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'A' WHEN 2 THEN 'a, F' WHEN 3 THEN 'I,F,A' ELSE 'x' END AS kinds
               FROM supplier)
    SELECT s_suppkey, max(CASE WHEN lower(trim(u.k)) = 'a' THEN 'Sim' ELSE 'Não' END) AS adult,
           max(CASE WHEN lower(trim(u.k)) = 'f' THEN 'Sim' ELSE 'Não' END) AS family,
           max(CASE WHEN lower(trim(u.k)) = 'i' THEN 'Sim' ELSE 'Não' END) AS elderly
    FROM t, unnest(string_split(coalesce(kinds, ''), ',')) AS u(k) GROUP BY 1
    """,
)
def flag_pivot_from_codes(spark, sf):
    exploded = _unit_kinds(spark, sf).select(
        "s_suppkey", F.explode(F.split(F.coalesce("kinds", F.lit("")), ",")).alias("k")
    )
    return code_flags(exploded.withColumn("k", F.trim("k")), ["s_suppkey"], "k", {"adult": "a", "family": "f", "elderly": "i"})


def _unit_kinds(spark, sf):
    key = F.col("s_suppkey") % 5
    kinds = F.when(key == 0, F.lit(None)).when(key == 1, "A").when(key == 2, "a, F").when(key == 3, "I,F,A").otherwise("x")
    return table(spark, sf, "supplier").withColumn("kinds", kinds)


@query(
    "map_list",
    """
    WITH t AS (SELECT o_orderkey, o_orderstatus || ',' || o_orderpriority || ', ' || (o_orderkey % 4) AS list FROM orders)
    SELECT o_orderkey, array_to_string(list_transform(string_split(list, ','), lambda t:
           CASE trim(t) WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN '1-URGENT' THEN 'urgent' WHEN '2' THEN 'two' ELSE trim(t) END), ',') AS labels
    FROM t
    """,
)
def relabel(spark, sf):
    text = F.concat("o_orderstatus", F.lit(","), "o_orderpriority", F.lit(", "), (F.col("o_orderkey") % 4).cast("string"))
    domain = Domain({"F": "finished", "O": "open", "1-URGENT": "urgent", "2": "two"}, default=KEEP)
    return table(spark, sf, "orders").select("o_orderkey", map_list(text, domain).alias("labels"))


@query(
    "explode_shared",
    """
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey END AS main,
                      CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '00' || o_custkey || ',12,, 12 ,x'
                           WHEN 2 THEN '007,7,' || (o_custkey + 1) ELSE '' END AS shared FROM orders),
    s AS (SELECT DISTINCT o_orderkey, main, TRY_CAST(trim(u.p) AS BIGINT) AS p FROM t, unnest(string_split(coalesce(shared, ''), ',')) AS u(p)),
    a AS (SELECT o_orderkey, main AS provider, true AS is_main FROM t
          UNION ALL SELECT o_orderkey, p, false FROM s WHERE p IS NOT NULL AND p IS DISTINCT FROM main)
    SELECT md5(o_orderkey || '-' || coalesce(CAST(provider AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS visit_sk, o_orderkey, provider, is_main FROM a
    """,
)
def shared_providers(spark, sf):
    key, customer = F.col("o_orderkey") % 4, F.col("o_custkey")
    shared = (
        F.when(key == 0, F.lit(None))
        .when(key == 1, F.concat(F.lit("00"), customer.cast("string"), F.lit(",12,, 12 ,x")))
        .when(key == 2, F.concat(F.lit("007,7,"), (customer + 1).cast("string")))
        .otherwise("")
    )
    visits = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 6 != 0, customer).alias("provider"), shared.alias("shared")
    )
    exploded = explode_shared(visits, "provider", "shared")
    return exploded.withColumn("visit_sk", surrogate_key(F.col("o_orderkey"), F.col("provider")))


@query(
    "explode_id_list",
    """
    WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '()' WHEN 2 THEN '' WHEN 3 THEN '(' || o_custkey || ',,x)'
                      ELSE '(' || o_custkey || ',' || (o_custkey + 3) || ', ' || o_custkey || ')' END AS list FROM orders)
    SELECT DISTINCT o_orderkey, TRY_CAST(trim(u.p) AS BIGINT) AS person_id
    FROM t, unnest(string_split(replace(replace(list, '(', ''), ')', ''), ',')) AS u(p) WHERE TRY_CAST(trim(u.p) AS BIGINT) IS NOT NULL
    """,
)
def id_lists(spark, sf):
    key, customer = F.col("o_orderkey") % 5, F.col("o_custkey")
    text = customer.cast("string")
    listed = (
        F.when(key == 0, F.lit(None))
        .when(key == 1, "()")
        .when(key == 2, "")
        .when(key == 3, F.concat(F.lit("("), text, F.lit(",,x)")))
        .otherwise(F.concat(F.lit("("), text, F.lit(","), (customer + 3).cast("string"), F.lit(", "), text, F.lit(")")))
    )
    notes = table(spark, sf, "orders").select("o_orderkey", listed.alias("list"))
    return explode_id_list(notes, "list", "person_id").drop("list")


@query(
    "explode_struct_array",
    "SELECT user_id, event_type AS code, count(*) AS n_events FROM events WHERE event_type <> 'view' GROUP BY 1, 2",
)
def explode_struct_array(spark, sf):
    per_kind = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    # at most one struct per event type
    nested = per_kind.groupBy("user_id").agg(F.collect_list(F.struct(F.col("event_type").alias("code"), F.col("n").alias("n_events"))).alias("kinds"))
    wanted = F.filter("kinds", lambda k: k["code"] != "view")
    return nested.select("user_id", F.explode(wanted).alias("k")).select("user_id", "k.*")


def families(spark, sf):
    """Membership derived from customers: every person in one family, one in four in two."""
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("person"),
        (F.col("c_acctbal") >= 0).alias("active"),
        F.when(
            F.col("c_custkey") % 4 == 0, F.array(F.col("c_custkey") % 500, F.col("c_custkey") % 77 + 1000)
        ).otherwise(F.array(F.col("c_custkey") % 500)).alias("fams"),
    )
    return people.select("person", "active", F.explode("fams").alias("family"))


FAMILIES_SQL = """
    m AS (SELECT c_custkey AS person, c_acctbal >= 0 AS active, c_custkey % 500 AS family FROM customer
          UNION ALL SELECT c_custkey, c_acctbal >= 0, c_custkey % 77 + 1000 FROM customer WHERE c_custkey % 4 = 0)
"""


@query(
    "bridge_dedup_nested",
    f"""
    WITH {FAMILIES_SQL},
    i AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 500 ELSE o_custkey % 77 + 1000 END AS family, o_orderkey % 20 AS project,
                 CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS registered FROM orders),
    j AS (SELECT person, project, max(registered) AS registered FROM m JOIN i USING (family) WHERE active GROUP BY 1, 2)
    SELECT person, count(*) AS n_projects, max(registered) AS last_registered,
           string_agg(project || ':' || coalesce(strftime(registered, '%Y-%m-%d'), '-'), ',' ORDER BY project) AS projects
    FROM j GROUP BY 1
    """,
)
def bridge_dedup_nested(spark, sf):
    in_first = F.col("o_orderkey") % 2 == 0
    items = table(spark, sf, "orders").select(
        F.when(in_first, F.col("o_custkey") % 500).otherwise(F.col("o_custkey") % 77 + 1000).alias("family"),
        (F.col("o_orderkey") % 20).alias("project"),
        F.when(F.col("o_orderkey") % 7 != 0, F.to_date("o_orderdate")).alias("registered"),
    )
    # latest registration per family and project, then one array per family: as long as the project list
    latest = items.groupBy("family", "project").agg(F.max("registered").alias("registered"))
    nested = latest.groupBy("family").agg(F.collect_list(F.struct("project", "registered")).alias("projects"))
    members = families(spark, sf).filter("active").select("person", "family")
    joined = skew_join(members, nested, ["family"], ["person"], how="inner")
    rows = joined.select("person", F.explode("projects").alias("p")).select("person", "p.*")
    kept = best_row(rows, ["person", "project"], [F.col("registered")])
    text = F.concat_ws(":", F.col("project").cast("string"), F.coalesce(F.date_format("registered", "yyyy-MM-dd"), F.lit("-")))
    return kept.withColumn("text", text).groupBy("person").agg(
        F.count(F.lit(1)).alias("n_projects"),
        F.max("registered").alias("last_registered"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("project", "text"))), lambda s: s["text"]), ",").alias("projects"),
    )


@query(
    "json_path_explode",
    """
    WITH t AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
    j AS (SELECT event_id, '{"a": {"codes": "' || k || ', ' || (k + 1) || ',x"}}' AS doc FROM t)
    SELECT event_id, TRY_CAST(trim(u.c) AS BIGINT) AS code FROM j, unnest(string_split(json_extract_string(doc, '$.a.codes'), ',')) AS u(c)
    """,
)
def json_path_explode(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    doc = F.concat(F.lit('{"a": {"codes": "'), k.cast("string"), F.lit(", "), (k + 1).cast("string"), F.lit(',x"}}'))
    docs = table(spark, sf, "events").select("event_id", doc.alias("doc"))
    codes_ = docs.select("event_id", F.explode(F.split(F.get_json_object("doc", "$.a.codes"), ",")).alias("c"))
    return codes_.select("event_id", F.trim("c").try_cast("long").alias("code"))


@query(
    "capacity_unify",
    """
    WITH u AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END AS managed, CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey * 4 END AS beds,
                      CASE WHEN s_suppkey % 2 = 0 THEN 2 END AS blocked_repair, s_nationkey % 3 AS blocked_court FROM supplier),
    p AS (SELECT p_partkey, p_size AS men, CASE WHEN p_partkey % 4 <> 0 THEN p_size + 3 END AS women, CASE WHEN p_partkey % 5 = 0 THEN 1 END AS neutral FROM part)
    SELECT s_suppkey, managed, CASE WHEN managed = 'S' THEN coalesce(men, 0) + coalesce(women, 0) + coalesce(neutral, 0) ELSE coalesce(beds, 0) END AS total_places,
           CASE WHEN managed = 'S' THEN coalesce(men, 0) + coalesce(women, 0) + coalesce(neutral, 0) ELSE coalesce(beds, 0) END
             - coalesce(blocked_repair, 0) - coalesce(blocked_court, 0) AS available_places
    FROM u LEFT JOIN p ON s_suppkey = p_partkey
    """,
)
def capacity_unify(spark, sf):
    return unit_capacity(spark, sf).select("s_suppkey", "managed", "total_places", "available_places")


def unit_capacity(spark, sf):
    unit = F.col("s_suppkey")
    config = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.when(unit % 3 == 0, "S").when(unit % 3 == 1, "N").alias("managed"),
        F.when(unit % 7 != 0, F.col("s_nationkey") * 4).alias("beds"),
        F.when(unit % 2 == 0, 2).alias("blocked_repair"),
        (F.col("s_nationkey") % 3).alias("blocked_court"),
    )
    places = table(spark, sf, "part").select(
        F.col("p_partkey").alias("s_suppkey"),
        F.col("p_size").alias("men"),
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") + 3).alias("women"),
        F.when(F.col("p_partkey") % 5 == 0, 1).alias("neutral"),
    )
    return unify_capacity(
        config.join(places, "s_suppkey", "left"),
        F.col("managed") == "S",
        ["men", "women", "neutral"],
        "beds",
        ["blocked_repair", "blocked_court"],
    )


@query(
    "family_profile",
    f"""
    WITH {FAMILIES_SQL},
    b AS (SELECT c_custkey AS person, c_name, c_acctbal < 0 AS debt, DATE '1990-01-01' + CAST((c_custkey * 37) % 5000 AS INTEGER) AS birth FROM customer),
    o AS (SELECT o_custkey % 500 AS family, 'urgent order' AS origin FROM orders WHERE o_orderpriority = '1-URGENT'
          UNION ALL SELECT o_custkey % 77 + 1000, 'returned line' FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
    og AS (SELECT family, string_agg(DISTINCT origin, ',' ORDER BY origin) AS origins FROM o GROUP BY 1),
    k AS (SELECT family, count(*) AS n_children, min(c_name) AS first_child, max(2001 - year(birth) - CASE WHEN 801 < month(birth) * 100 + day(birth) THEN 1 ELSE 0 END) AS oldest
          FROM m JOIN b USING (person) WHERE active AND 2001 - year(birth) - CASE WHEN 801 < month(birth) * 100 + day(birth) THEN 1 ELSE 0 END BETWEEN 0 AND 6 GROUP BY 1),
    d AS (SELECT family, bool_or(debt) AS any_debt FROM m JOIN b USING (person) GROUP BY 1)
    SELECT og.family, origins, coalesce(n_children, 0) AS n_children, first_child, CAST(oldest AS INTEGER) AS oldest, coalesce(any_debt, false) AS any_debt
    FROM og LEFT JOIN k ON og.family = k.family LEFT JOIN d ON og.family = d.family
    """,
)
def family_profile(spark, sf):
    birth = F.date_add(F.lit("1990-01-01").cast("date"), ((F.col("c_custkey") * 37) % 5000).cast("int"))
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("person"), "c_name", (F.col("c_acctbal") < 0).alias("debt"), age(birth, ORDERS_AS_OF).alias("age")
    )
    members = families(spark, sf).join(people, "person")
    child = F.col("active") & F.col("age").between(0, 6)
    # members, children and flags of a family in one aggregate
    per_family = members.groupBy("family").agg(
        F.count_if(child).alias("n_children"),
        F.min(F.when(child, F.col("c_name"))).alias("first_child"),
        F.max(F.when(child, F.col("age"))).alias("oldest"),
        F.bool_or("debt").alias("any_debt"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select((F.col("o_custkey") % 500).alias("family"), F.lit("urgent order").alias("origin"))
    lines = orders.join(returned, "o_orderkey", "left_semi").select((F.col("o_custkey") % 77 + 1000).alias("family"), F.lit("returned line").alias("origin"))
    origins = urgent.unionByName(lines).groupBy("family").agg(F.array_join(F.array_sort(F.collect_set("origin")), ",").alias("origins"))
    return origins.join(per_family, "family", "left").select(
        "family", "origins", F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child", "oldest",
        F.coalesce("any_debt", F.lit(False)).alias("any_debt"),
    )
