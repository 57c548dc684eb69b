"""Data-quality suites over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.plans.casework import Casework, raw_sql
from caseloom.plans.nested import unit_capacity
from caseloom.plans.registry import query
from caseloom.quality.rules import (
    accepted,
    consistent,
    covered_by,
    disjoint,
    holds,
    labelled,
    not_null,
    reconcile,
    references,
    run_rules,
    store_failures,
    summary,
    unique,
)
from caseloom.session import run_path
from caseloom.sources.tables import table


@query(
    "dq_suite",
    """
    WITH o AS (SELECT *, CASE WHEN o_orderkey % 40 <> 0 THEN o_orderstatus END AS status FROM orders),
    r AS (SELECT 'not_null_status' AS rule, 'error' AS severity, (SELECT count(*) FROM o WHERE status IS NULL) AS n
      UNION ALL SELECT 'unique_o_orderkey', 'error', (SELECT count(*) FROM (SELECT o_orderkey FROM o GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'unique_o_custkey_o_orderdate', 'warn', (SELECT count(*) FROM (SELECT o_custkey, o_orderdate FROM o WHERE status = 'F' GROUP BY 1, 2 HAVING count(*) > 1))
      UNION ALL SELECT 'accepted_status', 'warn', (SELECT count(*) FROM o WHERE status NOT IN ('F', 'O'))
      UNION ALL SELECT 'references_o_custkey', 'error', (SELECT count(DISTINCT o_custkey) FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
      UNION ALL SELECT 'disjoint_o_custkey', 'warn', (SELECT count(DISTINCT o_custkey) FROM o WHERE o_custkey IN (SELECT user_id FROM events))
      UNION ALL SELECT 'covered_o_orderkey', 'error', (SELECT count(*) FROM o WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
      UNION ALL SELECT 'price_positive', 'error', (SELECT count(*) FROM o WHERE NOT (o_totalprice > 2000)))
    SELECT 'orders' AS table_name, rule, severity, CASE WHEN n = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status, n AS n_failed FROM r
    """,
)
def dq_suite(spark, sf):
    orders = table(spark, sf, "orders").withColumn("status", F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderstatus")))
    rules = [
        not_null("status"),
        unique("o_orderkey"),
        unique("o_custkey", "o_orderdate", severity="warn", where="status = 'F'"),
        accepted("status", ["F", "O"], severity="warn"),
        references("o_custkey", table(spark, sf, "customer").filter("c_acctbal > 0"), "c_custkey"),
        disjoint("o_custkey", table(spark, sf, "events"), "user_id", severity="warn"),
        covered_by("o_orderkey", table(spark, sf, "lineitem"), "l_orderkey"),
        holds("price_positive", F.col("o_totalprice") > 2000),
    ]
    return run_rules("orders", orders, rules)


@query(
    "dq_business_rule",
    """
    WITH u AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END AS managed, CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey * 4 END AS beds,
                      CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 0 END + s_nationkey % 3 AS blocked FROM supplier),
    c AS (SELECT s_suppkey, managed, CASE WHEN managed = 'S' THEN coalesce(p_size, 0) + CASE WHEN p_partkey % 4 <> 0 THEN p_size + 3 ELSE 0 END + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END
                 ELSE coalesce(beds, 0) END AS total, blocked FROM u LEFT JOIN part ON s_suppkey = p_partkey)
    SELECT failure, count(*) AS n_units, min(s_suppkey) AS first_unit FROM (
      SELECT s_suppkey, CASE WHEN managed IS DISTINCT FROM 'S' AND total = 0 THEN 'no beds' WHEN total - blocked < 0 THEN 'more blocked than places'
                             WHEN managed = 'S' AND total > 90 THEN 'too many places' END AS failure FROM c) WHERE failure IS NOT NULL GROUP BY 1
    """,
)
def dq_business_rule(spark, sf):
    managed = F.coalesce(F.col("managed") == "S", F.lit(False))
    label = (
        F.when(~managed & (F.col("total_places") == 0), "no beds")
        .when(F.col("available_places") < 0, "more blocked than places")
        .when(managed & (F.col("total_places") > 90), "too many places")
    )
    failing = labelled("capacity", label).run(unit_capacity(spark, sf))
    return failing.groupBy("failure").agg(F.count(F.lit(1)).alias("n_units"), F.min("s_suppkey").alias("first_unit"))


@query(
    "dq_reconcile_totals",
    """
    WITH a AS (SELECT count(DISTINCT l_orderkey) AS n_orders, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem),
    b AS (SELECT count(*) AS n_orders, CAST(sum(q) AS BIGINT) AS quantity FROM (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1))
    SELECT 'lines to orders' AS check_name, a.n_orders AS left_n_orders, b.n_orders AS right_n_orders, a.n_orders - b.n_orders AS diff_n_orders,
           a.quantity AS left_quantity, b.quantity AS right_quantity, a.quantity - b.quantity AS diff_quantity FROM a, b
    """,
)
def dq_reconcile_totals(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    matched = lines.join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    totals = [F.count("l_orderkey").alias("n_orders"), F.sum("q").alias("quantity")]
    return reconcile("lines to orders", lines.agg(*totals), matched.agg(*totals))


FLAGGED_SQL = f"""
    {raw_sql()}, v AS (SELECT visit_id, person_id, provider_id, shared_providers, CASE WHEN visit_id % 4 <> 0 AND visit_id % 50 <> 3 OR visit_id % 60 = 0 THEN 'Sim' ELSE 'Não' END AS shared FROM visits),
    bad AS (SELECT visit_id, 'shared_flag' AS rule FROM v WHERE (shared = 'Sim') <> (trim(coalesce(shared_providers, '')) <> '')
            UNION ALL SELECT visit_id, 'not_null_provider_id' FROM v WHERE provider_id IS NULL UNION ALL SELECT visit_id, 'not_null_person_id' FROM v WHERE person_id IS NULL)
"""


def flagged_visits(spark, sf):
    """Visits with a yes/no flag for shared ones, some of them wrong."""
    key = F.col("visit_id")
    said = ((key % 4 != 0) & (key % 50 != 3)) | (key % 60 == 0)
    visits = Casework(spark, sf).raw("visits").select("visit_id", "person_id", "provider_id", "shared_providers")
    rules = [
        consistent("shared_flag", F.col("shared"), F.col("shared_providers")),
        not_null("provider_id", severity="warn"),
        not_null("person_id"),
        unique("visit_id"),
    ]
    return visits.withColumn("shared", F.when(said, "Sim").otherwise("Não")), rules


@query(
    "dq_run_summary",
    f"""
    WITH {FLAGGED_SQL}, r AS (
      SELECT 'shared_flag' AS rule, 'fail' AS otherwise, count(*) FILTER (WHERE rule = 'shared_flag') AS n FROM bad
      UNION ALL SELECT 'not_null_provider_id', 'warn', count(*) FILTER (WHERE rule = 'not_null_provider_id') FROM bad
      UNION ALL SELECT 'not_null_person_id', 'fail', count(*) FROM v WHERE person_id IS NULL
      UNION ALL SELECT 'unique_visit_id', 'fail', count(*) FROM (SELECT visit_id FROM v GROUP BY 1 HAVING count(*) > 1))
    SELECT CASE WHEN n = 0 THEN 'pass' ELSE otherwise END AS status, count(*) AS n_rules, CAST(sum(n) AS BIGINT) AS n_failed, string_agg(rule, ', ' ORDER BY rule) AS rules FROM r GROUP BY 1
    """,
)
def dq_run_summary(spark, sf):
    visits, rules = flagged_visits(spark, sf)
    return summary(run_rules("visits", visits, rules))


@query("dq_stored_failures", f"WITH {FLAGGED_SQL} SELECT rule, visit_id, shared_providers, shared FROM bad JOIN v USING (visit_id)")
def dq_stored_failures(spark, sf):
    """Offending rows of the row rules, stored in one scan and read back."""
    visits, rules = flagged_visits(spark, sf)
    folder = run_path(spark, "failures")
    store_failures("visits", visits, rules[:3], folder)
    return spark.read.parquet(folder).select("rule", "visit_id", "shared_providers", "shared")
