"""Projections, filters, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.codes import KEEP, Domain, bands, flag_label, map_domain
from caseloom.functions.dates import (
    age,
    clamp_to_year_start,
    date_to_epoch_millis,
    epoch_millis_to_date,
    parse_date,
    stay_days,
)
from caseloom.functions.documents import doc_digits, doc_format, doc_status
from caseloom.functions.keys import surrogate_key
from caseloom.functions.text import hhmm, hhmm_from_number
from caseloom.operators.explode import nest_children
from caseloom.operators.incremental import latest_partition
from caseloom.operators.skew import distinct_right
from caseloom.plans.registry import query
from caseloom.session import run_path
from caseloom.sources.tables import project, read_seed, replace_columns, stamped, table

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"


@query(
    "scan_project_rename",
    """
    SELECT s_suppkey AS unit_id, s_name AS unit_name, s_nationkey AS region_id, s_acctbal > 0 AS is_active
    FROM supplier
    """,
)
def scan_project_rename(spark, sf):
    return project(
        table(spark, sf, "supplier"),
        {"unit_id": "s_suppkey", "unit_name": "s_name", "region_id": "s_nationkey", "is_active": F.col("s_acctbal") > 0},
    )


@query("star_except", "SELECT * EXCLUDE (p_brand, p_retailprice) REPLACE (p_size * 10 AS p_size) FROM part")
def star_except(spark, sf):
    return replace_columns(table(spark, sf, "part"), ("p_brand", "p_retailprice"), p_size=F.col("p_size") * 10)


PRICE_LIMITS = [(50_000, "up to 50k"), (150_000, "50k to 150k"), (300_000, "150k to 300k")]


@query(
    "case_bucketing",
    """
    SELECT CASE WHEN o_totalprice <= 50000 THEN 'up to 50k' WHEN o_totalprice <= 150000 THEN '50k to 150k'
                WHEN o_totalprice <= 300000 THEN '150k to 300k' ELSE 'above 300k' END AS band,
           count(*) AS n_orders, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
    FROM orders GROUP BY 1
    """,
)
def case_bucketing(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.groupBy(bands(F.col("o_totalprice"), PRICE_LIMITS, "above 300k").alias("band")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")
    )


FLAG_LABELS = {
    (False, False, False): "plain",
    (True, False, False): "returned only",
    (False, True, False): "discounted only",
    (False, False, True): "large only",
    (True, True, True): "returned, discounted and large",
    (True, True, False): "returned and discounted",
}


@query(
    "flag_combination",
    """
    WITH f AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS r, bool_or(l_discount >= 0.08) AS d,
                      bool_or(l_quantity >= 45) AS q FROM lineitem GROUP BY 1)
    SELECT CASE WHEN NOT r AND NOT d AND NOT q THEN 'plain' WHEN r AND NOT d AND NOT q THEN 'returned only'
                WHEN NOT r AND d AND NOT q THEN 'discounted only' WHEN NOT r AND NOT d AND q THEN 'large only'
                WHEN r AND d AND q THEN 'returned, discounted and large'
                WHEN r AND d AND NOT q THEN 'returned and discounted' ELSE 'other' END AS label,
           count(*) AS n_orders
    FROM f GROUP BY 1
    """,
)
def flag_combination(spark, sf):
    flags = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("r"),
        F.bool_or(F.col("l_discount") >= 0.08).alias("d"),
        F.bool_or(F.col("l_quantity") >= 45).alias("q"),
    )
    label = flag_label([F.col("r"), F.col("d"), F.col("q")], FLAG_LABELS, "other")
    return flags.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n_orders"))


@query(
    "not_like_null_semantics",
    """
    WITH c AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS name FROM customer)
    SELECT count(*) AS n_rows,
           count(*) FILTER (WHERE name NOT LIKE '%9') AS n_unguarded,
           count(*) FILTER (WHERE name IS NULL OR name NOT LIKE '%9') AS n_guarded
    FROM c
    """,
)
def not_like_null_semantics(spark, sf):
    name = F.when(F.col("c_custkey") % 7 != 0, F.col("c_name"))
    people = table(spark, sf, "customer").select(name.alias("name"))
    kept = ~F.col("name").like("%9")
    return people.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(kept).alias("n_unguarded"),
        F.count_if(F.col("name").isNull() | kept).alias("n_guarded"),
    )


@query(
    "like_classifier",
    """
    SELECT CASE WHEN p_type LIKE 'ECON%' THEN 'economy' WHEN p_name LIKE '%widget%' THEN 'widget'
                WHEN lower(p_type) = 'promo' THEN 'promotion' ELSE p_type END AS class,
           count(*) AS n_parts
    FROM part GROUP BY 1
    """,
)
def like_classifier(spark, sf):
    label = (
        F.when(F.col("p_type").like("ECON%"), "economy")
        .when(F.col("p_name").like("%widget%"), "widget")
        .when(F.lower("p_type") == "promo", "promotion")
        .otherwise(F.col("p_type"))
    )
    return table(spark, sf, "part").groupBy(label.alias("class")).agg(F.count(F.lit(1)).alias("n_parts"))


@query("regex_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)RING|^old|gear$')")
def regex_filter(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").rlike("(?i)RING|^old|gear$")).select("p_partkey", "p_name")


@query(
    "semi_join",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
)
def semi_join(spark, sf):
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    keys = distinct_right(urgent, "o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    return table(spark, sf, "customer").join(keys, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(
    "string_basics",
    """
    SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS upper_name, replace(c_name, '#', '-') AS dashed,
           substr(c_name, 10) AS tail, right(c_name, 3) AS last_three, length(c_name) AS name_length,
           lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS nation_code,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END || '/' || c_name AS joined
    FROM customer
    """,
)
def string_basics(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.upper(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("upper_name"),
        F.replace("c_name", F.lit("#"), F.lit("-")).alias("dashed"),
        F.col("c_name").substr(F.lit(10), F.length("c_name")).alias("tail"),
        F.right("c_name", F.lit(3)).alias("last_three"),
        F.length("c_name").cast("long").alias("name_length"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("nation_code"),
        F.concat(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")), F.lit("/"), "c_name").alias("joined"),
    )


@query(
    "hhmm_format",
    """
    WITH e AS (SELECT event_id, hour(ts) * 100 + minute(ts) AS n FROM events),
    t AS (SELECT event_id, n, CASE WHEN event_id % 5 = 0 THEN 'at ' || n || 'h' ELSE CAST(n AS VARCHAR) END AS txt FROM e)
    SELECT event_id, txt,
           CASE WHEN length(txt) BETWEEN 1 AND 4 THEN substr(lpad(txt, 4, '0'), 1, 2) || ':' || substr(lpad(txt, 4, '0'), 3, 2)
                ELSE txt END AS clock_text,
           printf('%02d:%02d', n // 100, n % 100) AS clock
    FROM t
    """,
)
def hhmm_format(spark, sf):
    events = table(spark, sf, "events").select("event_id", (F.hour("ts") * 100 + F.minute("ts")).alias("n"))
    text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("at "), F.col("n").cast("string"), F.lit("h"))).otherwise(
        F.col("n").cast("string")
    )
    return events.withColumn("txt", text).select(
        "event_id", "txt", hhmm(F.col("txt")).alias("clock_text"), hhmm_from_number(F.col("n")).alias("clock")
    )


@query(
    "safe_casts",
    """
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey || 'x'
                                       WHEN o_orderkey % 5 = 1 THEN NULL ELSE ' ' || o_custkey || ' ' END AS txt,
                      CASE WHEN o_orderkey % 5 = 2 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
                      CASE WHEN o_orderkey % 5 = 3 THEN '1998-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
               FROM orders)
    SELECT o_orderkey, TRY_CAST(trim(txt) AS BIGINT) AS as_long, CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS as_amount,
           TRY_CAST(day AS DATE) AS as_day
    FROM t
    """,
)
def safe_casts(spark, sf):
    key = F.col("o_orderkey") % 5
    customer = F.col("o_custkey").cast("string")
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key == 0, F.concat(customer, F.lit("x")))
        .when(key != 1, F.concat(F.lit(" "), customer, F.lit(" ")))
        .alias("txt"),
        F.when(key == 2, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(key == 3, "1998-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    return texts.select(
        "o_orderkey",
        F.trim("txt").try_cast("long").alias("as_long"),
        F.col("amount").try_cast("decimal(18,2)").cast("double").alias("as_amount"),
        F.col("day").try_cast("date").alias("as_day"),
    )


@query(
    "safe_date_parse",
    """
    WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'sem data' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
                                  WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS txt
               FROM orders)
    SELECT o_orderkey, txt, CAST(coalesce(try_strptime(txt, '%Y-%m-%d'), try_strptime(txt, '%d/%m/%Y'),
                                          try_strptime(txt, '%Y%m%d')) AS DATE) AS parsed
    FROM t
    """,
)
def safe_date_parse(spark, sf):
    key = F.col("o_orderkey") % 5
    text = (
        F.when(key == 0, "sem data")
        .when(key == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key == 2, F.date_format("o_orderdate", "yyyyMMdd"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    texts = table(spark, sf, "orders").select("o_orderkey", text.alias("txt"))
    return texts.withColumn("parsed", parse_date(F.col("txt"), "yyyy-MM-dd", "d/M/yyyy", "yyyyMMdd"))


@query(
    "epoch_millis_dates",
    """
    SELECT o_orderkey, epoch_ms(o_orderdate) AS millis,
           CAST(make_timestamp((epoch_ms(o_orderdate) + 61200000) * 1000) AS DATE) AS back,
           strftime(o_orderdate, '%d/%m/%Y') AS shown
    FROM orders
    """,
)
def epoch_millis_dates(spark, sf):
    millis = date_to_epoch_millis(F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        millis.alias("millis"),
        epoch_millis_to_date(millis + 61_200_000).alias("back"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("shown"),
    )


@query(
    "clamp_to_year_start",
    """
    SELECT o_orderkey, greatest(CAST(o_orderdate AS DATE), make_date(1998, 1, 1)) AS counted_from,
           date_diff('day', greatest(CAST(o_orderdate AS DATE), make_date(1998, 1, 1)), DATE '2001-08-01') + 1 AS days_counted
    FROM orders
    """,
)
def clamp_year(spark, sf):
    start = clamp_to_year_start(F.to_date("o_orderdate"), 1998)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        start.alias("counted_from"),
        stay_days(start, F.lit(ORDERS_AS_OF).cast("date")).cast("long").alias("days_counted"),
    )


@query(
    "array_functions",
    """
    WITH t AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL
                      ELSE string_split(lower(c_mktsegment) || ' ' || replace(c_name, '#', ' ') || ' de', ' ') END AS a
               FROM customer)
    SELECT c_custkey, coalesce(len(a), 0) AS n_tokens, CASE WHEN coalesce(len(a), 0) > 0 THEN 'Sim' ELSE 'Não' END AS has_tokens,
           array_to_string(list_filter(a, lambda x: x <> 'de'), '+') AS kept,
           array_to_string(list_transform(a, lambda x: upper(x)), '|') AS upper_tokens,
           coalesce(list_contains(a, 'Customer'), false) AS has_word, a[1] AS first_token
    FROM t
    """,
)
def array_functions(spark, sf):
    text = F.concat(F.lower("c_mktsegment"), F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(" ")), F.lit(" de"))
    tokens = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.split(text, " ")).alias("a"))
    size = F.coalesce(F.array_size("a"), F.lit(0)).cast("long")
    return tokens.select(
        "c_custkey",
        size.alias("n_tokens"),
        F.when(size > 0, "Sim").otherwise("Não").alias("has_tokens"),
        F.array_join(F.filter("a", lambda t: t != "de"), "+").alias("kept"),
        F.array_join(F.transform("a", F.upper), "|").alias("upper_tokens"),
        F.coalesce(F.array_contains("a", "Customer"), F.lit(False)).alias("has_word"),
        F.get("a", F.lit(0)).alias("first_token"),
    )


@query(
    "age_variants",
    """
    WITH b AS (SELECT c_custkey, DATE '1935-01-01' + CAST((c_custkey * 37) % 24000 AS INTEGER) AS birth FROM customer)
    SELECT c_custkey, birth,
           CAST(2001 - year(birth) - CASE WHEN 801 < month(birth) * 100 + day(birth) THEN 1 ELSE 0 END AS INTEGER) AS exact_age,
           CAST(2001 - year(birth) - CASE WHEN dayofyear(birth) > dayofyear(DATE '2001-08-01') THEN 1 ELSE 0 END AS INTEGER) AS doy_age,
           CAST(2001 - year(birth) AS INTEGER) AS boundary_age
    FROM b
    """,
)
def age_variants(spark, sf):
    birth = F.date_add(F.lit("1935-01-01").cast("date"), ((F.col("c_custkey") * 37) % 24000).cast("int"))
    people = table(spark, sf, "customer").select("c_custkey", birth.alias("birth"))
    return people.select(
        "*",
        age(F.col("birth"), ORDERS_AS_OF).alias("exact_age"),
        age(F.col("birth"), ORDERS_AS_OF, "dayofyear").alias("doy_age"),
        age(F.col("birth"), ORDERS_AS_OF, "boundary").alias("boundary_age"),
    )


def event_cycles(spark, sf):
    """Stay cycles per (user, type): first to last event day, open when it reaches the as-of day."""
    days = table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    cycles = days.groupBy("user_id", "event_type").agg(F.min("day").alias("start_day"), F.max("day").alias("last_day"))
    closed = F.when(F.col("last_day") < F.lit(EVENTS_AS_OF).cast("date"), F.col("last_day"))
    return cycles.withColumn("end_day", closed)


@query(
    "stay_length",
    """
    WITH c AS (SELECT user_id, event_type, min(CAST(ts AS DATE)) AS start_day, max(CAST(ts AS DATE)) AS last_day
               FROM events GROUP BY 1, 2)
    SELECT md5(CAST(user_id AS VARCHAR) || '-' || event_type) AS stay_sk, user_id, event_type, start_day,
           CASE WHEN last_day < DATE '2024-01-30' THEN last_day END AS end_day,
           CASE WHEN last_day < DATE '2024-01-30' THEN date_diff('day', start_day, last_day) + 1 END AS days,
           CASE WHEN last_day < DATE '2024-01-30' THEN 0 ELSE 1 END AS is_open
    FROM c WHERE start_day <= DATE '2024-01-30'
    """,
)
def stay_length(spark, sf):
    cycles = event_cycles(spark, sf).filter(F.col("start_day") <= F.lit(EVENTS_AS_OF).cast("date"))
    return cycles.select(
        surrogate_key(F.col("user_id"), F.col("event_type")).alias("stay_sk"),
        "user_id",
        "event_type",
        "start_day",
        "end_day",
        stay_days(F.col("start_day"), F.col("end_day")).cast("long").alias("days"),
        F.when(F.col("end_day").isNull(), 1).otherwise(0).alias("is_open"),
    )


@query(
    "document_number_format",
    """
    WITH t AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '---'
                      WHEN 2 THEN '12345678901' || CAST(c_custkey AS VARCHAR)
                      WHEN 3 THEN '529.982.' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-25'
                      ELSE CAST(c_custkey AS VARCHAR) END AS raw FROM customer),
    d AS (SELECT c_custkey, raw, regexp_replace(coalesce(raw, ''), '[^0-9]', '', 'g') AS dig FROM t),
    p AS (SELECT *, CASE WHEN length(dig) BETWEEN 1 AND 11 THEN lpad(dig, 11, '0') ELSE dig END AS digits,
                 CASE WHEN dig = '' THEN 'empty' WHEN length(dig) <= 11 THEN 'ok' ELSE 'invalid' END AS status FROM d)
    SELECT c_custkey, digits, status,
           CASE WHEN status = 'ok' THEN substr(digits, 1, 3) || '.' || substr(digits, 4, 3) || '.' || substr(digits, 7, 3)
                || '-' || substr(digits, 10, 2) END AS dotted
    FROM p
    """,
)
def document_number_format(spark, sf):
    key, text = F.col("c_custkey") % 6, F.col("c_custkey").cast("string")
    raw = (
        F.when(key == 0, F.lit(None))
        .when(key == 1, "---")
        .when(key == 2, F.concat(F.lit("12345678901"), text))
        .when(
            key == 3,
            F.concat(F.lit("529.982."), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("-25")),
        )
        .otherwise(text)
    )
    numbers = table(spark, sf, "customer").select("c_custkey", raw.alias("raw"))
    doc = F.col("raw")
    return numbers.select(
        "c_custkey", doc_digits(doc).alias("digits"), doc_status(doc).alias("status"), doc_format(doc).alias("dotted")
    )


STATUS = Domain({"F": "finished", "O": "open"})
STATUS_ELSE = Domain({"F": "finished"}, default="not finished")
PRIORITY_KEEP = Domain({"1-URGENT": "urgent", "5-LOW": "low"}, default=KEEP)
PRIORITY_PREFIX = Domain({"1": "first", "2": "second", "3": "third"}, default="later", match="prefix")
MONTHS = Domain({1: "January", 2: "February"}, default="other month")


@query(
    "domain_map",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status,
           CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'not finished' END AS status_else,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderpriority LIKE '1%' THEN 'first' WHEN o_orderpriority LIKE '2%' THEN 'second'
                WHEN o_orderpriority LIKE '3%' THEN 'third' ELSE 'later' END AS rank_label,
           CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' ELSE 'other month' END AS month_label,
           count(*) AS n_orders
    FROM orders GROUP BY ALL
    """,
)
def domain_map(spark, sf):
    labels = [
        map_domain(F.col("o_orderstatus"), STATUS).alias("status"),
        map_domain(F.col("o_orderstatus"), STATUS_ELSE).alias("status_else"),
        map_domain(F.col("o_orderpriority"), PRIORITY_KEEP).alias("priority"),
        map_domain(F.col("o_orderpriority"), PRIORITY_PREFIX).alias("rank_label"),
        map_domain(F.month("o_orderdate"), MONTHS).alias("month_label"),
    ]
    return table(spark, sf, "orders").groupBy(*labels).agg(F.count(F.lit(1)).alias("n_orders"))


@query(
    "surrogate_key",
    """
    WITH k AS (SELECT md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                          coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) AS sk FROM lineitem)
    SELECT count(*) AS n_rows, count(DISTINCT sk) AS n_keys, min(sk) AS first_key, max(sk) AS last_key FROM k
    """,
)
def surrogate_keys(spark, sf):
    key = surrogate_key(
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.nullif(F.col("l_returnflag"), F.lit("N"))
    )
    keys = table(spark, sf, "lineitem").select(key.alias("sk"))
    return keys.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("sk").alias("n_keys"),
        F.min("sk").alias("first_key"),
        F.max("sk").alias("last_key"),
    )


@query(
    "seed_lookup_join",
    """
    SELECT n.n_nationkey, n.n_name, lower(r.r_name) AS region_label
    FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    """,
)
def seed_lookup_join(spark, sf):
    path = run_path(spark, "seed")
    seed = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("region_id"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("code"),
        F.lower("r_name").alias("region_label"),
    )
    seed.write.csv(path, header=True)
    lookup = read_seed(spark, path, "region_id int, code string, region_label string")
    keyed = table(spark, sf, "nation").withColumn("code", F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
    joined = keyed.join(lookup.select(F.upper("code").alias("code"), "region_label"), "code", "left")
    return joined.select("n_nationkey", "n_name", "region_label")


@query(
    "heartbeat_scalar",
    """
    SELECT o_orderkey, o_orderstatus, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS last_update FROM orders
    """,
)
def heartbeat_scalar(spark, sf):
    orders = table(spark, sf, "orders")
    newest = orders.agg(F.max(F.to_date("o_orderdate")))
    return stamped(orders.select("o_orderkey", "o_orderstatus"), newest, "last_update")


@query(
    "latest_partition_scan",
    """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS part_month FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)
    """,
)
def latest_partition_scan(spark, sf):
    """Orders stored by month, of which the newest folder alone is read."""
    path = run_path(spark, "months")
    months = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("part_month"))
    months.write.partitionBy("part_month").parquet(path)
    stored = spark.read.schema(months.schema).parquet(path)
    return latest_partition(stored, "part_month").select("o_orderkey", "o_custkey", "part_month")


@query(
    "array_exists",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 45)
    """,
)
def array_exists(spark, sf):
    nested = nest_children(
        table(spark, sf, "lineitem"),
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"],
        ["l_linenumber", "l_partkey", "l_suppkey"],
    )
    hit = F.exists("items", lambda i: (i["l_returnflag"] == "R") & (i["l_quantity"] > 45))
    keys = nested.filter(hit).select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf, "orders").join(keys, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus")
