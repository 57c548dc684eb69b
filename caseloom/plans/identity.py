"""Name cleaning and person matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.text import clean_name, digits_key, match_key, standard_name
from caseloom.operators.linked import add_rows, stored_clusters
from caseloom.operators.matching import (
    containment,
    exact_rule_dedup,
    fuzzy_dedup,
    person_rules,
    similar_name_counts,
)
from caseloom.plans.registry import ORACLES, query
from caseloom.session import run_path
from caseloom.sources.tables import table

CLEAN_SQL = r"trim(regexp_replace(regexp_replace(lower(strip_accents({c})), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
STOP_SQL = "('de', 'da', 'do', 'das', 'dos', 'e', 'a', 'o', 'os', 'as')"


@query(
    "clean_name",
    f"SELECT doc_id, md5({CLEAN_SQL.format(c='text')}) AS cleaned_key, length({CLEAN_SQL.format(c='text')}) AS cleaned_length FROM documents",
)
def clean(spark, sf):
    cleaned = table(spark, sf, "documents").select("doc_id", clean_name(F.col("text")).alias("c"))
    return cleaned.select("doc_id", F.md5("c").alias("cleaned_key"), F.length("c").cast("long").alias("cleaned_length"))


@query(
    "standardize_names",
    f"""
    WITH t AS (SELECT conv_id, turn, list_filter(string_split({CLEAN_SQL.format(c='text')}, ' '), lambda w: w NOT IN {STOP_SQL}) AS w FROM conversations)
    SELECT conv_id, turn, md5(array_to_string(w, ' ')) AS name_key, len(w) AS n_words FROM t
    """,
)
def standardize(spark, sf):
    names = table(spark, sf, "conversations").select("conv_id", "turn", standard_name(F.col("text")).alias("n"))
    return names.select("conv_id", "turn", F.md5("n").alias("name_key"), F.size(F.split("n", " ")).cast("long").alias("n_words"))


@query(
    "match_keys",
    f"""
    WITH t AS (SELECT doc_id, upper(array_to_string(list_filter(string_split(regexp_replace(strip_accents(text), '[^a-zA-Z0-9]', ' ', 'g'), ' '),
                      lambda w: lower(w) NOT IN {STOP_SQL}), '')) AS k, regexp_replace(text, '[^0-9]', '', 'g') AS d FROM documents)
    SELECT doc_id, md5(k) AS name_key, length(k) AS name_length, md5(d) AS digit_key, length(d) AS digit_length FROM t
    """,
)
def match(spark, sf):
    keys = table(spark, sf, "documents").select(
        "doc_id", match_key(F.col("text")).alias("k"), digits_key(F.col("text")).alias("d")
    )
    return keys.select(
        "doc_id",
        F.md5("k").alias("name_key"),
        F.length("k").cast("long").alias("name_length"),
        F.md5("d").alias("digit_key"),
        F.length("d").cast("long").alias("digit_length"),
    )


DIGIT_WORDS = ["zero", "um", "dois", "tres", "quatro", "cinco", "seis", "sete", "oito", "nove"]


def registrations(spark, sf):
    """Person registrations made of parts: a name with typing slips and a mother's name."""
    name = F.concat("p_name", F.lit(" "), F.lower("p_type"))
    slip = F.col("p_size") % 8
    typed = (
        F.when(slip == 0, F.concat(F.substring(name, 1, 4), F.substring(name, 4, 40)))
        .when(slip == 1, F.substring(name, 1, F.length(name) - 1))
        .when(slip == 2, F.concat(F.lit("de "), F.upper(name)))
        .when(slip == 3, F.replace(name, F.lit("o"), F.lit("ó")))
        .when(slip == 4, F.concat(F.lower("p_type"), F.lit(" "), "p_name"))
        .otherwise(name)
    )
    mother = F.lower(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    for digit, word in enumerate(DIGIT_WORDS):
        mother = F.replace(mother, F.lit(str(digit)), F.lit(f" {word}"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        standard_name(typed).alias("name"),
        F.when(F.col("p_size") != 50, standard_name(mother)).otherwise("").alias("mother"),
    )


def _digit_words_sql(col: str) -> str:
    for digit, word in enumerate(DIGIT_WORDS):
        col = f"replace({col}, '{digit}', ' {word}')"
    return col


def _standard_sql(col: str) -> str:
    words = f"list_filter(string_split({CLEAN_SQL.format(c=col)}, ' '), lambda w: w NOT IN {STOP_SQL})"
    return f"array_to_string({words}, ' ')"


# Soundex spelled out: letter classes, H and W skipped, runs of one class collapsed,
# vowels and blanks dropped, the first letter kept.
_CLASSES = "translate(regexp_replace(upper(name), '[HW]', '', 'g'), 'ABCDEFGIJKLMNOPQRSTUVXYZ ', '0123012022455012623012020')"
for _c in "0123456":
    _CLASSES = f"regexp_replace({_CLASSES}, '{_c}+', '{_c}', 'g')"
SOUNDEX_SQL = (
    "CASE WHEN name = '' THEN '' ELSE upper(name[1]) || rpad(left(replace("
    f"CASE WHEN upper(name[1]) IN ('H', 'W') THEN {_CLASSES} ELSE substr({_CLASSES}, 2) END, '0', ''), 3), 3, '0') END"
)

REGISTRATIONS_SQL = f"""
    raw AS (SELECT p_partkey AS id, p_name || ' ' || lower(p_type) AS nm, p_size % 8 AS slip, lower(p_type) AS ty, p_name, p_size,
                   {_digit_words_sql("lower(replace(p_brand, '#', ' '))")} AS mo FROM part),
    typed AS (SELECT id, CASE slip WHEN 0 THEN substr(nm, 1, 4) || substr(nm, 4, 40) WHEN 1 THEN substr(nm, 1, length(nm) - 1) WHEN 2 THEN 'de ' || upper(nm)
              WHEN 3 THEN replace(nm, 'o', 'ó') WHEN 4 THEN ty || ' ' || p_name ELSE nm END AS nm, CASE WHEN p_size <> 50 THEN mo ELSE '' END AS mo FROM raw),
    person AS (SELECT id, {_standard_sql('nm')} AS name, {_standard_sql('mo')} AS mother FROM typed),
    keyed AS (SELECT *, {SOUNDEX_SQL} AS k FROM person),
    node AS (SELECT k, name, mother, min(id) AS nid FROM keyed WHERE name <> '' AND mother <> '' GROUP BY 1, 2, 3),
    link AS (SELECT a.nid AS x, b.nid AS y FROM node a JOIN node b ON a.k = b.k
             WHERE (levenshtein(a.name, b.name) <= 2 OR
                    len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) / least(len(string_split(a.name, ' ')), len(string_split(b.name, ' '))) >= 0.8)
               AND (levenshtein(a.mother, b.mother) <= 2 OR
                    len(list_intersect(string_split(a.mother, ' '), string_split(b.mother, ' '))) / least(len(string_split(a.mother, ' ')), len(string_split(b.mother, ' '))) >= 0.8))
"""

CLUSTER_COLUMNS_SQL = """
    SELECT id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size, cluster_id <> id AS is_duplicate FROM labelled
"""


@query(
    "fuzzy_dedup",
    f"""
    WITH RECURSIVE {REGISTRATIONS_SQL},
    whole(a, b) AS (SELECT x, y FROM link UNION SELECT w.a, l.y FROM whole w JOIN link l ON w.b = l.x),
    comp AS (SELECT a AS nid, min(b) AS c FROM whole GROUP BY 1),
    labelled AS (SELECT p.id, coalesce(c, p.id) AS cluster_id FROM keyed p LEFT JOIN node n ON n.k = p.k AND n.name = p.name AND n.mother = p.mother LEFT JOIN comp ON comp.nid = n.nid)
    {CLUSTER_COLUMNS_SQL}
    """,
)
def fuzzy(spark, sf):
    people = registrations(spark, sf)
    return fuzzy_dedup(people, "id", "name", "mother").select("id", "cluster_id", "cluster_size", "is_duplicate")


@query(
    "fuzzy_dedup_one_hop",
    f"""
    WITH {REGISTRATIONS_SQL},
    hop AS (SELECT x AS nid, min(y) AS c FROM link GROUP BY 1),
    labelled AS (SELECT p.id, coalesce(c, p.id) AS cluster_id FROM keyed p LEFT JOIN node n ON n.k = p.k AND n.name = p.name AND n.mother = p.mother LEFT JOIN hop ON hop.nid = n.nid)
    {CLUSTER_COLUMNS_SQL}
    """,
)
def fuzzy_one_hop(spark, sf):
    people = registrations(spark, sf)
    return fuzzy_dedup(people, "id", "name", "mother", mode="one_hop").select("id", "cluster_id", "cluster_size", "is_duplicate")


@query(
    "blocked_pairs",
    f"""
    WITH {REGISTRATIONS_SQL},
    n AS (SELECT mother AS block, name, count(*) AS n FROM person WHERE name <> '' GROUP BY 1, 2)
    SELECT a.block, a.name AS value_a, b.name AS value_b, levenshtein(a.name, b.name) AS distance,
           round(len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) / least(len(string_split(a.name, ' ')), len(string_split(b.name, ' '))), 4) AS containment,
           a.n AS n_a, b.n AS n_b
    FROM n a JOIN n b ON a.block = b.block AND a.name < b.name
    WHERE levenshtein(a.name, b.name) <= 2
       OR len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) / least(len(string_split(a.name, ' ')), len(string_split(b.name, ' '))) >= 0.8
    """,
)
def blocked_pairs(spark, sf):
    people = registrations(spark, sf).filter("name <> ''").select(F.col("mother").alias("block"), "name")
    pairs = similar_name_counts(people, "block", "name")
    return pairs.withColumn("distance", F.col("distance").cast("long"))


@query(
    "token_containment",
    f"""
    WITH {REGISTRATIONS_SQL}
    SELECT a.id, len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) AS shared,
           round(len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) / least(len(string_split(a.name, ' ')), len(string_split(b.name, ' '))), 4) AS containment,
           levenshtein(a.name, b.name) AS distance
    FROM person a JOIN person b ON b.id = a.id + 1
    """,
)
def token_containment(spark, sf):
    a = registrations(spark, sf).select("id", F.col("name").alias("a"))
    b = registrations(spark, sf).select((F.col("id") - 1).alias("id"), F.col("name").alias("b"))
    pairs = a.join(b, "id")
    return pairs.select(
        "id",
        F.size(F.array_intersect(F.split("a", " "), F.split("b", " "))).cast("long").alias("shared"),
        F.round(containment(F.col("a"), F.col("b")), 4).alias("containment"),
        F.levenshtein("a", "b").cast("long").alias("distance"),
    )


def contacts(spark, sf):
    """Contact records made of orders, with the keys the exact rules look at."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    money = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("long")
    text = lambda c: c.cast("string")
    doc = F.when(customer % 10 == 0, "99999999999").when(customer % 10 == 1, text(customer)).otherwise(F.lpad(text(customer), 11, "0"))
    return table(spark, sf, "orders").select(
        key.alias("id"),
        F.year("o_orderdate").alias("yr"),
        doc.alias("doc"),
        F.when(key % 9 == 0, "").otherwise(F.concat(F.lit("N"), text(money % 400))).alias("name"),
        F.when(key % 8 == 0, "").otherwise(F.concat(F.lit("M"), text(key % 97))).alias("mother"),
        F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("P"), text(customer % 50))).alias("father"),
        F.when(key % 6 != 0, F.to_date("o_orderdate")).alias("birth"),
    )


@query(
    "exact_rule_dedup",
    """
    WITH RECURSIVE p AS (
      SELECT o_orderkey AS id, year(o_orderdate) AS yr,
             CASE o_custkey % 10 WHEN 0 THEN '99999999999' WHEN 1 THEN CAST(o_custkey AS VARCHAR) ELSE lpad(CAST(o_custkey AS VARCHAR), 11, '0') END AS doc,
             CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'N' || (CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) % 400) END AS nm,
             CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE 'M' || (o_orderkey % 97) END AS mo,
             CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'P' || (o_custkey % 50) END AS fa,
             CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS birth FROM orders),
    k AS (SELECT id, yr, 'doc' AS rule, doc AS key FROM p WHERE length(doc) = 11 AND doc NOT IN ('99999999999', '00000000000', '11111111111')
          UNION ALL SELECT id, yr, 'nm', nm || '/' || mo FROM p WHERE nm <> '' AND mo <> ''
          UNION ALL SELECT id, yr, 'nd', nm || '/' || doc || '/' || birth FROM p WHERE nm <> '' AND length(doc) = 11 AND birth IS NOT NULL
          UNION ALL SELECT id, yr, 'md', mo || '/' || doc || '/' || birth FROM p WHERE mo <> '' AND length(doc) = 11 AND birth IS NOT NULL
          UNION ALL SELECT id, yr, 'mf', mo || '/' || fa || '/' || birth FROM p WHERE mo <> '' AND fa <> '' AND birth IS NOT NULL
          UNION ALL SELECT id, yr, 'mfd', mo || '/' || fa || '/' || doc FROM p WHERE mo <> '' AND fa <> '' AND length(doc) = 11),
    s AS (SELECT id, min(id) OVER (PARTITION BY yr, rule, key) AS m FROM k),
    e AS (SELECT DISTINCT id AS a, m AS b FROM s WHERE id <> m),
    g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    reach(a, b) AS (SELECT a, b FROM g UNION SELECT r.a, g.b FROM reach r JOIN g ON r.b = g.a),
    c AS (SELECT a AS id, least(a, min(b)) AS c FROM reach GROUP BY a),
    labelled AS (SELECT p.id, coalesce(c.c, p.id) AS cluster_id FROM p LEFT JOIN c ON p.id = c.id)
    SELECT id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size, cluster_id <> id AS is_duplicate FROM labelled
    """,
)
def exact_rules(spark, sf):
    people = contacts(spark, sf)
    rules = person_rules("doc", "name", "mother", "father", "birth")
    return exact_rule_dedup(people, "id", rules, within=["yr"]).select("id", "cluster_id", "cluster_size", "is_duplicate")


@query("exact_rule_dedup_loads", ORACLES["exact_rule_dedup"])
def exact_rules_in_loads(spark, sf):
    """The same clusters from three loads into a store, the last of which brings rows again."""
    people, path = contacts(spark, sf), run_path(spark, "matches")
    rules = person_rules("doc", "name", "mother", "father", "birth")
    for load in ("id % 5 < 3", "id % 5 = 3", "id % 5 > 2"):
        add_rows(people.filter(load), "id", rules, path, within=["yr"])
    return stored_clusters(people, "id", path).select("id", "cluster_id", "cluster_size", "is_duplicate")
