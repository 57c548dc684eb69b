"""Casework source tables derived from the supplied tables, and the star schema on them.

The derivations are plain SQL expressions that read the same in Spark and in the
reference SQL, so one text defines the inputs of both sides; everything after
them is stated twice.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.codes import Domain
from caseloom.models import core
from caseloom.session import cut_lineage
from caseloom.sources.tables import table

STAYS_AS_OF = "2001-08-01"
AS_OF = "2024-01-30"

RIGHTS = Domain({"0": "neglect", "1": "violence", "2": "child labour", "5": "abandonment"})
BENEFITS = Domain({"1": "Bolsa Família", "2": "BPC - Idoso", "3": "Card"})
RACES = Domain({"01": "Branca", "02": "Preta", "03": "Parda", "04": "Amarelo", "05": "Indígena"})
LEVELS = Domain({0: "Master", 1: "Director", 2: "Reader"}, default="Other level")

_NOTE = """
    CASE WHEN event_id % 17 = 0 THEN '' ELSE concat(
      '<h3>Form ', CASE event_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END, '</h3><p>Local: <b>L', CAST(event_id % 8 AS STRING),
      '</b><br>Data: <b>', CASE WHEN event_id % 9 = 0 THEN 'sem data' ELSE CAST(CAST(ts AS DATE) AS STRING) END, '</b><br>Localizada: <b>',
      CASE WHEN event_id % 3 = 0 THEN 'Sim' ELSE 'Não' END, '</b><br>', CASE WHEN event_id % 5 = 0 THEN 'Interesse: <b>x</b>' ELSE '' END, '</p>',
      CASE WHEN event_id % 5 = 1 THEN concat('<p>Encaminhamentos - SMAS: <b>', CASE WHEN event_id % 2 = 0 THEN 'CRAS ' ELSE 'CAPS ' END, CAST(event_id % 6 AS STRING), '</b></p>') ELSE '' END,
      CASE WHEN event_id % 5 = 2 THEN concat('<p>Encaminhamentos - Benefícios: <b>', CASE event_id % 3 WHEN 0 THEN 'Cadastro/Atualização Cadúnico' WHEN 1 THEN 'BPC - Idoso' ELSE 'Cesta' END, '</b></p>') ELSE '' END,
      CASE WHEN event_id % 7 = 1 THEN '<p>Encaminhamentos Órgãos: <b>CREAS centro</b></p>' ELSE '' END, '<p>Outros: <b>nada</b></p>') END
"""
_NOTES = {
    "note_id": "event_id",
    "unit_id": "CAST(event_id % 25 AS INT)",
    "note_day": "CAST(ts AS DATE)",
    "scope_code": "CAST(CASE event_id % 4 WHEN 0 THEN 18 WHEN 1 THEN 20 WHEN 2 THEN 24 ELSE 7 END AS INT)",
    "note_type": "CASE WHEN event_id % 13 = 0 THEN 'D' ELSE 'N' END",
    "cancelled_on": "CASE WHEN event_id % 11 = 0 THEN CAST(ts AS DATE) END",
    "note": _NOTE,
}

# name: branches of (source, filter, columns)
RAW: dict[str, list[tuple[str, str, dict[str, str]]]] = {
    "persons": [("customer", "true", {
        "person_id": "c_custkey",
        "name": "CASE WHEN c_custkey % 50 = 0 THEN concat('Teste ', c_name) ELSE c_name END",
        "doc": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE lpad(CAST(c_custkey AS STRING), 11, '0') END",
        "birth": "DATE '1930-01-01' + CAST((c_custkey * 97) % 33000 AS INT)",
        "sex": "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
        "race_code": "lpad(CAST(c_custkey % 7 AS STRING), 2, '0')",
        "ref_unit_id": "CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END",
        "login_id": "c_custkey % 120",
        "rights_codes": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' n' ELSE concat(CAST(c_custkey % 4 AS STRING), ', ', CAST(c_custkey % 9 AS STRING), ',') END",
        "benefit_codes": "CASE c_custkey % 3 WHEN 0 THEN '' ELSE concat(CAST(c_custkey % 4 AS STRING), ',', CAST(c_custkey % 4 AS STRING)) END",
        "street": "c_custkey % 12 = 0",
        "schooling": "CASE c_custkey % 12 WHEN 0 THEN NULL WHEN 1 THEN 'Nunca estudou' WHEN 2 THEN 'Alfabetizado' WHEN 3 THEN 'Nível médio incompleto (cursando)' "
        "WHEN 4 THEN 'Superior completo' WHEN 5 THEN 'Superior incompleto (cursando)' WHEN 6 THEN 'Superior incompleto' ELSE 'outra' END",
        "gets_benefit": "CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN 'N' WHEN 2 THEN '' END",
        "attends_school": "CASE c_custkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END",
        "works": "CASE WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END",
        "district": "CASE WHEN c_custkey % 5 <> 0 THEN concat('B', CAST(c_custkey % 5 AS STRING)) END",
    })],
    "members": [
        ("customer", "true", {
            "person_id": "c_custkey", "family_id": "c_custkey % 500", "entered_on": "DATE '2015-01-01' + CAST(c_custkey % 900 AS INT)",
            "left_on": "CASE WHEN c_acctbal < 0 THEN DATE '2020-01-01' END",
        }),
        ("customer", "c_custkey % 4 = 0", {
            "person_id": "c_custkey", "family_id": "c_custkey % 77 + 1000", "entered_on": "DATE '2018-01-01' + CAST(c_custkey % 300 AS INT)",
            "left_on": "CASE WHEN c_custkey % 8 = 0 THEN DATE '2021-01-01' END",
        }),
    ],
    "projects": [("orders", "true", {
        "family_id": "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 500 ELSE o_custkey % 77 + 1000 END", "project_id": "o_orderkey % 20",
        "unit_id": "CAST(o_orderkey % 25 AS INT)", "is_active": "o_orderstatus <> 'F'",
        "registered": "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END",
    })],
    "services": [("orders", "true", {
        "family_id": "o_custkey % 500", "service_id": "o_orderkey % 10", "unit_id": "CAST(o_orderkey % 25 AS INT)",
        "registered": "CAST(o_orderdate AS DATE)", "cancelled_on": "CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) END",
    })],
    "vulnerabilities": [("orders", "o_orderpriority = '1-URGENT'", {
        "family_id": "o_custkey % 500", "vulnerability_id": "o_orderkey % 30", "registered": "CAST(o_orderdate AS DATE)",
    })],
    "units": [("nation", "true", {
        "unit_id": "n_nationkey", "unit_name": "CASE WHEN n_nationkey = 24 THEN 'Unidade Teste' ELSE n_name END", "unit_type_id": "n_regionkey",
        "unit_email": "CASE WHEN n_nationkey % 3 = 0 THEN concat('u', CAST(n_nationkey AS STRING), '@x') END",
        "region_email": "concat('r', CAST(n_regionkey AS STRING), '@x')", "is_active": "n_nationkey % 7 <> 0",
        "sphere": "CASE n_nationkey % 3 WHEN 0 THEN 'Municipal' WHEN 1 THEN 'Rede Conveniada' END",
        "region": "CASE WHEN n_nationkey % 6 <> 5 THEN lpad(CAST(n_nationkey % 13 AS STRING), 2, '0') END",
    })],
    "unit_types": [("region", "true", {"unit_type_id": "r_regionkey", "type_name": "r_name"})],
    "unit_emails": [
        ("nation", "true", {"unit_name": "concat(' ', lower(n_name))", "email": "concat('a', CAST(n_nationkey AS STRING), '@x')"}),
        ("nation", "n_nationkey % 4 = 0", {"unit_name": "upper(n_name)", "email": "concat('b', CAST(n_nationkey AS STRING), '@x')"}),
    ],
    "unit_config": [("nation", "true", {
        "unit_id": "n_nationkey", "beds": "CASE WHEN n_nationkey % 7 <> 0 THEN n_nationkey * 4 END",
        "blocked_repair": "CASE WHEN n_nationkey % 2 = 0 THEN 2 END", "blocked_court": "n_nationkey % 3",
        "manages": "CASE n_nationkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' END",
    })],
    "unit_capacity": [("nation", "true", {
        "unit_id": "n_nationkey",
        "audiences": "CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'A' WHEN 2 THEN 'A,F' WHEN 3 THEN 'I, F,A' ELSE 'I' END",
        "men": "n_nationkey + 5", "women": "n_nationkey % 6", "neutral": "CASE WHEN n_nationkey % 2 = 0 THEN 1 END",
    })],
    "providers": [("supplier", "true", {
        "provider_id": "s_suppkey", "provider_name": "CASE WHEN s_suppkey % 40 = 0 THEN concat('TESTE ', s_name) ELSE s_name END",
        "login_id": "CASE WHEN s_suppkey % 9 <> 0 THEN s_suppkey END",
    })],
    "operators": [("supplier", "true", {
        "login_id": "s_suppkey", "operator_name": "concat('Op ', s_name)", "level": "CAST(s_suppkey % 5 AS INT)",
    })],
    "occupations": [
        ("supplier", "true", {"provider_id": "s_suppkey", "occupation_code": "s_suppkey % 5", "occupation": "concat('occ ', CAST(s_suppkey % 5 AS STRING))"}),
        ("supplier", "s_suppkey % 3 = 0", {"provider_id": "s_suppkey", "occupation_code": "s_suppkey * 0 + 7", "occupation": "'occ 7'"}),
    ],
    "operator_units": [
        ("supplier", "true", {"login_id": "s_suppkey", "unit_id": "s_nationkey"}),
        ("supplier", "true", {"login_id": "s_suppkey", "unit_id": "(s_nationkey + 7) % 25"}),
    ],
    "visits": [("orders", "true", {
        "module": "CASE WHEN o_orderkey % 2 = 0 THEN 'family' ELSE 'person' END", "visit_id": "o_orderkey", "unit_id": "CAST(o_orderkey % 25 AS INT)",
        "person_id": "o_custkey", "provider_id": "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 90 END", "visit_day": "CAST(o_orderdate AS DATE)",
        "visit_hour": "concat('0', CAST(o_orderkey % 10 AS STRING), ':30')",
        "visit_name": "CASE o_orderkey % 4 WHEN 0 THEN 'Recepção inicial' WHEN 1 THEN 'Ação CadÚnico' WHEN 2 THEN 'Visita domiciliar' ELSE 'Escuta' END",
        "is_cancelled": "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'S' ELSE 'N' END",
        "shared_providers": "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('00', CAST(o_orderkey % 50 AS STRING), ',12,,x') ELSE '7, 007' END",
    })],
    "notes_admin": [("events", "event_type = 'click'", {**_NOTES, "person_id": "user_id", "login_id": "event_id % 90"})],
    "notes_family": [("events", "event_type = 'error'", {**_NOTES, "family_id": "user_id % 500", "member_id": "user_id", "provider_id": "event_id % 90"})],
    "notes_person": [("events", "event_type IN ('purchase', 'view')", {**_NOTES, "person_id": "user_id", "provider_id": "event_id % 90"})],
    "notes_group": [("events", "event_type = 'signup'", {
        **_NOTES, "activity_id": "event_id % 40", "provider_id": "event_id % 90",
        "person_list": "concat('(', CAST(user_id AS STRING), ',', CAST(user_id + 1 AS STRING), ', x,', CAST(user_id AS STRING), ')')",
    })],
    "stays": [("orders", "true", {
        "stay_id": "o_orderkey", "person_id": "o_custkey", "unit_id": "CAST(o_orderkey % 25 AS INT)", "entered_on": "CAST(o_orderdate AS DATE)",
        "left_on": "CASE WHEN o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' AND o_orderkey % 3 = 0 THEN NULL "
        "WHEN o_orderkey % 10 = 0 THEN CAST(o_orderdate AS DATE) - 3 ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) END",
        "exit_reason": "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'F' WHEN 3 THEN 'J' WHEN 4 THEN 'O' WHEN 5 THEN '?' ELSE 'C' END",
    })],
    "activities": [("part", "true", {
        "activity_id": "p_partkey", "activity_name": "p_name", "activity_type_id": "p_partkey % 7", "unit_id": "CAST(p_partkey % 27 AS INT)",
        "starts_on": "DATE '2020-01-01' + CAST(p_size AS INT)", "place_id": "CASE WHEN p_partkey % 4 <> 0 THEN p_size END",
    })],
    "activity_types": [("region", "true", {"activity_type_id": "r_regionkey", "type_name": "r_name"})],
    "provider_presences": [("lineitem", "true", {
        "activity_id": "l_partkey", "provider_id": "l_suppkey", "presence_day": "CAST(l_shipdate AS DATE)",
        "clock": "CASE WHEN l_orderkey % 11 = 0 THEN '08:15:00' WHEN l_orderkey % 13 <> 0 THEN CAST((l_orderkey % 24) * 100 + l_linenumber AS STRING) END",
    })],
    "presences": [("events", "event_type = 'view'", {
        "presence_id": "event_id", "person_id": "user_id", "activity_id": "event_id % 40", "presence_day": "CAST(ts AS DATE)",
        "clock": "CAST(hour(ts) * 100 + minute(ts) AS STRING)",
    })],
}


def raw_sql() -> str:
    """The derived tables as common table expressions."""
    parts = []
    for name, branches in RAW.items():
        selects = [
            "SELECT " + ", ".join(f"{expr} AS {col}" for col, expr in columns.items()) + f" FROM {source} WHERE {where}"
            for source, where, columns in branches
        ]
        parts.append(f"{name} AS ({' UNION ALL '.join(selects)})")
    return ",\n".join(parts)


class Casework:
    """The derived sources and the star schema of one folder, built when first asked for.

    Dimensions and facts that several steps read are written once as tables of the
    run, so a mart neither rebuilds them per use nor replays them after a loss.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        branches = [
            table(self.spark, self.folder, source).filter(where).selectExpr(*[f"{expr} AS {col}" for col, expr in columns.items()])
            for source, where, columns in RAW[name]
        ]
        return reduce(DataFrame.unionByName, branches)

    @cached_property
    def units(self) -> DataFrame:
        places = core.unit_places(self.raw("unit_config"), self.raw("unit_capacity"))
        return core.dim_units(self.raw("units"), self.raw("unit_types"), places, self.raw("unit_emails"))

    @cached_property
    def providers(self) -> DataFrame:
        providers = core.dim_providers(
            self.raw("providers"), self.raw("operators"), self.raw("occupations"), self.raw("operator_units"), self.units, LEVELS
        )
        return cut_lineage(providers, "providers")

    @cached_property
    def family_projects(self) -> DataFrame:
        return core.family_items(self.raw("projects"), ["project_id", "is_active"], ["registered", "unit_id"], "projects")

    @cached_property
    def persons(self) -> DataFrame:
        people = self.raw("persons")
        rights = core.coded_items(people, "person_id", "rights_codes", RIGHTS, "rights")
        benefits = core.coded_items(people, "person_id", "benefit_codes", BENEFITS, "benefits")
        projects = core.person_projects(self.raw("members"), self.family_projects)
        return cut_lineage(core.dim_persons(people, rights, benefits, projects, RACES), "persons")

    @cached_property
    def families(self) -> DataFrame:
        heads = self.raw("members").groupBy("family_id").agg(F.min("person_id").alias("head_id"))
        vulnerabilities = core.family_items(self.raw("vulnerabilities"), ["vulnerability_id"], ["registered"], "vulnerabilities")
        services = core.family_items(self.raw("services"), ["service_id"], ["registered", "unit_id"], "services")
        families = core.dim_families(heads, self.person_base, vulnerabilities, services, self.family_projects)
        return cut_lineage(families, "families")

    @property
    def heartbeat(self) -> DataFrame:
        """Day of the newest record of the sources."""
        return table(self.spark, self.folder, "events").agg(F.max("ts").cast("date"))

    @cached_property
    def person_base(self) -> DataFrame:
        return core.person_base(self.raw("persons"), RACES)

    @cached_property
    def provider_base(self) -> DataFrame:
        return core.provider_base(self.raw("providers"))

    @cached_property
    def unit_base(self) -> DataFrame:
        return core.unit_base(self.raw("units"), self.raw("unit_types"))

    @cached_property
    def visits(self) -> DataFrame:
        visits = core.fct_visits(self.raw("visits"), self.person_base, self.provider_base, self.unit_base)
        return cut_lineage(visits, "visits")

    @cached_property
    def notes(self) -> DataFrame:
        notes = core.fct_notes(
            self.raw("notes_admin"), self.raw("notes_family"), self.raw("notes_person"), self.raw("notes_group"),
            self.person_base, self.provider_base, self.unit_base,
        )
        return cut_lineage(notes, "notes")

    @cached_property
    def stays(self) -> DataFrame:
        return core.fct_stays(self.raw("stays"), self.person_base, self.units, STAYS_AS_OF)

    @cached_property
    def attendance(self) -> DataFrame:
        return core.fct_attendance(self.raw("presences"), self.person_base)

    @cached_property
    def activities(self) -> DataFrame:
        return core.dim_activities(self.raw("activities"), self.raw("activity_types"), self.unit_base)

    @cached_property
    def provider_attendance(self) -> DataFrame:
        return cut_lineage(core.fct_provider_attendance(self.raw("provider_presences"), self.provider_base), "provider-attendance")


def with_heartbeat(sql: str) -> str:
    """Rows of a query stamped with the day of the newest record of the sources."""
    return f"SELECT *, (SELECT CAST(max(ts) AS DATE) FROM events) AS updated_at FROM ({sql})"


# The same star schema for the reference SQL.
STAR_SQL = f"""
{raw_sql()},
d_units AS (
  SELECT u.*, t.type_name, c.audiences, CASE WHEN manages = 'S' THEN coalesce(men, 0) + coalesce(women, 0) + coalesce(neutral, 0) ELSE coalesce(beds, 0) END AS total_places,
         CASE WHEN manages = 'S' THEN coalesce(men, 0) + coalesce(women, 0) + coalesce(neutral, 0) ELSE coalesce(beds, 0) END - coalesce(blocked_repair, 0) - coalesce(blocked_court, 0) AS available_places,
         CASE WHEN coalesce(audiences, '') LIKE '%A%' THEN 'Sim' ELSE 'Não' END AS adult, CASE WHEN coalesce(audiences, '') LIKE '%F%' THEN 'Sim' ELSE 'Não' END AS family,
         CASE WHEN coalesce(audiences, '') LIKE '%I%' THEN 'Sim' ELSE 'Não' END AS elderly,
         coalesce(region_email, '') || ',' || coalesce((SELECT string_agg(DISTINCT e.email, ', ' ORDER BY e.email) FROM unit_emails e WHERE lower(trim(e.unit_name)) = lower(trim(u.unit_name))), '')
           || ', ' || coalesce(unit_email, '') AS contact
  FROM units u LEFT JOIN unit_types t USING (unit_type_id) LEFT JOIN unit_config g USING (unit_id) LEFT JOIN unit_capacity c USING (unit_id)
  WHERE lower(u.unit_name) NOT LIKE '%teste%'),
d_providers AS (SELECT p.*, o.level, md5(CAST(provider_id AS VARCHAR)) AS provider_sk FROM providers p LEFT JOIN operators o ON p.login_id = o.login_id WHERE lower(provider_name) NOT LIKE '%teste%'),
provider_unit AS (SELECT DISTINCT p.provider_id, o.unit_id, u.unit_name FROM d_providers p JOIN operator_units o ON p.login_id = o.login_id JOIN d_units u ON o.unit_id = u.unit_id),
d_persons AS (SELECT *, md5(CAST(person_id AS VARCHAR)) AS person_sk FROM persons WHERE lower(name) NOT LIKE '%teste%'),
person_right AS (
  SELECT DISTINCT person_id, trim(x.c) AS code, CASE trim(x.c) WHEN '0' THEN 'neglect' WHEN '1' THEN 'violence' WHEN '2' THEN 'child labour' WHEN '5' THEN 'abandonment' END AS label
  FROM d_persons, unnest(string_split(rights_codes, ',')) AS x(c) WHERE rights_codes IS NOT NULL AND upper(trim(rights_codes)) <> 'N' AND trim(x.c) <> ''),
person_project AS (
  SELECT m.person_id, project_id, is_active, p.unit_id FROM members m JOIN projects p ON m.family_id = p.family_id WHERE m.left_on IS NULL
  QUALIFY row_number() OVER (PARTITION BY m.person_id, project_id ORDER BY registered DESC NULLS LAST, p.unit_id DESC, is_active DESC) = 1),
d_families AS (
  SELECT f.family_id, f.head_id, p.name AS head_name FROM (SELECT family_id, min(person_id) AS head_id FROM members GROUP BY 1) f JOIN d_persons p ON f.head_id = p.person_id),
visit_provider AS (
  SELECT * EXCLUDE (shared_providers) FROM visits
  UNION ALL SELECT * FROM (SELECT DISTINCT v.* EXCLUDE (shared_providers) REPLACE (TRY_CAST(trim(s.p) AS BIGINT) AS provider_id)
    FROM visits v, unnest(string_split(shared_providers, ',')) AS s(p)
    WHERE TRY_CAST(trim(s.p) AS BIGINT) IS NOT NULL AND TRY_CAST(trim(s.p) AS BIGINT) IS DISTINCT FROM v.provider_id)),
f_visits AS (
  SELECT v.*, md5(module || '-' || visit_id || '-' || coalesce(CAST(v.provider_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS visit_sk, p.person_sk, r.provider_sk, u.unit_id IS NOT NULL AS has_unit
  FROM visit_provider v LEFT JOIN d_persons p ON v.person_id = p.person_id LEFT JOIN d_providers r ON v.provider_id = r.provider_id LEFT JOIN d_units u ON v.unit_id = u.unit_id),
n_all AS (
  SELECT note_id, unit_id, note_day, scope_code, note_type, cancelled_on, note, person_id, p.provider_id, NULL AS family_id, NULL AS member_id, NULL AS activity_id, 'admin' AS module
    FROM notes_admin LEFT JOIN d_providers p USING (login_id)
  UNION ALL SELECT note_id, unit_id, note_day, scope_code, note_type, cancelled_on, note, NULL, provider_id, family_id, member_id, NULL, 'family' FROM notes_family
  UNION ALL SELECT note_id, unit_id, note_day, scope_code, note_type, cancelled_on, note, person_id, provider_id, NULL, NULL, NULL, 'person' FROM notes_person
  UNION ALL SELECT DISTINCT note_id, unit_id, note_day, scope_code, note_type, cancelled_on, note, TRY_CAST(trim(x.p) AS BIGINT), provider_id, NULL, NULL, activity_id, 'group'
    FROM notes_group, unnest(string_split(replace(replace(person_list, '(', ''), ')', ''), ',')) AS x(p) WHERE TRY_CAST(trim(x.p) AS BIGINT) IS NOT NULL AND cancelled_on IS NULL),
f_notes AS (
  SELECT n.*, md5(module || '-' || note_id || '-' || coalesce(CAST(n.person_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS note_sk, p.person_sk, r.provider_sk, u.unit_id IS NOT NULL AS has_unit
  FROM n_all n LEFT JOIN d_persons p ON n.person_id = p.person_id LEFT JOIN d_providers r ON n.provider_id = r.provider_id LEFT JOIN d_units u ON n.unit_id = u.unit_id),
d_activities AS (
  SELECT a.*, t.type_name, u.unit_name FROM activities a LEFT JOIN activity_types t USING (activity_type_id) LEFT JOIN d_units u ON u.unit_id = a.unit_id),
f_provider_presences AS (
  SELECT a.*, p.provider_sk, md5(activity_id || '-' || a.provider_id || '-' || presence_day || '-' || coalesce(clock, '_dbt_utils_surrogate_key_null_')) AS presence_sk
  FROM provider_presences a JOIN d_providers p ON a.provider_id = p.provider_id),
f_stay_days AS (
  SELECT s.*, p.person_sk, p.doc, u.audiences, CAST(x.d AS DATE) AS ref_date
  FROM stays s LEFT JOIN d_persons p ON s.person_id = p.person_id LEFT JOIN d_units u ON s.unit_id = u.unit_id,
       unnest(generate_series(entered_on, least(coalesce(left_on, DATE '{STAYS_AS_OF}'), DATE '{STAYS_AS_OF}'), INTERVAL 1 DAY)) AS x(d)
  WHERE entered_on <= DATE '{STAYS_AS_OF}')
"""
