"""Dimensions, facts and marts of the casework schema as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.models import core, marts
from caseloom.operators.forms import Field
from caseloom.operators.layout import family_bands, parse_layout
from caseloom.operators.matching import exact_rule_dedup, person_rules
from caseloom.operators.stored import read_store
from caseloom.operators.timeline import days_by_year
from caseloom.plans.casework import AS_OF, STAR_SQL, STAYS_AS_OF, Casework, with_heartbeat
from caseloom.plans.identity import contacts
from caseloom.plans.registry import ORACLES, query
from caseloom.plans.text_forms import POSITIONS, payroll_lines
from caseloom.session import run_path
from caseloom.sources.tables import table


def age_sql(birth: str, as_of: str) -> str:
    y, m, d = as_of.split("-")
    return f"({int(y)} - year({birth}) - CASE WHEN {int(m) * 100 + int(d)} < month({birth}) * 100 + day({birth}) THEN 1 ELSE 0 END)"


@query(
    "dim_units",
    f"""
    WITH {STAR_SQL} SELECT md5(CAST(unit_id AS VARCHAR)) AS unit_sk, unit_id, unit_name, type_name, contact, adult, family, elderly, total_places, available_places FROM d_units
    """,
)
def dim_units(spark, sf):
    return Casework(spark, sf).units.select(
        "unit_sk", "unit_id", "unit_name", "type_name", "contact", "adult", "family", "elderly", "total_places", "available_places"
    )


@query(
    "dim_providers",
    f"""
    WITH {STAR_SQL}, oc AS (SELECT provider_id, count(*) AS n, string_agg(occupation, ' | ' ORDER BY occupation_code) AS t FROM occupations GROUP BY 1),
    un AS (SELECT provider_id, count(*) AS n, string_agg(unit_name, ', ' ORDER BY unit_name) AS t FROM provider_unit GROUP BY 1)
    SELECT provider_sk, p.provider_id, provider_name, CASE level WHEN 0 THEN 'Master' WHEN 1 THEN 'Director' WHEN 2 THEN 'Reader' ELSE CASE WHEN level IS NOT NULL THEN 'Other level' END END AS access_profile,
           coalesce(oc.n, 0) AS n_occupations, oc.t AS occupations, CASE WHEN coalesce(oc.n, 0) > 1 THEN 'Sim' ELSE 'Não' END AS many_occupations,
           CAST(coalesce(un.n, 0) AS INTEGER) AS n_units, un.t AS unit_names, login_id IS NULL AS without_account
    FROM d_providers p LEFT JOIN oc USING (provider_id) LEFT JOIN un USING (provider_id)
    """,
)
def dim_providers(spark, sf):
    return Casework(spark, sf).providers.select(
        "provider_sk", "provider_id", "provider_name", "access_profile", "n_occupations", "occupations", "many_occupations", "n_units",
        "unit_names", "without_account",
    )


@query(
    "dim_persons",
    f"""
    WITH {STAR_SQL}, ri AS (SELECT person_id, string_agg(code || '=' || coalesce(label, '?'), ',' ORDER BY code) AS t FROM person_right GROUP BY 1),
    pr AS (SELECT person_id, count(*) AS n, count(*) FILTER (WHERE is_active) AS a FROM person_project GROUP BY 1)
    SELECT person_sk, p.person_id, name, CASE race_code WHEN '01' THEN 'Branca' WHEN '02' THEN 'Preta' WHEN '03' THEN 'Parda' WHEN '04' THEN 'Amarelo' WHEN '05' THEN 'Indígena' END AS race,
           CASE WHEN ri.t IS NOT NULL THEN 'Sim' ELSE 'Não' END AS has_violation, ri.t AS rights, CAST(coalesce(pr.n, 0) AS INTEGER) AS n_projects, CAST(coalesce(pr.a, 0) AS INTEGER) AS n_active
    FROM d_persons p LEFT JOIN ri USING (person_id) LEFT JOIN pr USING (person_id)
    """,
)
def dim_persons(spark, sf):
    shown = F.transform("rights", lambda r: F.concat_ws("=", r["code"], F.coalesce(r["label"], F.lit("?"))))
    size = lambda items: F.coalesce(F.array_size(items), F.lit(0))
    return Casework(spark, sf).persons.select(
        "person_sk", "person_id", "name", "race", "has_violation", F.array_join(shown, ",").alias("rights"),
        size("projects").alias("n_projects"), size(F.filter("projects", lambda p: p["is_active"])).alias("n_active"),
    )


@query(
    "fct_visits",
    f"""
    WITH {STAR_SQL} SELECT module, unit_id, count(*) AS n_rows, count(DISTINCT visit_sk) AS n_keys, count(person_sk) AS n_persons, count(provider_sk) AS n_providers,
           count(*) FILTER (WHERE has_unit) AS n_units, count(DISTINCT provider_id) AS n_provider_ids, min(visit_sk) AS first_key, max(visit_sk) AS last_key,
           max(person_sk) AS last_person, max(provider_sk) AS last_provider, max(CASE WHEN has_unit THEN md5(CAST(unit_id AS VARCHAR)) END) AS last_unit FROM f_visits GROUP BY 1, 2
    """,
)
def fct_visits(spark, sf):
    return Casework(spark, sf).visits.groupBy("module", "unit_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("visit_sk").alias("n_keys"), F.count("person_sk").alias("n_persons"),
        F.count("provider_sk").alias("n_providers"), F.count("unit_sk").alias("n_units"), F.count_distinct("provider_id").alias("n_provider_ids"),
        F.min("visit_sk").alias("first_key"), F.max("visit_sk").alias("last_key"), F.max("person_sk").alias("last_person"),
        F.max("provider_sk").alias("last_provider"), F.max("unit_sk").alias("last_unit"),
    )


@query(
    "fct_notes",
    f"""
    WITH {STAR_SQL} SELECT module, scope_code, count(*) AS n_rows, count(DISTINCT note_sk) AS n_keys, count(person_sk) AS n_persons, count(provider_sk) AS n_providers,
           count(*) FILTER (WHERE has_unit) AS n_units, count(family_id) AS n_families, count(activity_id) AS n_activities, min(note_sk) AS first_key, max(note_sk) AS last_key,
           max(person_sk) AS last_person, max(provider_sk) AS last_provider, max(CASE WHEN has_unit THEN md5(CAST(unit_id AS VARCHAR)) END) AS last_unit FROM f_notes GROUP BY 1, 2
    """,
)
def fct_notes(spark, sf):
    return Casework(spark, sf).notes.groupBy("module", "scope_code").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("note_sk").alias("n_keys"), F.count("person_sk").alias("n_persons"),
        F.count("provider_sk").alias("n_providers"), F.count("unit_sk").alias("n_units"), F.count("family_id").alias("n_families"),
        F.count("activity_id").alias("n_activities"), F.min("note_sk").alias("first_key"), F.max("note_sk").alias("last_key"),
        F.max("person_sk").alias("last_person"), F.max("provider_sk").alias("last_provider"), F.max("unit_sk").alias("last_unit"),
    )


AGE_BAND_SQL = """CASE WHEN age BETWEEN 0 AND 3 THEN 'De 0 a 3 anos - Bebê' WHEN age BETWEEN 4 AND 11 THEN 'De 04 a 11 anos - Criança'
    WHEN age BETWEEN 12 AND 17 THEN 'De 12 a 17 anos - Adolescente' WHEN age BETWEEN 18 AND 59 THEN 'De 18 a 59 anos - Adulto'
    WHEN age >= 60 THEN 'Mais de 60 anos - Idoso' ELSE 'Não informada' END"""


@query(
    "mart_daily_stays",
    with_heartbeat(f"""
    WITH {STAR_SQL}, x AS (SELECT s.*, p.birth, {age_sql('p.birth', STAYS_AS_OF)} AS age, u.unit_name, u.adult, u.family, u.elderly FROM f_stay_days s JOIN d_persons p ON s.person_id = p.person_id
      LEFT JOIN d_units u ON s.unit_id = u.unit_id)
    SELECT unit_name, year(ref_date) AS yr, {AGE_BAND_SQL} AS age_band,
           CASE WHEN adult = 'Não' AND elderly = 'Não' AND family = 'Não' THEN 'Outra unidade SMAS' WHEN adult = 'Não' AND elderly = 'Sim' AND family = 'Não' THEN 'Eixo idoso'
                WHEN adult = 'Sim' AND elderly = 'Não' AND family = 'Não' THEN 'Eixo adulto' WHEN adult = 'Sim' AND elderly = 'Sim' AND family = 'Sim' THEN 'Eixo adulto, idoso e família'
                WHEN adult = 'Sim' AND elderly = 'Sim' AND family = 'Não' THEN 'Eixo adulto e idoso' WHEN adult = 'Sim' AND elderly = 'Não' AND family = 'Sim' THEN 'Eixo adulto e família' ELSE 'Outros' END AS axis,
           CASE WHEN coalesce(doc, '') = '' THEN 'CPF não informado' ELSE 'CPF informado' END AS doc_status,
           count(*) AS n_days, count(DISTINCT stay_id) AS n_stays, CAST(sum(CASE WHEN left_on IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_open_days, max(ref_date) AS last_day
    FROM x GROUP BY ALL
    """),
)
def mart_daily_stays(spark, sf):
    case = Casework(spark, sf)
    # labels per stay; its days are counted by year, none is listed
    labelled = marts.daily_stays(case.stays, case.person_base, case.units.drop("audiences"), STAYS_AS_OF, updated=case.heartbeat)
    years = days_by_year(labelled, "entered_on", "left_on", STAYS_AS_OF)
    return years.groupBy("unit_name", "yr", "age_band", "axis", "doc_status").agg(
        F.sum("n_days").alias("n_days"), F.count("stay_id").alias("n_stays"), F.sum(F.col("is_open") * F.col("n_days")).alias("n_open_days"),
        F.max("last_day").alias("last_day"), F.max("updated_at").alias("updated_at"),
    )


@query(
    "mart_stay_labels",
    f"""
    WITH {STAR_SQL}, x AS (SELECT s.*, p.schooling, p.gets_benefit, p.district, u.sphere, u.region FROM stays s JOIN d_persons p ON s.person_id = p.person_id LEFT JOIN d_units u ON s.unit_id = u.unit_id
      WHERE entered_on <= DATE '{STAYS_AS_OF}')
    SELECT CASE WHEN left_on IS NULL THEN 'Acolhido' ELSE 'Desligado' END AS status,
           CASE exit_reason WHEN 'F' THEN 'Reinserção comunitária' WHEN 'J' THEN 'Reinserção PVTN' WHEN 'O' THEN 'Óbito' WHEN 'C' THEN 'Decisão da direção/equipe - Conflito com outro acolhido'
             ELSE CASE WHEN coalesce(exit_reason, '') = '' AND left_on IS NULL THEN 'Não desligado' ELSE 'Acolhido' END END AS exit_label,
           CASE WHEN exit_reason = 'F' THEN 'Deslig. por reinserção comunitária' WHEN exit_reason = 'J' THEN 'Reinserção através do projeto de volta a terra natal'
             WHEN left_on IS NOT NULL AND exit_reason IS NOT NULL THEN 'Outros motivos' ELSE 'Null' END AS return_label,
           CAST(year(left_on) AS INTEGER) AS exit_year,
           CASE schooling WHEN 'Nunca estudou' THEN '01. Nunca estudou' WHEN 'Alfabetizado' THEN '03. Alfabetizado' WHEN 'Nível médio incompleto (cursando)' THEN '06. Nível médio incompleto'
             WHEN 'Superior completo' THEN '09. Superior completo' WHEN 'Superior incompleto (cursando)' THEN '08. Superior incompleto' WHEN 'Superior incompleto' THEN '08. Superior incompleto'
             ELSE '10. Não sabe/Não informou' END AS schooling_label,
           CASE gets_benefit WHEN 'S' THEN 'Sim' WHEN 'N' THEN 'Não' ELSE 'Não Informado' END AS gets_benefit, coalesce(district, 'Não Informado') AS district,
           CASE sphere WHEN 'Municipal' THEN 'Rede Pública' ELSE sphere END AS sphere, CASE WHEN region BETWEEN '01' AND '10' THEN region || 'ª CAS' END AS region_name,
           CASE WHEN region BETWEEN '01' AND '10' THEN 'cas' || CAST(region AS INTEGER) || '@prefeitura.rio' END AS region_email,
           count(*) AS n_stays, CAST(sum(date_diff('day', entered_on, left_on) + 1) AS BIGINT) AS days_stayed,
           min(CASE WHEN left_on IS NULL AND entered_on < DATE '2001-01-01' THEN DATE '2001-01-01' ELSE entered_on END) AS first_start, max(coalesce(left_on, DATE '{STAYS_AS_OF}')) AS last_end
    FROM x GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10
    """,
)
def mart_stay_labels(spark, sf):
    case = Casework(spark, sf)
    labelled = marts.stay_labels(case.stays, case.person_base, case.unit_base, STAYS_AS_OF)
    labels = ["status", "exit_label", "return_label", "exit_year", "schooling_label", "gets_benefit", "district", "sphere", "region_name", "region_email"]
    return labelled.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("n_stays"), F.sum("stay_days").cast("long").alias("days_stayed"),
        F.min("clipped_start").alias("first_start"), F.max("clipped_end").alias("last_end"),
    )


@query(
    "mart_stay_goal_snapshot",
    f"""
    WITH {STAR_SQL}, a AS (SELECT DISTINCT CAST(year(ref_date) AS VARCHAR) AS yr, CAST(month(ref_date) AS VARCHAR) AS mon, coalesce(doc, '') AS doc,
      CASE WHEN coalesce(doc, '') = '' THEN 'empty' ELSE 'ok' END AS doc_status, CASE WHEN audiences LIKE '%A%' OR audiences LIKE '%F%' THEN 'ADULTO/FAMÍLIA' WHEN audiences LIKE '%I%' THEN 'IDOSO' END AS axis, 'SMAS' AS source
      FROM f_stay_days WHERE year(ref_date) >= 2000),
    b AS (SELECT DISTINCT CAST(year(ts) AS VARCHAR), CAST(month(ts) AS VARCHAR), lpad(CAST(user_id AS VARCHAR), 11, '0'), 'ok', CAST(NULL AS VARCHAR), 'SMS' FROM events)
    SELECT yr, mon, doc_status, axis, source, count(*) AS n_people, DATE '{STAYS_AS_OF}' AS snapshot_on FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL
    """,
)
def mart_stay_goal_snapshot(spark, sf):
    case = Casework(spark, sf)
    days = core.fct_stay_days(case.stays, STAYS_AS_OF)
    sheet = table(spark, sf, "events").select(F.to_date("ts").alias("ref_date"), F.col("user_id").cast("string").alias("doc"))
    path = run_path(spark, "stay-goals")
    for _ in range(2):  # the second run of a day finds its stamp
        marts.store_stay_goals(marts.stay_goal_snapshot(days, sheet, STAYS_AS_OF, 2000), path)
    return read_store(spark, path).groupBy("yr", "mon", "doc_status", "axis", "source", "snapshot_on").agg(F.count(F.lit(1)).alias("n_people"))


@query(
    "mart_visits_report",
    with_heartbeat(f"""
    WITH {STAR_SQL}, s AS (SELECT * FROM f_visits UNION ALL SELECT * REPLACE (visit_id + 100000000 AS visit_id, md5(visit_sk || 'again') AS visit_sk,
                                 CASE WHEN visit_id % 3 = 0 THEN '23:00' ELSE visit_hour END AS visit_hour) FROM f_visits WHERE visit_id % 4 = 1),
    v AS (SELECT s.*, 'occ ' || (s.provider_id % 5) AS occupation, p.provider_name, u.type_name, s.visit_day AS registered
          FROM s LEFT JOIN d_providers p ON s.provider_id = p.provider_id LEFT JOIN d_units u ON s.unit_id = u.unit_id),
    k AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY registered, visit_sk) = 1
          AND row_number() OVER (PARTITION BY provider_id, visit_hour, visit_day, visit_name, person_id, unit_id ORDER BY registered, visit_sk) = 1),
    x AS (SELECT k.*, {age_sql('p.birth', STAYS_AS_OF)} AS age FROM k LEFT JOIN d_persons p ON k.person_id = p.person_id)
    SELECT CASE WHEN visit_name LIKE '%Recepção%' THEN 'Atendimento Recepção' WHEN provider_name = 'Supplier#000000007' THEN 'Atendimento Recepção'
                WHEN occupation IN ('occ 3', 'occ 4') AND visit_name LIKE '%CadÚnico%' THEN 'Atendimento Recepção'
                WHEN occupation IN ('occ 1', 'occ 2') THEN 'Atendimento Técnico' ELSE 'Outros Atendimentos' END AS visit_kind,
           CASE WHEN age <= 17 THEN 'Até 17 anos' WHEN age <= 29 THEN 'De 18 a 29 anos' WHEN age <= 44 THEN 'De 30 a 44 anos' WHEN age <= 59 THEN 'De 45 a 59 anos'
                WHEN age <= 74 THEN 'De 60 a 74 anos' WHEN age > 74 THEN 'Mais de 75 anos' ELSE 'Não Informado' END AS age_band,
           CASE WHEN occupation IN ('occ 3', 'occ 4') AND visit_name LIKE '%CadÚnico%' AND type_name = 'ASIA' THEN 'ASIA - Recepção - Ação CadÚnico'
                WHEN occupation IN ('occ 3', 'occ 4') AND visit_name LIKE '%CadÚnico%' AND type_name = 'EUROPE' THEN 'EUROPE - Recepção - Ação CadÚnico'
                ELSE visit_name END AS visit_label, count(*) AS n_visits, min(visit_sk) AS first_key
    FROM x GROUP BY 1, 2, 3
    """),
)
def mart_visits_report(spark, sf):
    case = Casework(spark, sf)
    occupation = F.concat(F.lit("occ "), (F.col("provider_id") % 5).cast("string"))
    # every fourth visit is reported again, some of them for another hour
    again = case.visits.filter("visit_id % 4 = 1").withColumns({
        "visit_id": F.col("visit_id") + 100000000,
        "visit_sk": F.md5(F.concat("visit_sk", F.lit("again"))),
        "visit_hour": F.when(F.col("visit_id") % 3 == 0, "23:00").otherwise(F.col("visit_hour")),
    })
    visits = (
        case.visits.unionByName(again)
        .join(case.provider_base.select("provider_id", "provider_name"), "provider_id", "left")
        .join(case.unit_base.select("unit_id", "type_name"), "unit_id", "left")
        .withColumns({"occupation": occupation, "registered": F.col("visit_day")})
    )
    renamed = {"ASIA": "ASIA - Recepção - Ação CadÚnico", "EUROPE": "EUROPE - Recepção - Ação CadÚnico"}
    report = marts.visits_report(
        visits, case.person_base, ["occ 3", "occ 4"], ["occ 1", "occ 2"], "Supplier#000000007", renamed, STAYS_AS_OF,
        updated=case.heartbeat,
    )
    return report.groupBy("visit_kind", "age_band", "visit_label").agg(
        F.count(F.lit(1)).alias("n_visits"), F.min("visit_sk").alias("first_key"), F.max("updated_at").alias("updated_at")
    )


@query(
    "mart_provider_units",
    with_heartbeat(f"""
    WITH {STAR_SQL}, b AS (SELECT p.provider_id, pu.unit_id FROM d_providers p LEFT JOIN provider_unit pu USING (provider_id) WHERE p.login_id IS NOT NULL),
    v AS (SELECT provider_id, unit_id, count(DISTINCT visit_sk) AS n FROM f_visits WHERE coalesce(is_cancelled, 'N') <> 'S' GROUP BY 1, 2),
    e AS (SELECT provider_id, unit_id, count(DISTINCT note_sk) AS n FROM f_notes WHERE cancelled_on IS NULL GROUP BY 1, 2),
    k AS (SELECT provider_id, count(*) AS n_units FROM provider_unit GROUP BY 1)
    SELECT md5(b.provider_id || '-' || coalesce(CAST(b.unit_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS provider_unit_sk, b.provider_id, upper(p.provider_name) AS provider_name,
           CASE level WHEN 0 THEN 'Master' WHEN 1 THEN 'Director' WHEN 2 THEN 'Reader' ELSE 'Other level' END AS access_profile, CAST(coalesce(n_units, 0) AS INTEGER) AS n_units,
           b.unit_id, u.unit_name, u.contact, coalesce(v.n, 0) AS n_visits, coalesce(e.n, 0) AS n_notes
    FROM b JOIN d_providers p ON b.provider_id = p.provider_id LEFT JOIN k ON k.provider_id = b.provider_id LEFT JOIN d_units u ON u.unit_id = b.unit_id
    LEFT JOIN v ON v.provider_id = b.provider_id AND v.unit_id = b.unit_id LEFT JOIN e ON e.provider_id = b.provider_id AND e.unit_id = b.unit_id
    """),
)
def mart_provider_units(spark, sf):
    case = Casework(spark, sf)
    return marts.provider_units(case.providers, case.units, case.visits, case.notes, updated=case.heartbeat)


@query(
    "mart_person_attendance",
    with_heartbeat(f"""
    WITH {STAR_SQL},
    fm AS (SELECT person_id, activity_id, max(CASE WHEN event_form = 'A' THEN place END) AS left_reason, max(CASE WHEN event_form = 'B' THEN place END) AS absence_reason
           FROM (SELECT n.person_id, n.activity_id, CASE note_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END AS event_form, 'L' || (note_id % 8) AS place
                 FROM f_notes n WHERE module = 'group' AND note <> '') GROUP BY 1, 2),
    cur AS (SELECT person_id, family_id FROM members WHERE left_on IS NULL QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY entered_on DESC, family_id DESC) = 1),
    ip AS (SELECT DISTINCT person_id FROM person_project WHERE project_id = 4 AND is_active)
    SELECT pr.presence_id, pr.person_id, upper(p.name) AS person_name, CAST(2024 - year(p.birth) AS INTEGER) AS age, CASE WHEN coalesce(p.doc, '') <> '' THEN 'Sim' ELSE 'Não' END AS has_doc,
           CASE WHEN ip.person_id IS NOT NULL THEN 'Sim' ELSE 'Não' END AS in_project, upper(fa.head_name) AS head_name, 'ACT ' || pr.activity_id AS activity_name,
           CASE WHEN length(clock) BETWEEN 1 AND 4 THEN substr(lpad(clock, 4, '0'), 1, 2) || ':' || substr(lpad(clock, 4, '0'), 3, 2) ELSE clock END AS clock,
           left_reason, absence_reason, CASE WHEN left_reason IS NOT NULL THEN 'Sim' ELSE 'Não' END AS has_left_reason, CASE WHEN absence_reason IS NOT NULL THEN 'Sim' ELSE 'Não' END AS has_absence_reason
    FROM presences pr JOIN d_persons p ON pr.person_id = p.person_id LEFT JOIN cur ON cur.person_id = pr.person_id LEFT JOIN d_families fa ON fa.family_id = cur.family_id
    LEFT JOIN ip ON ip.person_id = pr.person_id LEFT JOIN fm ON fm.person_id = pr.person_id AND fm.activity_id = pr.activity_id
    """),
)
def mart_person_attendance(spark, sf):
    case = Casework(spark, sf)
    activity = F.col("event_id") % 40
    activities = table(spark, sf, "events").select(activity.alias("activity_id"), F.concat(F.lit("ACT "), activity.cast("string")).alias("activity_name")).distinct()
    report = marts.person_attendance(
        case.attendance, case.persons, activities, case.raw("members"), case.families, case.notes.filter("module = 'group'"),
        {"left_reason": ("Form A", "Local"), "absence_reason": ("Form B", "Local")}, 4, AS_OF, updated=case.heartbeat,
    )
    return report.select(
        "presence_id", "person_id", "person_name", "age", "has_doc", "in_project", "head_name", "activity_name", "clock",
        "left_reason", "absence_reason", "has_left_reason", "has_absence_reason", "updated_at",
    )


@query(
    "dim_activities",
    f"WITH {STAR_SQL} SELECT activity_id, activity_name, activity_type_id, type_name, unit_id, unit_name, starts_on, place_id FROM d_activities",
)
def dim_activities(spark, sf):
    return Casework(spark, sf).activities.select(
        "activity_id", "activity_name", "activity_type_id", "type_name", "unit_id", "unit_name", "starts_on", "place_id"
    )


@query(
    "fct_provider_attendance",
    f"WITH {STAR_SQL} SELECT presence_sk, provider_sk, activity_id, provider_id, presence_day, clock FROM f_provider_presences",
)
def fct_provider_attendance(spark, sf):
    return Casework(spark, sf).provider_attendance.select("presence_sk", "provider_sk", "activity_id", "provider_id", "presence_day", "clock")


@query(
    "mart_provider_attendance",
    f"""
    WITH {STAR_SQL}, sheet AS (SELECT upper(trim(unit_name)) AS unit, string_agg(DISTINCT email, ', ' ORDER BY email) AS unit_email FROM unit_emails GROUP BY 1),
    oc AS (SELECT provider_id, string_agg(occupation, ' | ' ORDER BY occupation_code) AS occupations, string_agg(CAST(occupation_code AS VARCHAR), ' | ' ORDER BY occupation_code) AS occupation_codes
           FROM occupations GROUP BY 1)
    SELECT presence_sk, f.provider_id, upper(trim(provider_name)) AS provider_name, occupation_codes, occupations, f.activity_id, upper(activity_name) AS activity_name,
           upper(a.type_name) AS type_name, upper(a.unit_name) AS unit_name, presence_day, unit_email,
           CASE WHEN length(clock) BETWEEN 1 AND 4 THEN substr(lpad(clock, 4, '0'), 1, 2) || ':' || substr(lpad(clock, 4, '0'), 3, 2) ELSE clock END AS clock,
           (SELECT CAST(max(ts) AS DATE) FROM events) AS updated_at
    FROM f_provider_presences f JOIN d_activities a ON a.activity_id = f.activity_id JOIN d_providers p ON p.provider_id = f.provider_id
    LEFT JOIN oc ON oc.provider_id = f.provider_id LEFT JOIN sheet ON unit = upper(a.unit_name) WHERE a.unit_name IS NOT NULL
    """,
)
def mart_provider_attendance(spark, sf):
    case = Casework(spark, sf)
    report = marts.provider_attendance(case.provider_attendance, case.providers, case.activities, case.raw("unit_emails"), updated=case.heartbeat)
    return report.select(
        "presence_sk", "provider_id", "provider_name", "occupation_codes", "occupations", "activity_id", "activity_name", "type_name", "unit_name",
        "presence_day", "unit_email", "clock", "updated_at",
    )


@query(
    "dim_families",
    f"""
    WITH {STAR_SQL}, v AS (SELECT family_id, count(DISTINCT vulnerability_id) AS n FROM vulnerabilities GROUP BY 1),
    s AS (SELECT family_id, count(DISTINCT service_id) AS n, max(registered) AS d FROM services GROUP BY 1),
    p AS (SELECT family_id, count(*) AS n, string_agg(CAST(project_id AS VARCHAR), ',' ORDER BY project_id) AS t FROM (SELECT DISTINCT family_id, project_id, is_active FROM projects) GROUP BY 1)
    SELECT md5(CAST(f.family_id AS VARCHAR)) AS family_sk, f.family_id, head_id, head_name, CAST(coalesce(v.n, 0) AS INTEGER) AS n_vulnerabilities, CAST(coalesce(s.n, 0) AS INTEGER) AS n_services,
           s.d AS last_service, CAST(coalesce(p.n, 0) AS INTEGER) AS n_projects, p.t AS projects
    FROM d_families f LEFT JOIN v ON v.family_id = f.family_id LEFT JOIN s ON s.family_id = f.family_id LEFT JOIN p ON p.family_id = f.family_id
    """,
)
def dim_families(spark, sf):
    size = lambda items: F.coalesce(F.array_size(items), F.lit(0))
    return Casework(spark, sf).families.select(
        "family_sk", "family_id", "head_id", "head_name", size("vulnerabilities").alias("n_vulnerabilities"), size("services").alias("n_services"),
        F.array_max(F.transform("services", lambda s: s["registered"])).alias("last_service"), size("projects").alias("n_projects"),
        F.array_join(F.transform("projects", lambda p: p["project_id"].cast("string")), ",").alias("projects"),
    )


@query(
    "mart_family_indicators",
    with_heartbeat(f"""
    WITH {STAR_SQL}, v AS (SELECT family_id, count(*) AS n FROM vulnerabilities GROUP BY 1), s AS (SELECT family_id, count(*) AS n FROM services GROUP BY 1)
    SELECT md5(CAST(f.family_id AS VARCHAR)) AS family_sk, f.family_id, head_name, coalesce(v.n, 0) AS n_vulnerabilities, coalesce(s.n, 0) AS n_services,
           CASE WHEN v.n > 0 THEN 'Sim' ELSE 'Não' END AS has_vulnerability, CASE WHEN s.n > 0 THEN 'Sim' ELSE 'Não' END AS has_service
    FROM d_families f LEFT JOIN v ON v.family_id = f.family_id LEFT JOIN s ON s.family_id = f.family_id
    """),
)
def mart_family_indicators(spark, sf):
    case = Casework(spark, sf)
    return marts.family_indicators(case.families, updated=case.heartbeat)


@query(
    "mart_person_rights",
    with_heartbeat(f"WITH {STAR_SQL} SELECT person_sk, person_id, name, doc, birth, code, label FROM d_persons JOIN person_right USING (person_id)"),
)
def mart_person_rights(spark, sf):
    case = Casework(spark, sf)
    return marts.person_rights(case.persons, updated=case.heartbeat)


@query(
    "mart_person_tracking",
    with_heartbeat(f"""
    WITH {STAR_SQL}, i AS (SELECT person_id, unit_id, 'visit' AS kind, visit_day AS d FROM f_visits WHERE coalesce(is_cancelled, 'N') <> 'S' AND person_id IS NOT NULL
      UNION ALL SELECT CASE WHEN person_sk IS NOT NULL THEN person_id ELSE member_id END AS p, unit_id, 'note', note_day FROM f_notes WHERE has_unit AND coalesce(note, '') <> '' AND p IN (SELECT person_id FROM d_persons)),
    fam AS (SELECT person_id, family_id FROM members QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY CASE WHEN left_on IS NULL THEN 0 ELSE 1 END, entered_on DESC, family_id DESC) = 1),
    ri AS (SELECT person_id, string_agg(label, '; ' ORDER BY code) FILTER (WHERE label IS NOT NULL) AS t, count(*) AS n FROM person_right GROUP BY 1)
    SELECT i.person_id, i.unit_id, bool_or(kind = 'visit') AS has_visit, bool_or(kind = 'note') AS has_note, count(*) FILTER (WHERE kind = 'visit') AS n_visit, count(*) FILTER (WHERE kind = 'note') AS n_note,
           min(d) AS first_date, max(d) AS last_date, p.name, p.sex, CAST(2024 - year(p.birth) AS INTEGER) AS age, CASE WHEN ri.n IS NOT NULL THEN coalesce(ri.t, '') END AS violations,
           fam.family_id, u.unit_name, u.type_name
    FROM i LEFT JOIN d_persons p ON i.person_id = p.person_id LEFT JOIN fam ON fam.person_id = i.person_id LEFT JOIN ri ON ri.person_id = i.person_id LEFT JOIN d_units u ON u.unit_id = i.unit_id
    GROUP BY ALL
    """),
)
def mart_person_tracking(spark, sf):
    case = Casework(spark, sf)
    return marts.person_tracking(case.visits, case.notes, case.persons, case.unit_base, case.raw("members"), AS_OF, updated=case.heartbeat)


@query(
    "mart_service_followup",
    f"""
    WITH {STAR_SQL}, e AS (SELECT family_id, count(*) AS n_notes, min(note_day) AS first_note, max(note_day) AS last_note, arg_max(unit_id, strftime(note_day, '%Y%m%d') || lpad(CAST(note_id AS VARCHAR), 12, '0')) AS unit_id,
      bool_or(note_type = 'D') AS was_closed, min(CASE WHEN note_type = 'D' THEN note_day END) AS closed_on FROM f_notes WHERE scope_code = 7 AND family_id IS NOT NULL GROUP BY 1),
    s AS (SELECT DISTINCT f.family_id FROM d_families f JOIN services v ON v.family_id = f.family_id AND service_id = 1),
    x AS (SELECT coalesce(e.family_id, s.family_id) AS family_id, e.family_id IS NOT NULL AS has_notes, s.family_id IS NOT NULL AS has_service, n_notes, first_note, last_note, unit_id, was_closed, closed_on
          FROM e FULL JOIN s ON e.family_id = s.family_id)
    SELECT m.person_id, x.*, CASE WHEN has_notes AND has_service THEN 'ambos' WHEN has_notes THEN 'evolucao' ELSE 'servico' END AS origin, u.unit_name, u.type_name
    FROM (SELECT DISTINCT person_id, family_id FROM members) m JOIN x ON m.family_id = x.family_id LEFT JOIN d_units u ON u.unit_id = x.unit_id
    """,
)
def mart_service_followup(spark, sf):
    case = Casework(spark, sf)
    return marts.service_followup(case.notes, case.families, case.raw("members"), case.unit_base, 7, 1)


FORM = [Field("Local", "place"), Field("%Data%", "form_day", "date", format="yyyy-MM-dd"), Field("%Localizada%", "located", "boolean")]
FORM_SQL = """CASE WHEN {p}note <> '' THEN 'L' || ({p}note_id % 8) END AS place, CASE WHEN {p}note <> '' AND {p}note_id % 9 <> 0 THEN {p}note_day END AS form_day,
    CASE WHEN {p}note <> '' THEN {p}note_id % 3 = 0 END AS located"""


@query(
    "mart_family_programme",
    f"""
    WITH {STAR_SQL}, o AS (SELECT DISTINCT f.family_id, 'projeto_social' AS origin FROM d_families f JOIN projects p ON p.family_id = f.family_id AND project_id = 2 AND is_active
      UNION SELECT family_id, 'evolucao' FROM f_notes WHERE scope_code = 20 AND family_id IS NOT NULL),
    og AS (SELECT family_id, string_agg(origin, ',' ORDER BY origin) AS origins FROM o GROUP BY 1),
    act AS (SELECT m.family_id, p.*, {age_sql('p.birth', STAYS_AS_OF)} AS age FROM members m JOIN d_persons p ON m.person_id = p.person_id WHERE m.left_on IS NULL),
    fl AS (SELECT family_id, count(*) FILTER (WHERE age BETWEEN 0 AND 6 AND coalesce(doc, '') <> '') AS n_children,
                  arg_min(name, strftime(birth, '%Y%m%d') || name) FILTER (WHERE age BETWEEN 0 AND 6 AND coalesce(doc, '') <> '') AS oldest_child,
                  bool_or(person_id IN (SELECT person_id FROM person_right)) AS any_violation FROM act GROUP BY 1),
    vi AS (SELECT family_id, string_agg(DISTINCT label, ',' ORDER BY label) AS violations FROM act JOIN person_right r ON act.person_id = r.person_id WHERE label IS NOT NULL GROUP BY 1),
    bs AS (SELECT n.family_id, {FORM_SQL.format(p='n.')} FROM f_notes n WHERE scope_code = 20 AND family_id IS NOT NULL AND note <> ''
           QUALIFY row_number() OVER (PARTITION BY family_id ORDER BY note_day DESC, note_id DESC) = 1),
    pa AS (SELECT n.family_id, n.note_id % 5 = 0 AS wants_papers FROM f_notes n WHERE scope_code = 24 AND family_id IS NOT NULL AND note <> ''
           QUALIFY row_number() OVER (PARTITION BY family_id ORDER BY note_day DESC, note_id DESC) = 1)
    SELECT og.family_id, origins, f.head_name, coalesce(n_children, 0) AS n_children, oldest_child, coalesce(any_violation, false) AS any_violation, coalesce(violations, '') AS violations,
           bs.family_id IS NOT NULL AS has_search, place, form_day, located, wants_papers
    FROM og JOIN d_families f ON f.family_id = og.family_id LEFT JOIN fl ON fl.family_id = og.family_id LEFT JOIN vi ON vi.family_id = og.family_id
    LEFT JOIN bs ON bs.family_id = og.family_id LEFT JOIN pa ON pa.family_id = og.family_id
    """,
)
def mart_family_programme(spark, sf):
    case = Casework(spark, sf)
    report = marts.family_programme(
        case.families, case.persons, case.raw("members"), case.notes, 2, 20,
        ("Form B", FORM), (24, "Form C", [Field("%Interesse%", "wants_papers", "exists")]), STAYS_AS_OF,
    )
    return report.withColumns({c: F.array_join(c, ",") for c in ("origins", "violations")})


@query(
    "mart_alternative_measures",
    with_heartbeat(f"""
    WITH {STAR_SQL}, mk AS (SELECT p.person_id, min(pp.unit_id) AS project_unit FROM person_project pp JOIN d_persons p ON pp.person_id = p.person_id WHERE project_id = 3 AND is_active GROUP BY 1),
    e AS (SELECT n.*, CASE WHEN person_sk IS NOT NULL THEN person_id ELSE member_id END AS subject FROM f_notes n WHERE scope_code = 18 AND cancelled_on IS NULL AND module IN ('family', 'person')),
    l AS (SELECT subject, unit_id AS form_unit, family_id, note_day AS last_form_day FROM e WHERE subject IS NOT NULL QUALIFY row_number() OVER (PARTITION BY subject ORDER BY note_day DESC, note_id DESC) = 1),
    a AS (SELECT subject, {FORM_SQL.format(p='e.')} FROM e WHERE subject IS NOT NULL AND note <> '' QUALIFY row_number() OVER (PARTITION BY subject ORDER BY note_day DESC, note_id DESC) = 1),
    op AS (SELECT p.login_id, arg_min(pu.unit_id, pu.unit_name) AS operator_unit FROM d_providers p JOIN provider_unit pu ON pu.provider_id = p.provider_id WHERE p.login_id IS NOT NULL GROUP BY 1),
    x AS (SELECT coalesce(mk.person_id, l.subject) AS person_id, mk.person_id IS NOT NULL AS by_project, l.subject IS NOT NULL AS by_form, coalesce(form_unit, project_unit) AS mark_unit, l.family_id, last_form_day
          FROM mk FULL JOIN l ON mk.person_id = l.subject),
    y AS (SELECT x.*, p.ref_unit_id, op.operator_unit, coalesce(mark_unit, ref_unit_id, operator_unit) AS unit_id FROM x LEFT JOIN d_persons p ON x.person_id = p.person_id LEFT JOIN op ON op.login_id = p.login_id)
    SELECT y.person_id, y.family_id, by_project, by_form, y.unit_id, CASE WHEN mark_unit IS NOT NULL THEN 'marking' WHEN ref_unit_id IS NOT NULL THEN 'reference' WHEN operator_unit IS NOT NULL THEN 'operator' ELSE 'none' END AS unit_origin,
           u.unit_name, u.unit_type_id = 3 AS in_target_type, r.unit_name AS ref_unit_name, last_form_day, place, form_day, located
    FROM y LEFT JOIN d_units u ON u.unit_id = y.unit_id LEFT JOIN d_units r ON r.unit_id = y.ref_unit_id LEFT JOIN a ON a.subject = y.person_id
    """),
)
def mart_alternative_measures(spark, sf):
    case = Casework(spark, sf)
    report = marts.alternative_measures(case.persons, case.notes, case.providers, case.unit_base, 3, 18, ("Form A", FORM), 3, updated=case.heartbeat)
    return report.select(
        "person_id", "family_id", "by_project", "by_form", "unit_id", "unit_origin", "unit_name", "in_target_type", "ref_unit_name",
        "last_form_day", "place", "form_day", "located", "updated_at",
    )


PILOTS = {r"nation_1\b": "Pilot one", r"nation_1": "Pilot ones", r"nation_2[0-3]": "Pilot twenties", r"teste": "Pilot test"}


@query(
    "mart_unit_indicators",
    with_heartbeat(f"""
    WITH {STAR_SQL}, pi AS (SELECT unit_id, x.pilot FROM d_units, (VALUES ('nation_1\\b', 'Pilot one'), ('nation_1', 'Pilot ones'), ('nation_2[0-3]', 'Pilot twenties'), ('teste', 'Pilot test')) AS x(p, pilot)
      WHERE regexp_matches(lower(strip_accents(unit_name)), x.p)),
    s AS (SELECT unit_id, count(DISTINCT CASE WHEN service_id = 1 THEN family_id END) AS n_paif, count(DISTINCT CASE WHEN service_id IN (8, 9) THEN family_id END) AS n_mse FROM services WHERE cancelled_on IS NULL GROUP BY 1),
    v AS (SELECT unit_id, count(DISTINCT person_id) AS n FROM f_visits WHERE coalesce(is_cancelled, 'N') <> 'S' AND person_id IN (SELECT person_id FROM d_persons WHERE street) GROUP BY 1),
    e AS (SELECT unit_id, count(DISTINCT CASE WHEN note_id % 5 = 1 AND note_id % 2 = 0 THEN person_sk END) AS u, count(DISTINCT CASE WHEN note_id % 7 = 1 THEN person_sk END) AS a
          FROM f_notes WHERE note <> '' GROUP BY 1)
    SELECT pilot, pi.unit_id, coalesce(n_paif, 0) AS n_paif, coalesce(n_mse, 0) AS n_mse, coalesce(v.n, 0) AS n_street, coalesce(u, 0) AS n_to_units, coalesce(a, 0) AS n_to_agencies
    FROM pi LEFT JOIN s ON s.unit_id = pi.unit_id LEFT JOIN v ON v.unit_id = pi.unit_id LEFT JOIN e ON e.unit_id = pi.unit_id
    """),
)
def mart_unit_indicators(spark, sf):
    case = Casework(spark, sf)
    street = case.person_base.filter("street")
    referrals = marts.note_referrals(case.notes.select("unit_id", "person_sk", "note"))
    return marts.unit_indicators(
        case.unit_base, PILOTS, case.raw("services"), case.visits, street, referrals, {"paif": [1], "mse": [8, 9]}, updated=case.heartbeat
    )


@query(
    "mart_monthly_unit_report",
    f"""
    WITH {STAR_SQL}, e AS (SELECT unit_id, family_id, CAST(date_trunc('month', registered) AS DATE) = DATE '2001-07-01' AS m, family_id % 30 AS vuln,
      CASE family_id % 3 WHEN 0 THEN 'Bolsa Família' WHEN 1 THEN 'BPC - Idoso' END AS benefit, CASE WHEN family_id % 4 = 0 THEN 'Trabalho Infantil' END AS violation,
      DATE '1980-01-01' + CAST(family_id * 23 AS INTEGER) AS birth FROM services),
    f AS (SELECT unit_id, count(DISTINCT family_id) AS families, count(DISTINCT CASE WHEN m THEN family_id END) AS families_month, count(DISTINCT CASE WHEN m AND benefit = 'Bolsa Família' THEN family_id END) AS families_grant,
                 count(DISTINCT CASE WHEN m AND vuln = 1 THEN family_id END) AS families_conditions, count(DISTINCT CASE WHEN m AND benefit LIKE 'BPC%' THEN family_id END) AS families_pension,
                 count(DISTINCT CASE WHEN m AND violation = 'Trabalho Infantil' AND {age_sql('birth', '2001-07-15')} < 18 THEN family_id END) AS families_child_labour FROM e GROUP BY 1),
    v AS (SELECT unit_id, count(DISTINCT CASE WHEN lower(visit_name) NOT LIKE '%recepção%' THEN visit_id END) AS visits, count(*) FILTER (WHERE lower(visit_name) LIKE '%domiciliar%') AS home_visits FROM f_visits GROUP BY 1),
    n AS (SELECT unit_id, count(DISTINCT CASE WHEN note_id % 5 = 2 AND note_id % 3 = 0 THEN person_id END) AS referred_register, count(DISTINCT CASE WHEN note_id % 5 = 2 AND note_id % 3 = 1 THEN person_id END) AS referred_pension,
                 count(DISTINCT CASE WHEN note_id % 7 = 1 THEN person_id END) AS referred_agency FROM f_notes WHERE note <> '' GROUP BY 1)
    SELECT u.unit_id, unit_name, coalesce(referred_register, 0) AS referred_register, coalesce(referred_pension, 0) AS referred_pension, coalesce(referred_agency, 0) AS referred_agency, coalesce(families, 0) AS families, coalesce(families_month, 0) AS families_month, coalesce(families_grant, 0) AS families_grant, coalesce(families_conditions, 0) AS families_conditions,
           coalesce(families_pension, 0) AS families_pension, coalesce(families_child_labour, 0) AS families_child_labour, coalesce(visits, 0) AS visits, coalesce(home_visits, 0) AS home_visits
    FROM d_units u LEFT JOIN f ON f.unit_id = u.unit_id LEFT JOIN v ON v.unit_id = u.unit_id LEFT JOIN n ON n.unit_id = u.unit_id
    """,
)
def mart_monthly_unit_report(spark, sf):
    case = Casework(spark, sf)
    family = F.col("family_id")
    enrolled = case.raw("services").select(
        "unit_id", "family_id", "registered", (family % 30).alias("vulnerability_id"),
        F.when(family % 3 == 0, "Bolsa Família").when(family % 3 == 1, "BPC - Idoso").alias("benefit"),
        F.when(family % 4 == 0, "Trabalho Infantil").alias("violation"),
        F.date_add(F.lit("1980-01-01").cast("date"), (family * 23).cast("int")).alias("birth"),
    )
    referrals = marts.note_referrals(case.notes.select("unit_id", "person_id", "note"), labels=marts.BENEFIT_LABELS)
    return marts.monthly_unit_report(case.unit_base, enrolled, case.visits, referrals, "2001-07-15")


@query(
    "mart_card_control",
    """
    WITH c AS (SELECT o_custkey % 700 AS doc, CAST(date_trunc('month', o_orderdate) AS DATE) AS part_date, min(o_orderkey) AS card_id FROM orders GROUP BY 1, 2),
    d AS (SELECT o_custkey % 700 AS doc, CAST(date_trunc('month', o_orderdate) AS DATE) AS part_date, CAST(o_orderdate AS DATE) AS edited, o_orderkey AS delivery_id,
                 CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS delivered_on, CASE WHEN o_orderkey % 3 = 0 THEN 'place ' || (o_orderkey % 9) END AS place,
                 CASE WHEN o_orderkey % 6 = 0 THEN 'receiver ' || (o_orderkey % 4) END AS receiver FROM orders WHERE o_orderpriority <> '5-LOW'),
    t AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY doc, part_date ORDER BY edited DESC, delivery_id DESC) = 1),
    f AS (SELECT * FROM d WHERE delivered_on IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc ORDER BY part_date, edited, delivery_id) = 1)
    SELECT c.*, coalesce(t.place, CASE WHEN f.part_date <= c.part_date THEN f.place END) AS place, coalesce(t.delivered_on, CASE WHEN f.part_date <= c.part_date THEN f.delivered_on END) AS delivered_on,
           coalesce(t.receiver, CASE WHEN f.part_date <= c.part_date THEN f.receiver END) AS receiver,
           CASE WHEN t.delivered_on IS NOT NULL OR f.part_date <= c.part_date THEN 'CARTAO ENTREGUE' END AS state, f.part_date AS first_month
    FROM c LEFT JOIN t ON t.doc = c.doc AND t.part_date = c.part_date LEFT JOIN f ON f.doc = c.doc
    """,
)
def mart_card_control(spark, sf):
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    rows = table(spark, sf, "orders").withColumns({"doc": F.col("o_custkey") % 700, "part_date": F.trunc(day, "month")})
    cards = rows.groupBy("doc", "part_date").agg(F.min("o_orderkey").alias("card_id"))
    numbered = lambda word, n: F.concat(F.lit(word), (key % n).cast("string"))
    deliveries = rows.filter("o_orderpriority <> '5-LOW'").select(
        "doc", "part_date", day.alias("edited"), key.alias("delivery_id"),
        F.when(key % 3 == 0, day).alias("delivered_on"),
        F.when(key % 3 == 0, numbered("place ", 9)).alias("place"),
        F.when(key % 6 == 0, numbered("receiver ", 4)).alias("receiver"),
    )
    return marts.card_control(cards, deliveries)


@query(
    "mart_payroll",
    """
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_trunc('year', l_shipdate) AS DATE) AS part_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CASE WHEN year(l_shipdate) >= 2000 THEN 35 ELSE 34 END AS n FROM lineitem),
    w AS (SELECT *, sum(v) OVER (PARTITION BY part_date, l_orderkey) AS total FROM t)
    SELECT part_date, n AS field_count, CASE WHEN total <= 30000 THEN 'ate 30000' WHEN total <= 60000 THEN '30001 a 60000' ELSE 'acima' END AS family_band, count(*) AS n_lines,
           CAST(sum(v) AS DOUBLE) AS benefit, CAST(max(total) AS DOUBLE) AS largest_family FROM w GROUP BY 1, 2, 3
    """,
)
def mart_payroll(spark, sf):
    parsed = parse_layout(payroll_lines(spark, sf), "line", POSITIONS, {35: 25}).withColumn("part_date", F.trunc("start_day", "year"))
    banded = family_bands(
        parsed.select("l_orderkey", "l_linenumber", "l_partkey", "part_date", "family_code", "field_count", F.col("benefit").cast("decimal(18,2)").alias("benefit")),
        ["part_date", "family_code"], "benefit", ["l_orderkey", "l_linenumber", "l_partkey"],
        [(30_000, "ate 30000"), (60_000, "30001 a 60000")], "acima",
    )
    return banded.groupBy("part_date", "field_count", "family_band").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("benefit").cast("double").alias("benefit"), F.max("family_total").cast("double").alias("largest_family")
    )


@query(
    "mart_outreach",
    "WITH RECURSIVE "
    + ORACLES["exact_rule_dedup"].split("WITH RECURSIVE", 1)[1].rsplit("SELECT id, cluster_id", 1)[0]
    + """, z AS (SELECT id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size FROM labelled)
    SELECT o_orderstatus AS team, year(o_orderdate) AS yr, count(*) AS n_contacts, count(DISTINCT cluster_id) AS n_people, max(cluster_size) AS largest,
           count(*) FILTER (WHERE cluster_id <> id) AS n_duplicates FROM orders JOIN z ON o_orderkey = id GROUP BY 1, 2
    """,
)
def mart_outreach(spark, sf):
    """Contacts with their form and the person they belong to after matching."""
    clusters = exact_rule_dedup(contacts(spark, sf), "id", person_rules("doc", "name", "mother", "father", "birth"), within=["yr"])
    forms = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("team"), F.year("o_orderdate").cast("long").alias("yr"))
    joined = forms.join(clusters.select("id", "cluster_id", "cluster_size", "is_duplicate"), "id")
    per_person = joined.groupBy("team", "yr", "cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("cluster_size").alias("s"), F.count_if("is_duplicate").alias("d")
    )
    return per_person.groupBy("team", "yr").agg(
        F.sum("n").alias("n_contacts"), F.count("cluster_id").alias("n_people"), F.max("s").alias("largest"), F.sum("d").alias("n_duplicates")
    )
