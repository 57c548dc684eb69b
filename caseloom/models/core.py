"""Conformed dimensions and facts. Every function takes and returns DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.codes import Domain, map_domain, yes_no
from caseloom.functions.dates import as_date, stay_days
from caseloom.functions.keys import surrogate_key
from caseloom.functions.text import is_test_name
from caseloom.operators.capacity import code_flags, unify_capacity
from caseloom.operators.explode import explode_codes, explode_days, explode_id_list, explode_shared
from caseloom.operators.skew import key_statistics, skew_join, stored_with_statistics
from caseloom.session import cut_lineage


def coded_items(df: DataFrame, key: str, codes: str, domain: Domain, out: str) -> DataFrame:
    """Distinct codes of a list column as an ordered array of (code, label) per key.

    The array is as long as the code table, whatever the number of rows.
    """
    rows = explode_codes(df, [key], codes, domain).distinct()
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("code", "label"))).alias(out))


def family_items(df: DataFrame, items: list[str], newest: list[str], out: str) -> DataFrame:
    """Items of a family as an ordered array: each distinct item once with its
    row count and its greatest ``newest`` values, so the array is as long as the
    item list of a family, whatever the number of rows.
    """
    per_item = df.groupBy("family_id", *items).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.struct(*newest)).alias("_newest")
    )
    fields = [*items, "n_rows", *[F.col(f"_newest.{c}").alias(c) for c in newest]]
    return per_item.groupBy("family_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def newest_items(df: DataFrame, items: str, key: str, by: list[str]) -> DataFrame:
    """Rows whose array has one item per key, the greatest by the tuple ``by`` (NULL is the smallest), in the order of keys.

    It works inside a row: nothing is listed, sorted or moved between rows.
    """
    ranked = F.transform(items, lambda p: F.struct(p[key].alias("key"), F.struct(*[p[c] for c in by]).alias("by"), p.alias("item")))
    ordered = df.withColumn(items, F.array_sort(ranked))
    last_of_key = lambda p, i: (i + 1 == F.size(items)) | ~F.get(items, i + 1)["key"].eqNullSafe(p["key"])
    return ordered.withColumn(items, F.transform(F.filter(items, last_of_key), lambda p: p["item"]))


#: Families of persons with several of them that a task merges, each with an array of projects.
FAMILIES_A_TASK = 50_000


def person_projects(members: DataFrame, projects: DataFrame) -> DataFrame:
    """Projects of a person's active families, each project once, the newest registration kept.

    A family is reduced to the newest registration of each project first. A person of one
    family takes its array as it is; the arrays of a person of several are merged, dealt out to as
    many tasks as there are such rows.
    """
    rule = ("projects", "project_id", ["registered", "unit_id", "is_active"])
    newest = newest_items(projects.select("family_id", "projects"), *rule)
    active = members.filter(F.col("left_on").isNull() & F.col("family_id").isNotNull()).select("person_id", "family_id")
    known = key_statistics(active, ["family_id"])
    families = active.groupBy("person_id").agg(F.min("family_id").alias("family_id"), F.max("family_id").alias("_last"))
    of_one = skew_join(families.filter("family_id = _last").drop("_last"), newest, ["family_id"], ["person_id"], how="inner", count_on=known)
    more = families.filter("family_id <> _last").select(F.col("person_id").alias("_person"))
    several = active.join(more, F.col("person_id").eqNullSafe(F.col("_person")), "left_semi").distinct()
    several = cut_lineage(several, "several-families")
    dealt = several.repartition(several.count() // FAMILIES_A_TASK + 1, "person_id")
    joined = skew_join(dealt, newest, ["family_id"], ["person_id"], how="inner", count_on=known)
    merged = joined.groupBy("person_id").agg(F.flatten(F.collect_list("projects")).alias("projects"))
    return of_one.select("person_id", "projects").unionByName(newest_items(merged, *rule))


def unit_places(config: DataFrame, capacity: DataFrame) -> DataFrame:
    """Places and audience flags per unit."""
    audiences = capacity.select("unit_id", F.explode(F.split(F.coalesce("audiences", F.lit("")), ",")).alias("a"))
    flags = code_flags(
        audiences.withColumn("a", F.trim("a")), ["unit_id"], "a", {"adult": "a", "family": "f", "elderly": "i"}
    )
    joined = config.join(capacity, "unit_id", "left").join(flags, "unit_id", "left")
    return unify_capacity(
        joined, F.col("manages") == "S", ["men", "women", "neutral"], "beds", ["blocked_repair", "blocked_court"]
    )


def dim_units(units: DataFrame, types: DataFrame, places: DataFrame, emails: DataFrame) -> DataFrame:
    """Units without test units, with type, places and one contact text.

    Sheet addresses are gathered per unit name before the join, so a unit with
    two addresses stays one row.
    """
    sheet = (
        emails.select(F.lower(F.trim("unit_name")).alias("_name"), "email").distinct()
        .groupBy("_name").agg(F.array_join(F.array_sort(F.collect_list("email")), ", ").alias("sheet_email"))
    )
    named = units.filter(~is_test_name(F.col("unit_name"))).withColumn("_name", F.lower(F.trim("unit_name")))
    contact = F.concat(
        F.coalesce("region_email", F.lit("")), F.lit(","), F.coalesce("sheet_email", F.lit("")), F.lit(", "),
        F.coalesce("unit_email", F.lit("")),
    )
    wide = named.join(types, "unit_type_id", "left").join(places, "unit_id", "left").join(sheet, "_name", "left")
    return wide.withColumn("contact", contact).withColumn("unit_sk", surrogate_key(F.col("unit_id"))).drop("_name")


def dim_providers(
    providers: DataFrame, operators: DataFrame, occupations: DataFrame, operator_units: DataFrame, units: DataFrame, levels: Domain
) -> DataFrame:
    """Providers with account, occupations and the units of their account."""
    occ = occupations.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("n_occupations"),
        F.array_join(
            F.transform(F.array_sort(F.collect_set(F.struct("occupation_code", "occupation"))), lambda o: o["occupation"]), " | "
        ).alias("occupations"),
        F.array_join(F.array_sort(F.collect_set("occupation_code")), " | ").alias("occupation_codes"),
    )
    linked = operator_units.join(units.select("unit_id", "unit_name"), "unit_id").distinct()
    working = linked.groupBy("login_id").agg(F.array_sort(F.collect_list(F.struct("unit_name", "unit_id"))).alias("_u"))
    working = working.select(
        "login_id",
        F.transform("_u", lambda u: u["unit_id"]).alias("unit_ids"),
        F.array_join(F.transform("_u", lambda u: u["unit_name"]), ", ").alias("unit_names"),
    )
    wide = (
        providers.filter(~is_test_name(F.col("provider_name")))
        .join(operators, "login_id", "left")
        .join(occ, "provider_id", "left")
        .join(working, "login_id", "left")
    )
    return (
        wide.withColumn("n_occupations", F.coalesce("n_occupations", F.lit(0)))
        .withColumn("many_occupations", yes_no(F.col("n_occupations") > 1))
        .withColumn("access_profile", map_domain(F.col("level"), levels))
        .withColumn("n_units", F.coalesce(F.array_size("unit_ids"), F.lit(0)))
        .withColumn("without_account", F.col("login_id").isNull())
        .withColumn("provider_sk", surrogate_key(F.col("provider_id")))
    )


def dim_persons(persons: DataFrame, rights: DataFrame, benefits: DataFrame, projects: DataFrame, races: Domain) -> DataFrame:
    """Persons without test records, with nested rights violations, benefits and projects."""
    wide = person_base(persons, races)
    for part in (rights, benefits, projects):
        wide = wide.join(part, "person_id", "left")
    return wide.withColumn("has_violation", yes_no(F.col("rights").isNotNull()))


def dim_families(
    families: DataFrame, persons: DataFrame, vulnerabilities: DataFrame, services: DataFrame, projects: DataFrame
) -> DataFrame:
    """Families whose head is a known person, with their nested collections."""
    heads = persons.select(F.col("person_id").alias("head_id"), F.col("name").alias("head_name"))
    wide = skew_join(families, heads, ["head_id"], ["family_id"], how="inner")
    for items in (vulnerabilities, services, projects):
        wide = wide.join(items, "family_id", "left")
    return wide.withColumn("family_sk", surrogate_key(F.col("family_id")))


def person_base(persons: DataFrame, races: Domain) -> DataFrame:
    """``dim_persons`` without its nested parts, for facts and marts that need none of them."""
    known = persons.filter(~is_test_name(F.col("name")))
    return known.withColumn("race", map_domain(F.col("race_code"), races)).withColumn("person_sk", surrogate_key(F.col("person_id")))


def provider_base(providers: DataFrame) -> DataFrame:
    """Keys and names of ``dim_providers`` alone."""
    known = providers.filter(~is_test_name(F.col("provider_name")))
    return known.withColumn("provider_sk", surrogate_key(F.col("provider_id")))


def unit_base(units: DataFrame, types: DataFrame) -> DataFrame:
    """``dim_units`` without places and contact."""
    known = units.filter(~is_test_name(F.col("unit_name")))
    return known.join(types, "unit_type_id", "left").withColumn("unit_sk", surrogate_key(F.col("unit_id")))


def person_keys(persons: DataFrame) -> DataFrame:
    """Keys of persons as a table of their own.

    The source's files are far smaller than its keys are in memory, so by them the optimizer takes a table
    for small that is not. Keys hardly compress: the size of this table tells whether it can be broadcast.
    """
    return cut_lineage(persons.select("person_id", "person_sk"), "person-keys")


def fct_visits(visits: DataFrame, persons: DataFrame, providers: DataFrame, units: DataFrame) -> DataFrame:
    """Visit by provider: the main provider and every other one from the shared list."""
    rows = explode_shared(visits, "provider_id", "shared_providers")
    rows = rows.withColumn("visit_sk", surrogate_key(F.col("module"), F.col("visit_id"), F.col("provider_id")))
    rows, known = stored_with_statistics(rows, "visit-rows", ["person_id"], ["provider_id"])
    spread = ["visit_id", "provider_id"]
    with_person = skew_join(rows, person_keys(persons), ["person_id"], spread, count_on=known)
    with_provider = skew_join(with_person, providers.select("provider_id", "provider_sk"), ["provider_id"], ["visit_id"], count_on=known)
    # units: size-checked broadcast by the optimizer, split by AQE beyond it
    return with_provider.join(units.select("unit_id", "unit_sk"), "unit_id", "left")


def fct_notes(
    admin: DataFrame, family: DataFrame, person: DataFrame, group: DataFrame,
    persons: DataFrame, providers: DataFrame, units: DataFrame,
) -> DataFrame:
    """Notes of four modules in one shape; a group note becomes one row per listed person.

    Administrative notes name an account: it is resolved to its provider first.
    """
    accounts = providers.filter(F.col("login_id").isNotNull()).select("login_id", "provider_id")
    by_login = skew_join(admin, accounts, ["login_id"], ["note_id"]).drop("login_id")
    listed = explode_id_list(group.filter(F.col("cancelled_on").isNull()), "person_list", "person_id").drop("person_list")
    tagged = [
        df.withColumn("module", F.lit(tag))
        for tag, df in (("admin", by_login), ("family", family), ("person", person), ("group", listed))
    ]
    notes = tagged[0]
    for df in tagged[1:]:
        notes = notes.unionByName(df, allowMissingColumns=True)
    notes = notes.withColumn("note_sk", surrogate_key(F.col("module"), F.col("note_id"), F.col("person_id")))
    notes, known = stored_with_statistics(notes, "note-rows", ["person_id"], ["provider_id"])
    with_person = skew_join(notes, person_keys(persons), ["person_id"], ["note_id"], count_on=known)
    with_provider = skew_join(with_person, providers.select("provider_id", "provider_sk"), ["provider_id"], ["note_id"], count_on=known)
    return with_provider.join(units.select("unit_id", "unit_sk"), "unit_id", "left")


def fct_stays(stays: DataFrame, persons: DataFrame, units: DataFrame, as_of) -> DataFrame:
    """One row per stay that has begun, with its inclusive length and an open flag."""
    begun = stays.filter(F.col("entered_on") <= as_date(as_of))
    with_person = skew_join(begun, persons.select("person_id", "person_sk", "doc"), ["person_id"], ["stay_id"])
    wide = with_person.join(units.select("unit_id", "unit_sk", "audiences"), "unit_id", "left")
    return (
        wide.withColumn("stay_days", stay_days(F.col("entered_on"), F.col("left_on")))
        .withColumn("is_open", F.when(F.col("left_on").isNull(), 1).otherwise(0))
        .withColumn("stay_sk", surrogate_key(F.col("stay_id")))
    )


def fct_stay_days(stays: DataFrame, as_of) -> DataFrame:
    """One row per stay and day."""
    return explode_days(stays, "entered_on", "left_on", as_of)


def fct_attendance(presences: DataFrame, persons: DataFrame) -> DataFrame:
    """Presences of known persons."""
    known = skew_join(presences, persons.select("person_id", "person_sk"), ["person_id"], ["presence_id"], how="inner")
    return known.withColumn("presence_sk", surrogate_key(F.col("presence_id")))


def dim_activities(activities: DataFrame, types: DataFrame, units: DataFrame) -> DataFrame:
    """Group activities with the name of their type and, unless it is a test unit, of their unit."""
    known = units.select("unit_id", "unit_name")
    return activities.join(types, "activity_type_id", "left").join(known, "unit_id", "left")


def fct_provider_attendance(presences: DataFrame, providers: DataFrame) -> DataFrame:
    """Presences of known providers at group activities."""
    parts = ("activity_id", "provider_id", "presence_day", "clock")
    keyed = presences.withColumn("presence_sk", surrogate_key(*[F.col(c) for c in parts]))
    return skew_join(keyed, providers.select("provider_id", "provider_sk"), ["provider_id"], ["presence_sk"], how="inner", count_on=presences)
