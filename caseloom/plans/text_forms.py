"""Form notes, labelled segments and positional lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.text import labelled_segment, strip_tags
from caseloom.operators.forms import Field, Form, html_fields, pivot_forms
from caseloom.operators.layout import Position, parse_layout
from caseloom.plans.registry import query
from caseloom.sources.tables import table


def follow_up_notes(spark, sf):
    """Notes with a repeated label, a tag that is not closed, an empty first block, a second block and remarks."""
    key = F.col("o_orderkey")
    block = F.concat(
        F.lit("Day: <b>"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit("</b><br>Reason :<b> "), F.col("o_orderstatus"), F.lit(" </b>"),
        F.when(key % 3 == 0, F.concat(F.lit("<br/>Reason: <b>"), F.col("o_orderpriority"), F.lit("</b>"))).otherwise(""),
        F.when(key % 7 == 0, "<br>Open: <b>not closed<br>").otherwise("<i>"),
        F.lit("Clerk <b></b>"),
    )
    note = F.concat(
        F.lit("<h3>Follow-up "), (key % 4).cast("string"), F.lit("</h3><p>"), F.when(key % 11 == 0, "").otherwise(block),
        F.lit("</p><p>Second: <b>not read</b></p>"),
        F.when(key % 2 == 0, F.concat(F.lit("\n<h3>OBSERVAÇÕES</h3> seen by\n"), F.col("o_custkey").cast("string"))).otherwise(""),
    )
    return table(spark, sf, "orders").select("o_orderkey", note.alias("note"))


@query(
    "html_fields",
    """
    WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day, o_orderstatus, o_orderpriority, 'Follow-up ' || (o_orderkey % 4) AS form_title,
                      CASE WHEN o_orderkey % 2 = 0 THEN 'seen by' || chr(10) || o_custkey END AS remarks
               FROM orders WHERE o_orderkey % 11 <> 0),
    f AS (SELECT o_orderkey, 'Day' AS label, day AS value FROM o UNION ALL SELECT o_orderkey, 'Reason', o_orderstatus FROM o
          UNION ALL SELECT o_orderkey, 'Reason', o_orderpriority FROM o WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 'Clerk', '' FROM o)
    SELECT o_orderkey, form_title, label, value, remarks FROM f JOIN o USING (o_orderkey)
    """,
)
def labelled_fields(spark, sf):
    return html_fields(follow_up_notes(spark, sf), ["o_orderkey"], "note")


FORM_TITLE = "Order follow-up"


def order_notes(spark, sf):
    """One HTML note per order with labelled fields, some missing or malformed."""
    key = F.col("o_orderkey")
    bold = lambda label, value: F.concat(F.lit(f"{label}: <b>"), value, F.lit("</b><br>"))
    day = F.when(key % 4 == 0, "not a date").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    title = F.when(key % 10 == 9, "Other form").otherwise(FORM_TITLE)
    body = F.concat(
        bold("Visit date", day),
        bold("Amount of visit", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        bold("Located", F.when(key % 2 == 0, "Sim").otherwise("Não")),
        bold("Reasons", F.concat("o_orderstatus", F.lit(", ,"), "o_orderpriority")),
        F.when(key % 3 == 0, bold("Interest shown", F.lit("x"))).otherwise(""),
        bold("Referrals", F.when(key % 5 == 0, "undefined").otherwise(F.col("o_orderpriority"))),
    )
    html = F.concat(F.lit("<h3>"), title, F.lit("</h3><p>"), body, F.lit("</p><h3>OBSERVAÇÕES</h3> seen"))
    return table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("note_day"), html.alias("note"))


@query(
    "form_pivot",
    """
    WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 10 <> 9),
    l AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey DESC) = 1),
    r AS (SELECT o_custkey, string_agg(DISTINCT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END, '|' ORDER BY CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END) AS refs
          FROM o GROUP BY 1)
    SELECT l.o_custkey, true AS has_form, CASE WHEN o_orderkey % 4 <> 0 THEN day END AS visit_date,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, o_orderkey % 2 = 0 AS located, o_orderstatus || '|' || o_orderpriority AS reasons,
           o_orderkey % 3 = 0 AS interest, coalesce(refs, '') AS all_referrals
    FROM l LEFT JOIN r ON l.o_custkey = r.o_custkey
    """,
)
def form_pivot(spark, sf):
    newest = [
        Field("%Visit date%", "visit_date", "date"),
        Field("%Amount%", "amount", "number", cast="double"),
        Field("%Located%", "located", "boolean"),
        Field("%Reasons%", "reasons", "array"),
        Field("%Interest%", "interest", "exists"),
    ]
    forms = [Form(FORM_TITLE, newest, latest=True, flag="has_form"), Form(FORM_TITLE, [Field("%Referrals%", "all_referrals", "array_agg")])]
    pivoted = pivot_forms(order_notes(spark, sf), ["o_custkey"], "note", forms, ["note_day", "o_orderkey"])
    return pivoted.withColumns({"reasons": F.array_join("reasons", "|"), "all_referrals": F.array_join("all_referrals", "|")})


@query(
    "regex_extract_referrals",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'CRAS ' || o_custkey END AS to_units,
           CASE WHEN o_orderkey % 4 = 1 THEN 'CREAS, ' || o_orderpriority END AS to_agencies
    FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 4 = 1
    """,
)
def referrals(spark, sf):
    key = F.col("o_orderkey")
    units = F.when(
        key % 3 != 0, F.concat(F.lit("<p>Referral - Units: <b>CRAS "), F.col("o_custkey").cast("string"), F.lit("</b></p>"))
    ).otherwise("<p>none</p>")
    agencies = F.when(
        key % 4 == 1, F.concat(F.lit("<br><i>Referral Agencies:</i><b>CREAS, "), "o_orderpriority", F.lit("</b>"))
    ).otherwise("")
    notes = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("<div>"), units, agencies, F.lit("<p>Other: none</p></div>")).alias("note")
    )
    plain = strip_tags(F.col("note"))
    found = notes.select(
        "o_orderkey",
        labelled_segment(plain, "Referral - Units", ["Referral", "Other"]).alias("to_units"),
        labelled_segment(plain, "Referral Agencies", ["Referral", "Other"]).alias("to_agencies"),
    )
    return found.filter(F.col("to_units").isNotNull() | F.col("to_agencies").isNotNull())


POSITIONS = [
    Position("program", 0),
    Position("reference_month", 1, "month"),
    Position("family_code", 4),
    Position("benefit", 12, "decimal"),
    Position("start_day", 17, "date"),
    Position("work", 24),
    Position("income", 25, "decimal"),
    Position("n_people", 27, "integer"),
    Position("updated", 28, "date"),
    Position("phone", 33),
]


def payroll_lines(spark, sf):
    """Payroll lines made of line items: 34 fields, 35 from the year 2000 on, one extra before field 25."""
    day = F.col("l_shipdate")
    values = {
        0: F.lit(' "P1" '),
        1: F.when(F.col("l_linenumber") == 7, "209913").otherwise(F.date_format(day, "yyyyMM")),
        4: F.col("l_orderkey").cast("string"),
        12: F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")),
        17: F.date_format(day, "yyyyMMdd"),
        24: F.col("l_returnflag"),
        25: F.when(F.col("l_linestatus") == "O", "abc").otherwise(F.concat((F.col("l_quantity").cast("int")).cast("string"), F.lit(",5"))),
        27: F.col("l_linenumber").cast("string"),
        28: F.when(F.col("l_tax") > 0.06, "").otherwise(F.date_format(day, "yyyyMMdd")),
        33: F.concat(F.lit("55"), F.col("l_partkey").cast("string")),
    }
    base = [values.get(i, F.lit("")) for i in range(34)]
    old = F.concat_ws(";", *base)
    new = F.concat_ws(";", *base[:25], F.lit("extra"), *base[25:])
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.year(day) >= 2000, new).otherwise(old).alias("line")
    )


@query(
    "positional_layout_parse",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN year(l_shipdate) >= 2000 THEN 35 ELSE 34 END AS field_count, 'P1' AS program,
           CASE WHEN l_linenumber <> 7 THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS reference_month, CAST(l_orderkey AS VARCHAR) AS family_code,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS benefit, CAST(l_shipdate AS DATE) AS start_day, l_returnflag AS work,
           CASE WHEN l_linestatus <> 'O' THEN CAST(l_quantity AS INTEGER) + 0.5::DOUBLE END AS income, CAST(l_linenumber AS BIGINT) AS n_people,
           CASE WHEN l_tax <= 0.06 THEN CAST(l_shipdate AS DATE) END AS updated, '55' || l_partkey AS phone
    FROM lineitem
    """,
)
def positional_layout_parse(spark, sf):
    parsed = parse_layout(payroll_lines(spark, sf), "line", POSITIONS, {35: 25})
    return parsed.withColumns({"benefit": F.col("benefit").cast("double"), "income": F.col("income").cast("double")})
