"""Form notes written as HTML: field extraction, latest form, typed pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.dates import parse_date
from caseloom.functions.text import WHITE_SPACE, extract_or_null, trim_space

# Headings that open the free-text section of a note.
NOTE_HEADINGS = ("OBSERVAÇÕES", "CONTEÚDO E DESCRIÇÃO")

# Text up to ``<b>value</b>``. A field can only begin at the start, after ``<`` or
# after the field before it, and never gives characters back: linear in the text.
FIELD_PATTERN = r"(?:^|(?<=<)|(?<=</b>))[^<]++<b>[^<]*</b>"


def _label_and_value(pieces: Column) -> Column:
    """Each ``label: <b>value</b>`` taken apart; remains of a tag before the label are dropped.

    Step by step, so that no part of a piece is computed twice.
    """
    halves = F.transform(
        pieces,
        lambda p: F.struct(
            F.rtrim(F.substring_index(p, "<b>", 1), F.lit(WHITE_SPACE)).alias("head"),
            F.substring_index(F.substring_index(p, "</b>", 1), "<b>", -1).alias("value"),
        ),
    )
    without_colon = lambda h: F.when(h.endswith(":"), h.substr(F.lit(1), F.length(h) - 1)).otherwise(h)
    bare = F.transform(halves, lambda f: F.struct(without_colon(f["head"]).alias("head"), f["value"].alias("value")))
    return F.transform(
        bare,
        lambda f: F.struct(
            F.when(
                ~F.contains(f["head"], F.lit("\n")),
                trim_space(f["head"].substr(F.instr(f["head"], F.lit(">")) + 1, F.length(f["head"]))),
            ).alias("label"),
            trim_space(f["value"]).alias("value"),
        ),
    )


def _inside(source: Column, tag: str) -> Column:
    """Content of the first element of a tag, NULL when there is none."""
    element = F.regexp_substr(source, F.lit(f"<{tag}>(.*?)</{tag}>"))
    return element.substr(F.lit(len(tag) + 3), F.length(element) - (2 * len(tag) + 5))


def note_fields(
    df: DataFrame, id_cols: Sequence[str], html: str, block: str = "p", title: str = "h3", wanted: Sequence[str] = ()
) -> DataFrame:
    """Notes with their title, remarks and the array of (label, value) of the first block.

    With ``wanted`` only notes of those titles that have fields. The text is searched
    in one projection; the test is made on the exploded struct, because a filter
    above would be pushed down and search the text again.
    """
    source = F.col(html)
    headings = "|".join(NOTE_HEADINGS)
    remarks = extract_or_null(source, f"</{block}>\\s*<{title}>(?:{headings})</{title}>\\s*([\\s\\S]*)$")
    found = df.filter(source.contains("<b>")).select(
        *id_cols,
        _inside(source, title).alias("form_title"),
        *([] if wanted else [remarks.alias("remarks")]),
        F.regexp_extract_all(_inside(source, block), F.lit(FIELD_PATTERN), F.lit(0)).alias("_pieces"),
    )
    pieces = F.col("_pieces")
    if wanted:
        pieces = F.when(F.col("form_title").isin(*wanted) & (F.size("_pieces") > 0), pieces)
    parsed = F.filter(F.array(_label_and_value(pieces)), lambda f: f.isNotNull())
    kept = [c for c in found.columns if c != "_pieces"]
    return found.select(*kept, F.explode(parsed).alias("fields"))


def html_fields(df: DataFrame, id_cols: Sequence[str], html: str, block: str = "p", title: str = "h3") -> DataFrame:
    """One row per ``label: <b>value</b>`` in the first block of each note."""
    notes = note_fields(df, id_cols, html, block, title)
    return notes.select(*id_cols, "form_title", "remarks", F.explode("fields").alias("_f")).select(
        *id_cols, "form_title", "_f.label", "_f.value", "remarks"
    )


@dataclass(frozen=True)
class Field:
    """A form field: label LIKE pattern, output column and type.

    Types: ``string``, ``array`` (split by ``separator``), ``array_agg``,
    ``boolean`` (equals ``true_value``), ``date``, ``exists``, ``number``.
    """

    label: str
    name: str
    type: str = "string"
    separator: str = ","
    true_value: str = "Sim"
    format: str = "d/M/yyyy"
    cast: str = "long"

    def of_note(self) -> Column:
        """Greatest value of the field in one note, or all its values."""
        hits = F.transform(F.filter("fields", lambda f: f["label"].like(self.label)), lambda f: f["value"])
        if self.type == "array_agg":
            return F.array_distinct(F.filter(hits, lambda v: v != "undefined")).alias(self.name)
        return F.array_max(hits).alias(self.name)

    def of_notes(self) -> Column:
        """The same over several notes."""
        if self.type == "array_agg":
            return F.array_distinct(F.flatten(F.collect_set(self.name))).alias(self.name)
        return F.max(self.name).alias(self.name)

    def typed(self, raw: Column) -> Column:
        if self.type == "array":
            parts = F.filter(F.transform(F.split(raw, self.separator), lambda t: F.trim(t)), lambda t: t != "")
            return F.coalesce(parts, F.array().cast("array<string>"))
        if self.type == "array_agg":
            return F.array_sort(F.coalesce(raw, F.array().cast("array<string>")))
        if self.type == "boolean":
            return raw == self.true_value
        if self.type == "date":
            return parse_date(raw, self.format)
        if self.type == "exists":
            return raw.isNotNull()
        if self.type == "number":
            return raw.try_cast(self.cast)
        return raw


def extract_form(
    df: DataFrame,
    keys: Sequence[str],
    html: str,
    title: str,
    fields: Sequence[Field],
    latest_by: Sequence[str] = (),
    flag: str | None = None,
) -> DataFrame:
    """One typed row per key from its form notes with the given title.

    With ``latest_by`` only the newest note counts; forms equal in every
    ``latest_by`` column are merged by maximum. Each note is pivoted in its own row,
    so only the wanted values are shuffled, never the text.
    """
    keys, order = list(keys), list(latest_by)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    notes = note_fields(df.filter(present), keys + order, html, wanted=[title])
    pivoted = notes.select(*keys, *order, *[f.of_note() for f in fields])
    per_key = pivoted.groupBy(*keys, *order).agg(*[f.of_notes() for f in fields])
    if order:
        values = F.struct(*[F.col(f.name) for f in fields])
        newest = per_key.groupBy(*keys).agg(F.max_by(values, F.struct(*order)).alias("_v"))
        per_key = newest.select(*keys, "_v.*")
    extra = [F.lit(True).alias(flag)] if flag else []
    return per_key.select(*keys, *extra, *[f.typed(F.col(f.name)).alias(f.name) for f in fields])


def extract_forms(
    df: DataFrame, keys: Sequence[str], html: str, forms: Mapping[str, Sequence[Field]]
) -> DataFrame:
    """One typed row per key from its notes of several titles, read in one pass.

    ``forms`` maps a title to the fields taken from its notes; field names are unique
    over all titles. A key without notes of a title has NULL in that title's fields.
    """
    keys = list(keys)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    notes = note_fields(df.filter(present), keys, html, wanted=list(forms))
    fields = [f for listed in forms.values() for f in listed]
    own = [
        F.when(F.col("form_title") == title, f.of_note()).alias(f.name) for title, listed in forms.items() for f in listed
    ]
    per_key = notes.select(*keys, "form_title", *own).groupBy(*keys).agg(
        *[f.of_notes() for f in fields], *[F.bool_or(F.col("form_title") == t).alias(f"_has_{i}") for i, t in enumerate(forms)]
    )
    typed = [
        F.when(F.col(f"_has_{i}"), f.typed(F.col(f.name))).alias(f.name) for i, listed in enumerate(forms.values()) for f in listed
    ]
    return per_key.select(*keys, *typed)


@dataclass(frozen=True)
class Form:
    """A form to take from notes: its title, fields, which notes may hold it, and whether only the newest counts."""

    title: str
    fields: Sequence[Field]
    where: Column | None = None
    latest: bool = False
    flag: str | None = None


def pivot_forms(df: DataFrame, keys: Sequence[str], html: str, forms: Sequence[Form], order: Sequence[str]) -> DataFrame:
    """One typed row per key from several forms, each note read and parsed once.

    Field names are unique over all forms. Of a ``latest`` form the newest note by ``order`` counts,
    equal ones are merged by maximum; of any other form all notes do. A key without notes of a
    form has NULL in its fields and false in its flag; a key without any is not there.
    """
    keys, order = list(keys), list(order)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    allowed = {f"_allowed_{i}": F.lit(True) if form.where is None else F.coalesce(form.where, F.lit(False)) for i, form in enumerate(forms)}
    titles = list(dict.fromkeys(form.title for form in forms))
    notes = note_fields(df.filter(present).withColumns(allowed), [*keys, *order, *allowed], html, wanted=titles)
    holds = [(F.col("form_title") == form.title) & F.col(f"_allowed_{i}") for i, form in enumerate(forms)]
    own = [F.when(held, f.of_note()).alias(f.name) for held, form in zip(holds, forms, strict=True) for f in form.fields]
    rows = notes.select(*keys, *order, *[h.alias(f"_has_{i}") for i, h in enumerate(holds)], *own)
    every = [f for form in forms for f in form.fields]
    has = [F.bool_or(f"_has_{i}").alias(f"_has_{i}") for i in range(len(forms))]
    per_note = rows.groupBy(*keys, *order).agg(*has, *[f.of_notes() for f in every])
    picked = [
        F.max_by(F.struct(*[f.name for f in form.fields]), F.when(F.col(f"_has_{i}"), F.struct(*order))).alias(f"_form_{i}")
        if form.latest
        else F.struct(*[f.of_notes() for f in form.fields]).alias(f"_form_{i}")
        for i, form in enumerate(forms)
    ]
    per_key = per_note.groupBy(*keys).agg(*has, *picked)
    typed = [F.when(F.col(f"_has_{i}"), f.typed(F.col(f"_form_{i}.{f.name}"))).alias(f.name) for i, form in enumerate(forms) for f in form.fields]
    flags = [F.col(f"_has_{i}").alias(form.flag) for i, form in enumerate(forms) if form.flag]
    held = F.exists(F.array(*[F.col(f"_has_{i}") for i in range(len(forms))]), lambda h: h)
    return per_key.filter(held).select(*keys, *flags, *typed)
