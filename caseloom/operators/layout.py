"""Positional parsing of separated lines whose layout depends on the field count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.codes import bands
from caseloom.functions.dates import parse_date
from caseloom.operators.timeline import group_total


@dataclass(frozen=True)
class Position:
    """A field: name, 0-based place in the base layout, type.

    Types: ``string``, ``decimal`` (decimal comma), ``integer``, ``date``
    (yyyyMMdd) and ``month`` (yyyyMM, first of month).
    """

    name: str
    place: int
    type: str = "string"


def _typed(raw: Column, kind: str) -> Column:
    if kind == "decimal":
        return F.replace(raw, F.lit(","), F.lit(".")).try_cast("decimal(38,9)")
    if kind == "integer":
        return raw.try_cast("long")
    if kind == "date":
        return parse_date(raw, "yyyyMMdd")
    if kind == "month":
        return parse_date(F.concat(raw, F.lit("01")), "yyyyMMdd")
    return raw


def parse_layout(
    df: DataFrame,
    line: str,
    positions: Sequence[Position],
    inserted: Mapping[int, int],
    separator: str = ";",
) -> DataFrame:
    """Typed columns from raw lines.

    ``inserted`` maps a field count to the place from which fields sit one to the
    right, e.g. ``{35: 25}``: lines of 35 fields carry one extra field before 25.
    """
    # blank lines are dropped by the explosion: a filter on the line would be pushed
    # below the projection that makes it, and compute it twice
    fields = F.when(F.trim(line) != "", F.split(F.replace(F.col(line), F.lit('"'), F.lit("")), separator))
    rows = df.withColumn("_f", F.explode(F.filter(F.array(fields), lambda f: f.isNotNull())))
    rows = rows.withColumn("field_count", F.size("_f"))

    def raw(p: Position) -> Column:
        shift = F.lit(0)
        for count, start in inserted.items():
            if p.place >= start:
                shift = F.when(F.col("field_count") == count, 1).otherwise(shift)
        return F.trim(F.get(F.col("_f"), F.lit(p.place) + shift))

    kept = [c for c in df.columns if c != line]
    return rows.select(*kept, "field_count", *[_typed(raw(p), p.type).alias(p.name) for p in positions])


# Upper limits and labels of the family benefit bands.
FAMILY_BANDS = [(374, "ate 374"), (600, "375 a 600"), (750, "601 a 750"), (1350, "751 a 1350")]
FAMILY_ABOVE = "acima de 1350"


def family_bands(
    df: DataFrame, keys: Sequence[str], amount: str, row_id: Sequence[str], limits=None, above: str = FAMILY_ABOVE
) -> DataFrame:
    """Every benefit line with the total of its family and the band of that total."""
    total = group_total(df, keys, F.col(amount), "family_total", row_id)
    # a total that is unknown falls through every limit, as a CASE without NULL branch does
    return total.withColumn(
        "family_band", F.coalesce(bands(F.col("family_total"), limits or FAMILY_BANDS, above), F.lit(above))
    )
