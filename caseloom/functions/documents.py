"""Eleven-digit person numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions.text import digits_key

WIDTH = 11


def doc_digits(col: Column) -> Column:
    """Digits padded to full width; longer values are left alone, empty stays empty."""
    digits = digits_key(col)
    return F.when(F.length(digits).between(1, WIDTH), F.lpad(digits, WIDTH, "0")).otherwise(digits)


def doc_status(col: Column) -> Column:
    """``ok``, ``empty`` or ``invalid``, judged before any padding cuts digits off."""
    size = F.length(digits_key(col))
    return F.when(size == 0, "empty").when(size <= WIDTH, "ok").otherwise("invalid")


def doc_format(col: Column) -> Column:
    """``000.000.000-00`` when the status is ok, else NULL."""
    d = doc_digits(col)
    dotted = F.format_string(
        "%s.%s.%s-%s", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 3), F.substring(d, 10, 2)
    )
    return F.when(doc_status(col) == "ok", dotted)
