"""Code to label mapping with the domain held as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP = object()  # default that returns the code itself


@dataclass(frozen=True)
class Domain:
    """Labels by code. ``match`` is ``exact``, ``prefix`` or ``contains``."""

    labels: Mapping[Any, str] = field(default_factory=dict)
    default: Any = None
    match: str = "exact"
    null_label: str | None = None


def map_domain(col: Column, domain: Domain) -> Column:
    """First matching label, else the default; NULL codes take ``null_label``."""
    result = F.when(col.isNull(), F.lit(domain.null_label))
    for code, label in domain.labels.items():
        if domain.match == "prefix":
            test = col.startswith(code)
        elif domain.match == "contains":
            test = col.contains(code)
        else:
            test = col == F.lit(code)
        result = result.when(test, F.lit(label))
    if domain.default is KEEP:
        return result.otherwise(col)
    return result.otherwise(F.lit(domain.default))


def map_list(col: Column, domain: Domain, separator: str = ",") -> Column:
    """Re-label a separated list token by token and join it again."""
    tokens = F.transform(F.split(col, separator), lambda t: map_domain(F.trim(t), domain))
    return F.array_join(tokens, separator)


def bands(col: Column, limits: list[tuple[float, str]], above: str, missing: str | None = None) -> Column:
    """Label of the first upper limit (inclusive) that holds."""
    result = F.when(col.isNull(), F.lit(missing))
    for limit, label in limits:
        result = result.when(col <= F.lit(limit), F.lit(label))
    return result.otherwise(F.lit(above))


def flag_label(flags: list[Column], labels: Mapping[tuple[bool, ...], str], default: str) -> Column:
    """Label for a combination of boolean columns."""
    result = F.when(F.lit(False), F.lit(default))
    for combination, label in labels.items():
        test = F.lit(True)
        for flag, wanted in zip(flags, combination, strict=True):
            test = test & (flag == F.lit(wanted))
        result = result.when(test, F.lit(label))
    return result.otherwise(F.lit(default))


def yes_no(test: Column, yes: str = "Sim", no: str = "Não") -> Column:
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))
