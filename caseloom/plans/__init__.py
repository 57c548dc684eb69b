"""Queries on the supplied tables, grouped by subject."""

from caseloom.plans import (  # noqa: F401
    aggregates,
    changes,
    identity,
    ingestion,
    joins,
    marts,
    nested,
    projections,
    quality,
    text_forms,
)
from caseloom.plans.registry import ORACLES, QUERIES  # noqa: F401
