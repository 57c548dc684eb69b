"""Queries give the same result when nearly every key counts as heavy."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry
from caseloom.operators import explode, graph, skew

FOLDER = entry.SMOKE_DIR
NAMES = [
    "bridge_dedup_nested", "double_rank_dedup", "duplicate_flag", "exact_rule_dedup", "family_total_window", "fct_notes", "fct_visits",
    "fuzzy_dedup", "mart_daily_stays", "mart_visits_report", "nest_children", "star_left_join",
]


@pytest.fixture
def everything_heavy(monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 2)
    monkeypatch.setattr(explode.nest_children, "__defaults__", ("items", 2))
    monkeypatch.setattr(graph, "HEAVY_ROWS", 2)


@pytest.mark.parametrize("name", NAMES)
def test_heavy_path(spark, everything_heavy, name):
    con = oracle.connection(FOLDER)
    assert oracle.differences(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == ""
