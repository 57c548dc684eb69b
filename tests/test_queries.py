"""Every registered query against its SQL on the smallest supplied tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry
from caseloom.plans import ORACLES, QUERIES

FOLDER = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return oracle.connection(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert oracle.differences(spark, con, QUERIES[name], ORACLES[name], FOLDER) == ""
