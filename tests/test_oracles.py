"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check
from moorage.plans.registered import ORACLES, QUERIES

SF = os.environ.get("MOORAGE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    verdict, _ = check.compare(spark, con, SF, name)
    assert verdict.startswith(("ok (", "rows only")), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
