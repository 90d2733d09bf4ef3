"""Queries of this subpackage against their SQL."""

import pytest

import check
from moorage.llm.registered import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    path = "/root/testdata/sf0.001"
    verdict, _ = check.compare(spark, check.connect(path), path, name)
    assert verdict.startswith("ok ("), verdict


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)
