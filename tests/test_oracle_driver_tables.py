"""Every registered query against its naive SQL (DuckDB) on the sf0.001 driver tables."""

import pytest

import __spark_entry__ as entry
from firmdyn.plans.queries import QUERIES
from tests.conftest import SF0001
from tests.helpers import assert_matches

NAMES = sorted(QUERIES)


def test_every_panel_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["fic_code", "borrower_sic"]
    assert df.count() == 84  # industries with an OP covariance pair 2012 -> 2013


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_sf0001, name):
    got = entry.queries()[name](spark, SF0001).toPandas()
    want = duck_sf0001.execute(entry.oracle_sql()[name]).df()
    assert_matches(got, want)
