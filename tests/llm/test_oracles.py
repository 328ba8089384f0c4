"""The queries that have SQL against DuckDB, and the registration."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from firmdyn.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001
from tests.helpers import assert_matches


def test_registered():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck_sf0001, name):
    got = entry.queries()[name](spark, SF0001).toPandas()
    assert_matches(got, duck_sf0001.execute(entry.oracle_sql()[name]).df())
