"""Every statistic on the hand-written edge panels against the naive SQL (DuckDB)."""

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType

from firmdyn.plans.outcomes import prepare
from firmdyn.plans.queries import PANEL_QUERIES, present
from firmdyn.schema import PRESHOCK, TREATMENT
from tests import micro_panels as M
from tests.helpers import assert_matches, oracle_result, spark_result, to_duck, to_spark


@pytest.fixture(scope="module")
def edge(spark):
    return to_spark(spark, M.EDGE_PANEL), to_duck(M.EDGE_PANEL)


@pytest.fixture(scope="module")
def no_survivor(spark):
    return to_spark(spark, M.NO_SURVIVOR_2013), to_duck(M.NO_SURVIVOR_2013)


@pytest.mark.parametrize("name", sorted(n for n in PANEL_QUERIES if not n.startswith("run_")))
def test_edge_panel(edge, name):
    panel, con = edge
    assert_matches(spark_result(panel, name), oracle_result(con, name))


def test_run_on_the_edge_panel(edge):
    panel, con = edge
    outcomes = prepare(panel, [TREATMENT, PRESHOCK]).outcomes
    for spec, tables in outcomes.items():
        for family, df in tables.items():
            assert_matches(present(df).toPandas(), oracle_result(con, f"run_{family}_{spec.base}"))


@pytest.mark.parametrize("name", ["markup_decomp_2012", "markup_decomp_2010", "turbulence_2012",
                                  "concentration_2012", "op_covariance_2012", "survivor_pairs",
                                  "within_check"])
def test_no_survivor_at_first_horizon(no_survivor, name):
    panel, con = no_survivor
    assert_matches(spark_result(panel, name), oracle_result(con, name))


@pytest.mark.parametrize("rows,sic_type", [(M.SIC_INT, IntegerType()),
                                           (M.SIC_DOUBLE, DoubleType()),
                                           (M.SIC_STRING, StringType())])
def test_industry_code_types(spark, rows, sic_type):
    panel = to_spark(spark, rows, sic_type)
    con = to_duck(rows, sic_type)
    got = spark_result(panel, "firm_panel")
    assert_matches(got, oracle_result(con, "firm_panel"))
    assert sorted(got["sic"]) == ["11", "37"]
