"""Hot groups and copies: one industry repeated as exact copies (a hot cell whose firm
keys all have copies) and one firm with many distinct values per year (the sort-based
turbulence path). Every statistic must still equal the naive SQL, whose joins really
do emit every pair."""

import duckdb
import pytest
from pyspark.sql import functions as F

from firmdyn.plans import naive_sql
from firmdyn.plans.outcomes import FAMILIES, prepare
from firmdyn.plans.queries import PANEL_QUERIES, present
from firmdyn.schema import PRESHOCK, TREATMENT
from firmdyn.sources import derived_panel, prepare_panel
from tests.conftest import SF0001
from tests.helpers import assert_matches

COPIES = 12
CHECKED = sorted(n for n in PANEL_QUERIES if n[-4:].isdigit()) + [
    "survivor_pairs", "concentration_by_year", "n_firms_by_year", "firm_markup"]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    raw = derived_panel(spark, SF0001)
    keys = prepare_panel(raw).groupBy("_country_", "sic").count().orderBy(F.desc("count"))
    country, sic = keys.first()[:2]
    hot = raw.where((F.substring("bvd_id", 1, 2) == country)
                    & (F.substring(F.col("sic").cast("string"), 1, 2) == sic))
    copies = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(COPIES - 1))).alias("_k")).drop("_k")
    firm = raw.orderBy("bvd_id", "year").first().bvd_id
    noisy = (raw.where(F.col("bvd_id") == firm)
                .select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("_k"))
                .withColumn("sales", F.col("sales") * (1 + F.col("_k") / 10)).drop("_k"))
    path = str(tmp_path_factory.mktemp("skewed") / "panel")
    raw.unionByName(copies.select(raw.columns)).unionByName(noisy).write.parquet(path)
    con = duckdb.connect()
    sql = naive_sql.queries(f"select * from read_parquet('{path}/*.parquet')", dialect="duckdb")
    return prepare_panel(spark.read.parquet(path)), con, sql


@pytest.mark.parametrize("name", CHECKED)
def test_skewed_panel_matches_oracle(skewed, name):
    panel, con, sql = skewed
    assert_matches(present(PANEL_QUERIES[name](panel)).toPandas(), con.execute(sql[name]).df())


def test_runner_on_skewed_panel(skewed):
    panel, con, sql = skewed
    shared = prepare(panel, [TREATMENT, PRESHOCK])
    for spec in (TREATMENT, PRESHOCK):
        for family in FAMILIES:
            name = f"{family}_{spec.base}"
            assert_matches(present(shared.outcomes[spec][family]).toPandas(),
                           con.execute(sql[name]).df())
