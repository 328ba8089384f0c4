"""Invariants of the statistics on the sf0.001 derived panel."""

import math

from pyspark.sql import functions as F

from firmdyn import operators as O
from firmdyn.schema import CELL_YEAR, TREATMENT


def test_shares_sum_to_one(sf0001_panel):
    for df in (O.firm_markup(sf0001_panel), O.industry_share(sf0001_panel.where("sales > 0"))):
        sums = df.groupBy(*CELL_YEAR).agg(F.sum("share").alias("s")).collect()
        assert sums and all(math.isclose(r.s, 1.0, rel_tol=1e-12) for r in sums)


def test_within_plus_between_is_change_of_weighted_markup(sf0001_panel):
    fm = O.firm_markup(sf0001_panel)
    b = fm.where("year = 2012").select("bvd_id", "_country_", "sic",
                                       F.col("share").alias("s0"), F.col("markup").alias("m0"))
    h = fm.where("year = 2013").select("bvd_id", "_country_", "sic",
                                       F.col("share").alias("s1"), F.col("markup").alias("m1"))
    change = {(r._country_, r.sic): r.d for r in
              b.join(h, ["bvd_id", "_country_", "sic"]).groupBy("_country_", "sic")
               .agg(F.sum(F.col("s1") * F.col("m1") - F.col("s0") * F.col("m0")).alias("d"))
               .collect()}
    dec = O.markup_decomposition(O.markup_sample(sf0001_panel), TREATMENT).collect()
    assert len(dec) == len(change) == 80
    for r in dec:
        total = r.LD_Within_2012_2013 + r.LD_Between_2012_2013
        assert math.isclose(total, change[(r.fic_code, r.borrower_sic)], abs_tol=1e-12)


def test_cr4_bounds(sf0001_panel):
    rows = O.concentration_by_year(sf0001_panel).collect()
    assert rows
    for r in rows:
        assert 0 < r.cr4 <= 1 + 1e-12
        if r.n_firms <= 4:
            assert math.isclose(r.cr4, 1.0)


def test_turbulence_bounds(sf0001_panel):
    for r in O.turbulence(sf0001_panel, TREATMENT).collect():
        for h in TREATMENT.horizons:
            v = r[f"LD_turbulence_2012_{h}"]
            assert v is None or -1e-12 <= v <= 2 + 1e-12


def test_sigma_null_iff_fewer_than_two_values(sf0001_panel):
    lr = O.log_ratios(sf0001_panel)
    n = {tuple(r[:3]): r.n for r in
         lr.groupBy(*CELL_YEAR).agg(F.count("log_mrpl").alias("n")).collect()}
    for r in O.dispersion_by_year(sf0001_panel).collect():
        assert (r.sigma_mrpl is None) == (n[tuple(r[:3])] < 2)


def test_opcov_level_is_positive_on_average(spark):
    from firmdyn.sources import derived_panel, prepare_panel
    from tests.conftest import SF001

    panel = prepare_panel(derived_panel(spark, SF001))
    mean = O.opcov_by_year(panel).agg(F.mean("opcov")).first()[0]
    assert 0.0 < mean < 0.2
