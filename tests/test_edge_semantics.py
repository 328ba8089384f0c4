"""The edge-case rules, checked directly on the micro panels."""

import math

import pytest

from firmdyn import operators as O
from firmdyn.schema import PRESHOCK, TREATMENT
from tests import micro_panels as M
from tests.helpers import to_spark


@pytest.fixture(scope="module")
def edge(spark):
    return to_spark(spark, M.EDGE_PANEL)


def rows_of(df, country):
    return [r.asDict() for r in df.where(df.fic_code == country).collect()]


def test_missing_first_horizon_drops_the_industry(edge):
    for df in (O.op_covariance(edge), O.dispersion(edge), O.concentration(edge),
               O.markup_decomposition(O.markup_sample(edge)), O.turbulence(edge)):
        assert rows_of(df, "AA") == []


def test_double_anchor_turbulence(edge):
    (row,) = rows_of(O.concentration(edge), "AB")
    assert row["LD_CR4_2012_2013"] is not None
    assert all(row[f"LD_turbulence_2012_{h}"] is None for h in TREATMENT.horizons)


def test_moving_anchor_skips_empty_horizon(spark):
    panel = to_spark(spark, M.NO_SURVIVOR_2013)
    out = O.markup_decomposition(O.markup_sample(panel)).collect()
    assert [(r.fic_code, r.borrower_sic) for r in out] == [("BA", "37")]
    (r,) = out
    assert r.LD_Within_2012_2013 is None and r.LD_Within_2012_2014 is not None
    # the other families do not move: an empty first horizon empties them
    assert O.turbulence(panel).count() == 0


def test_trim_is_inclusive_and_before_share(edge):
    fm = O.firm_markup(edge).where("_country_ = 'AD' and year = 2012").collect()
    kept = {r.bvd_id: r for r in fm}
    assert set(kept) == {"AD01", "AD02", "AD05"}
    assert kept["AD01"].markup == 0.5 and kept["AD02"].markup == 10.0
    assert math.isclose(sum(r.share for r in fm), 1.0)
    assert math.isclose(kept["AD02"].share, 1000.0 / 1350.0)


def test_null_keys_keep_their_own_cell(edge):
    fm = O.firm_markup(edge).where("bvd_id is null or sic is null").collect()
    by_year = {}
    for r in fm:
        by_year.setdefault((r.bvd_id, r.sic, r.year), []).append(r.share)
    assert sorted(by_year[(None, "37", 2012)]) == [0.25, 0.75]
    assert by_year[("AE09", None, 2012)] == [1.0]
    for df in (O.op_covariance(edge), O.concentration(edge, PRESHOCK)):
        assert df.where("fic_code is null or borrower_sic is null").count() == 0


def test_zero_divisors_do_not_raise(edge):
    disp = O.dispersion_by_year(edge).where("_country_ = 'AE' and sic = '36' and year = 2012").first()
    # AE01 has zero employees, assets and cost: only two firms enter each sigma
    assert disp.sigma_mrpl is not None and disp.sigma_mrpk is not None
    assert O.firm_markup(edge).where("bvd_id = 'AE01'").count() == 0


def test_switching_firm_is_not_a_survivor(edge):
    pairs = O.survivor_pairs(edge.where("sales > 0"), TREATMENT).where("_country_ = 'AF'")
    got = {(r.sic, r.horizon): r.n_pairs for r in pairs.collect()}
    assert got == {("37", 2013): 1, ("25", 2013): 1}


def test_negative_and_zero_sales_are_dropped(edge):
    nf = O.n_firms_by_year(edge).where("_country_ = 'AG'").collect()
    assert {r.year: r.n_firms for r in nf} == {2012: 2, 2013: 2}


def test_single_firm_cell(edge):
    (oc,) = rows_of(O.op_covariance(edge), "AH")
    assert oc["LD_OPcov_2012_2013"] == 0.0
    (dp,) = rows_of(O.dispersion(edge), "AH")
    assert dp["LD_sigma_MRPL_2012_2013"] is None
    (cc,) = rows_of(O.concentration(edge), "AH")
    assert cc["LD_CR4_2012_2013"] == 0.0 and cc["LD_turbulence_2012_2013"] == 0.0


def test_duplicates_fan_out_but_count_once(edge):
    nf = {r.year: r.n_firms for r in
          O.n_firms_by_year(edge).where("_country_ = 'AI'").collect()}
    assert nf[2012] == 3
    pairs = O.survivor_pairs(edge.where("sales > 0"), TREATMENT).where("_country_ = 'AI'")
    got = {r.horizon: (r.n_pairs, r.n_firms) for r in pairs.collect()}
    # AI01: 2 x 1, AI02: 2 x 2, AI03: 1 x 1
    assert got[2013] == (7, 3)


def test_ties_do_not_change_cr4(edge):
    cr = {r.year: r.cr4 for r in O.cr4_by_year(edge).where("_country_ = 'AJ'").collect()}
    assert math.isclose(cr[2012], 800.0 / 1000.0)
    assert math.isclose(cr[2013], 700.0 / 900.0)


def test_diagnostics_of_an_empty_outcome(spark):
    from firmdyn.plans import naive_sql
    from tests.helpers import assert_matches, to_duck
    from firmdyn.plans.queries import present

    panel = to_spark(spark, M.NO_SURVIVOR_2013)
    turb = O.turbulence(panel)
    assert turb.count() == 0
    rows = O.outcome_summary(turb).collect()
    # every column has a row, the two keys too
    assert sorted((r.metric, r["count"], r.null_count, r.min_key) for r in rows) == sorted(
        (c, 0, 0, None) for c in turb.columns)
    assert len(rows) == len(TREATMENT.horizons) + 2
    cov = O.country_coverage({"turbulence": turb}).first()
    assert cov.n_countries == 0 and cov.countries is None
    con = to_duck(M.NO_SURVIVOR_2013)
    sql = naive_sql.queries("select * from micro")
    for name in ("outcome_summary", "country_coverage", "opcov_sign_check"):
        from firmdyn.plans.queries import PANEL_QUERIES
        assert_matches(present(PANEL_QUERIES[name](panel)).toPandas(), con.execute(sql[name]).df())
