"""Seeded random panels (ties, copies, repeated firm-years with different values,
missing inputs, zero and negative values, firms entering and leaving) against the
naive SQL."""

import random

import pytest

from firmdyn.plans.outcomes import prepare
from firmdyn.plans.queries import PANEL_QUERIES, present
from firmdyn.schema import PRESHOCK, TREATMENT
from tests.helpers import assert_matches, oracle_result, spark_result, to_duck, to_spark

NAMES = sorted(n for n in PANEL_QUERIES if n[-4:].isdigit() and n[:4] not in ("run_", "outc")) + [
    "survivor_pairs", "concentration_by_year", "firm_markup", "industry_share"]


def random_panel(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for country in ("RA", "RB", "RC"):
        for sic in (3711, 2510):
            for f in range(rng.randint(1, 7)):
                firm = f"{country}{sic}{f:02d}"
                for year in range(2010, 2016):
                    if rng.random() < 0.3:
                        continue  # firm absent this year

                    def value(p_null=0.1):
                        r = rng.random()
                        if r < p_null:
                            return None
                        if r < p_null + 0.05:
                            return rng.choice([0.0, -5.0])
                        return float(rng.choice([50, 100, 100, 150, 200, 400, 1000]))

                    row = (firm, sic, year, value(0.05), value(), value(), value())
                    rows.append(row)
                    if rng.random() < 0.1:
                        rows.append(row)  # exact copy
                    if rng.random() < 0.05:
                        rows.append((firm, sic, year, value(0.0), value(), value(), value()))
    return rows


@pytest.fixture(scope="module", params=[11, 23, 37])
def panel(spark, request):
    rows = random_panel(request.param)
    seen: dict = {}
    for firm, _, year, sales, *_ in rows:
        if sales is not None and sales > 0:
            seen.setdefault((firm, year), set()).add(sales)
    # the sort-based turbulence path is exercised: a firm-year with two sales values
    assert any(len(v) > 1 for v in seen.values())
    return to_spark(spark, rows), to_duck(rows)


def test_run_on_a_random_panel(panel):
    sp, con = panel
    for spec, tables in prepare(sp, [TREATMENT, PRESHOCK]).outcomes.items():
        for family, df in tables.items():
            assert_matches(present(df).toPandas(), oracle_result(con, f"run_{family}_{spec.base}"))


@pytest.mark.parametrize("name", NAMES)
def test_random_panel_matches_oracle(panel, name):
    sp, con = panel
    assert_matches(spark_result(sp, name), oracle_result(con, name))
