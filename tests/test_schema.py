import pytest

from firmdyn.schema import PRESHOCK, TREATMENT, LongDiffSpec


def test_presets():
    assert TREATMENT.years == (2012, 2013, 2014, 2015)
    assert PRESHOCK.years == (2010, 2013, 2014)
    assert TREATMENT.label("OPcov", 2014) == "LD_OPcov_2012_2014"


@pytest.mark.parametrize("base,horizons", [(2012, ()), (2012, (2012,)), (2012, (2013, 2013))])
def test_invalid_windows(base, horizons):
    with pytest.raises(ValueError):
        LongDiffSpec(base, horizons)
