"""Every registered query of the library against its SQL twin."""

import pytest
import twins

from astroloom.plans import catalogue

SF = "/root/testdata/sf0.001"
ORACLES = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return twins.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    assert twins.differ(catalogue.queries()[name](spark, SF), con, ORACLES[name]) == ""


def test_entry(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.columns == ["ID", "xxx", "yyy", "tile", "x", "y", "bands", "n_bands"]
    assert out.count() == 1500
    assert set(e.oracle_sql()) <= set(e.queries())
