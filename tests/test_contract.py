"""Every registered query against its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from lectern.checks import basics, layers
from parity import compare, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


OWN = [*basics.QUERIES, *layers.QUERIES]


def test_every_query_has_sql():
    assert set(OWN) == {*basics.SQL, *layers.SQL}
    assert set(OWN) <= set(contract.queries()) and set(OWN) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_parity(spark, con, name):
    problem, _, _ = compare(spark, con, SF, name)
    assert problem == ""
