"""Every registered query gives the rows of its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_registered import compare, oracle


@pytest.fixture(scope="module")
def con(sf_small):
    return oracle(sf_small)


@pytest.fixture(scope="module")
def sf_small():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, sf_small, name):
    assert compare(spark, con, name, sf_small) == ""
