"""Every registered query beside its SQL twin."""

import pytest

import __spark_entry__ as contract
from prepkit.verification.registry import ORACLES, QUERIES
from tools.compare import compare, open_oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    assert compare(spark, oracle, name, SF_DIR).startswith("ok")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
