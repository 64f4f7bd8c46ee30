"""Every registered query against its SQL twin, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from check_oracles import compare, connect
from tideline.plans.oracles import ORACLES
from tideline.plans.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    fn, sql = driver.queries()[name], driver.oracle_sql()[name]
    assert compare(spark, duck, name, fn, sql, SF_DIR) is None
