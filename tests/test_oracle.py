"""Every registered query returns what its SQL twin returns on the same tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from footfall.plans.oracle import oracle_sql
from footfall.plans.queries import queries
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 10
