"""Every registered query against its SQL twin, on the smallest data."""

import compare
import pytest
from conftest import SF

from skyledger import oracle, registry

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return compare.connection(SF)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.statements())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, con, name):
    df = registry.queries()[name](spark, SF)
    assert compare.differences(df, con, oracle.statements()[name]) == ""


def test_compare_notices_a_difference(spark, con):
    df = registry.queries()["year_partitions"](spark, SF)
    changed = oracle.statements()["year_partitions"].replace("count(*)", "count(*) + 1")
    assert compare.differences(df, con, changed) != ""
