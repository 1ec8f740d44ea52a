"""Every query against its SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(name, spark, sf, duck):
    assert difference(contract.queries()[name](spark, sf), duck, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_without_sql(name, spark, sf):
    assert contract.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
