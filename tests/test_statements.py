"""Every query with a statement gives the statement's whole result."""

import pytest

import __spark_entry__ as contract
from tools.compare import connect, difference, duck_rows, spark_rows

STATEMENTS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(spark, small, duck, name):
    ours = spark_rows(contract.queries()[name](spark, small))
    assert difference(ours, duck_rows(duck, STATEMENTS[name])) is None


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "type_name", "machine_count", "failures", "failure_rate_pct", "pct_of_all_failures"]
