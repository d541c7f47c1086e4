"""Every query with a SQL twin against DuckDB on the smallest given tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"

if not os.path.isdir(SF):
    pytest.skip("the given tables are not here", allow_module_level=True)

from compare import compare, database  # noqa: E402

import __spark_entry__ as contract  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, con, name):
    ok, message, _ = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert ok and "TYPES" not in message, message


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["cohort", "patient_id"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
