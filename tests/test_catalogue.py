"""Every named query against its check SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_file
import compare
import oracle
from ledgerloom.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"fraud_model_score"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_names_agree():
    assert set(QUERIES) - set(oracle.oracle_sql()) == ROWS_ONLY
    assert set(oracle.oracle_sql()) <= set(QUERIES) <= set(entry_file.queries())
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, plan_of):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    columns, rows = compare.spark_rows(df)
    if name in ROWS_ONLY:
        assert rows
        return
    expected_columns, expected = compare.duck_rows(duck, entry_file.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
