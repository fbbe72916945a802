"""The named queries on the smallest tables, against their SQL where there is one."""

import os

import pytest

import __spark_entry__ as entry_file
import compare
from ledgerloom.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_file.queries())
    assert set(SQL) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = compare.duck_rows(compare.connect(SF_DIR), SQL[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_covers_the_table(spark, name):
    ids = [r[0] for r in QUERIES[name](spark, SF_DIR).select("doc_id").distinct().collect()]
    assert sorted(ids) == list(range(200))
