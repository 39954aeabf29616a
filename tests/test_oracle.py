"""Every bound query against its SQL on the smallest tables."""

import pytest

from compare import connect, differences
from debutline.workload import all_cases

FOLDER = "/root/testdata/sf0.001"
CASES = all_cases()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [name for name, (_, sql) in CASES.items() if sql])
def test_same_rows_as_sql(spark, con, name):
    query, sql = CASES[name]
    assert differences(spark, FOLDER, query, sql, con) == []


@pytest.mark.parametrize("name", [name for name, (_, sql) in CASES.items() if not sql])
def test_runs_without_sql(spark, name):
    query, _ = CASES[name]
    df = query(spark, FOLDER)
    assert df.columns and df.count() > 0
