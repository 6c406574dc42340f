"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
SLOW = {"clu_2", "clu_3", "cls_3", "reg_3"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    problem, _ = difference(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_type", "week", "next_day_increase", "rank"]
