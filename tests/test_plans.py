"""Properties of the physical plans."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["jon_1", "jon_2", "jon_3", "jon_6", "jon_7", "jon_8", "mob_2", "mob_3", "mob_7", "agg_10", "agg_14", "flt_3", "flt_11", "reg_5", "set_1"])
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["win_4", "win_7"])
def test_rank_filter_runs_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, FOLDER)) and "Partial" in plan(QUERIES[name](spark, FOLDER))


def test_pushdown_and_pruning(spark):
    text = plan(QUERIES["flt_1"](spark, FOLDER))
    assert "EqualTo(event_type,click)" in text and "GreaterThan(value,20.0)" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "StringStartsWith(p_name,small)" in plan(QUERIES["flt_4"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES["flt_10"](spark, FOLDER))


@pytest.mark.parametrize("name", ["agg_1", "agg_6", "agg_13", "bin_1", "udf_2", "cls_5", "win_2", "mob_6"])
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "InPandas" not in text


def test_top_n(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["lim_1"](spark, FOLDER))


def test_the_bootstrap_query_gives_the_band_itself(spark):
    """Not only its distance in whole standard errors, and its SQL draws the replicates."""
    from punctua.plans.registry import QUERIES, SQL

    assert "quantile_cont" in SQL["agg_12"]
    row, old = (QUERIES[name](spark, "/root/testdata/sf0.001").first() for name in ("agg_12", "agg_12_poisson"))
    assert (row.mean, row.lower, row.upper) == (old.mean, old.lower, old.upper) and row.lower < row.mean < row.upper
    assert (row.lower_in_errors, row.upper_in_errors) == (-2, 2)
