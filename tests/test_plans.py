"""Plan shape checks on the registered plans (sf0.001 tables): the flagship
uses no window and no nested loop, scans are pruned and filtered, and the
interval link and the upsert never fall back to a nested-loop join."""

import __spark_entry__ as entry

from conftest import SF_SMALL


def executed(df):
    df.count()  # run once so adaptive plans are final
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = entry.queries()["diagnostic_flag"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "NestedLoop" not in plan
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in \
        df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "NestedLoop" not in executed(df)


def test_no_nested_loops(spark):
    q = entry.queries()
    for name in ("link_window", "catalog_upsert", "anti_tuple", "anti_not_in", "runs_v1"):
        assert "NestedLoop" not in executed(q[name](spark, SF_SMALL)), name


def test_no_window_over_data_keys(spark):
    """Windows appear only over bounded groups (range partition id)."""
    q = entry.queries()
    for name in ("diagnostic_flag", "leading_runs", "runs_v1", "group_extremum", "corr_min",
                 "dedup_key", "registry_wide", "cohort_counts"):
        plan = q[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan, name
