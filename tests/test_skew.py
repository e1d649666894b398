"""A study holding about a third of all rows is split over several tasks by
adaptive execution, and every operator that joins per-key results back gives the same
answer with and without the split."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from cathlake.operators import episodes, skew
from conftest import SF_CHECK

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_catalog(spark):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    hot = F.when(F.col("l_partkey") < 700, F.lit(0)).otherwise(F.col("l_orderkey"))
    return li.select(hot.alias("study"), "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus")


def flags(spark):
    label = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "N", 0).otherwise(2)
    out = episodes.flag_diagnostic(hot_catalog(spark), entry="study", ts="l_shipdate", label=label,
                                   where=F.col("l_linestatus") == "F")
    return sorted((r.study, r.l_linenumber, str(r.l_shipdate), r.l_returnflag, r.l_linestatus,
                   r.diagnostic_data) for r in out.collect())


SPLIT = {**NO_BROADCAST, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
         "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


def test_hot_study_is_split_and_results_agree(spark):
    cat = hot_catalog(spark).repartition(6)  # a partition is split between map tasks
    stats = cat.groupBy("study").agg(F.max("l_linenumber").alias("top"))

    def run():
        df = skew.join_back(cat, stats, ["study"])
        rows = sorted(map(str, df.collect()))
        return rows, df._jdf.queryExecution().executedPlan().toString()

    split, plan = with_conf(spark, SPLIT, run)
    whole, _ = with_conf(spark, NO_BROADCAST, run)
    assert split == whole and "skew=true" in plan and "rand(" not in plan
    plain = with_conf(spark, NO_BROADCAST, lambda: flags(spark))
    assert with_conf(spark, SPLIT, lambda: flags(spark)) == plain
    assert sum(1 for r in plain if r[0] == 0) > len(plain) / 4


def test_null_keys_take_the_same_join(spark):
    rows = spark.createDataFrame([(None, 1), (1, 2), (2, 3), (None, 4)], "k int, v int")
    stats = spark.createDataFrame([(1, "a"), (None, "n")], "k int, s string")

    def got(how, **kw):
        return sorted(map(tuple, skew.join_back(rows, stats, ["k"], how, **kw).collect()), key=str)

    assert got("left") == sorted([(None, 1, None), (1, 2, "a"), (2, 3, None), (None, 4, None)], key=str)
    assert got("left", null_safe=True) == sorted([(None, 1, "n"), (1, 2, "a"), (2, 3, None), (None, 4, "n")], key=str)
    assert got("left_anti") == sorted([(None, 1), (2, 3), (None, 4)], key=str)
    assert got("left_semi") == [(1, 2)] and got("inner") == [(1, 2, "a")]


def test_split_plans_agree_on_driver_tables(spark):
    """Plans over the driver tables give identical rows when hot partitions are split."""
    q = entry.queries()
    names = ["runs_v1", "group_extremum", "corr_min", "anti_tuple", "semi_in", "link_window", "label_merge",
             "registry_sub_entry"]

    def collect(name):
        return sorted(map(tuple, q[name](spark, SF_CHECK).collect()), key=repr)

    for name in names:
        assert with_conf(spark, SPLIT, lambda: collect(name)) == with_conf(spark, NO_BROADCAST, lambda: collect(name)), name
