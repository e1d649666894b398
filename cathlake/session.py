"""Session construction and cluster-wide settings.

Operators are DataFrame transformations; those that number rows, rank or link
run jobs to cut lineage while the plan is built. What a job needs from this
module is a session whose adaptive execution is
on (runtime broadcast of measured-small sides, skew-split of hot join keys,
partition coalescing) and a shared checkpoint folder for lineage cuts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Adaptive execution turns a shuffle join into a
# broadcast only after the build side has been measured (a proven size bound),
# and splits skewed join partitions; forceOptimizeSkewedJoin lets it split
# even when an aggregate above the join then needs its own (small, partially
# aggregated) exchange.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of lineage cuts are removed once no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "cathlake",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the package's settings.

    ``master`` is only set when given, so on a cluster the submitter's master
    wins. ``shuffle_partitions`` should be sized so one shuffle partition fits
    an executor core's memory at the target scale (AQE coalesces the rest).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` is used as is. Only when it is
    unset on a ``local[...]`` master (tests) is a scratch folder created and
    registered; on any other master a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="cathlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf
