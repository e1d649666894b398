"""Connected components of an undirected graph given as edges.

Alternating large-star and small-star steps: each connects a node's
neighbours to the smallest node it sees, so the graph shrinks to stars in a
logarithmic number of rounds. Every step is an aggregate (combined on the map
side, so a hub costs one row per task) and an equality join; edges are written
between steps, and only two totals per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.operators.skew import join_back

from .common import materialize


def _connect(directed: DataFrame, larger_only: bool) -> DataFrame:
    """Neighbours of every u (with u itself) joined to the smallest of them."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = join_back(directed, least, ["u"])  # a hub is split by its size
    if larger_only:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return materialize(out.where(F.col("u") != F.col("v")).distinct(), "edges")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node with an edge to another; comp is its smallest node."""
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "edges")

    def state(x):
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(e)
    while now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = _connect(both, True)    # large star: larger neighbours to the minimum
        e = _connect(e, False)      # small star: u and its smaller neighbours to the minimum
        before, now = now, state(e)
        if before == now:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
