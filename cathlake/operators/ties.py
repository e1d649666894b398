"""In-group ``rank`` and ``dense_rank`` when many rows tie.

A group or a single value may hold a third of all rows, so neither is ever
gathered. Rows are first reduced to one count per distinct (group, value),
which combines on the map side. The ranks are then prefix sums over these
pairs, in two levels:

* inside a range partition of the pairs, a running sum over (partition,
  group), bounded by the partition's pairs;
* across partitions, what earlier partitions hold of a partition's first
  group, from a table with two rows per partition.

Each pair's rank goes back to the rows by a join that adaptive execution can
split (``skew.join_back``), as a value shared by many rows is a hot key there.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cathlake.operators.numbering import sorted_checkpoint
from cathlake.operators.skew import join_back

_LOCAL = (1 << 33) - 1


def prefix_sums(pairs: DataFrame, group: Sequence[str], order: Sequence, weight: str, name: str,
                parts: int | None = None) -> DataFrame:
    """``pairs`` plus ``name``: the sum of ``weight`` over the group's earlier rows in
    ``order`` (sort columns that make it total inside a group)."""
    group = list(group)
    # Rows of a group stay together in the sort, but not in one partition.
    sort = [F.col(g).asc_nulls_first() for g in group] + list(order)
    m = sorted_checkpoint(pairs, sort, parts).withColumn("_cl_mid", F.monotonically_increasing_id())
    m = m.select(*pairs.columns, F.shiftright("_cl_mid", 33).alias("_cl_pid"),
                 F.col("_cl_mid").bitwiseAND(F.lit(_LOCAL)).alias("_cl_loc"))
    inside = Window.partitionBy("_cl_pid", *group).orderBy("_cl_loc").rowsBetween(Window.unboundedPreceding, -1)

    # One row per partition: its first group, and its last group with that group's sum there.
    held = m.groupBy("_cl_pid", *group).agg(F.sum(weight).alias("_cl_t"), F.min("_cl_loc").alias("_cl_a"))
    edge = held.groupBy("_cl_pid").agg(
        F.min_by(F.struct(*group), "_cl_a").alias("_cl_first"),
        F.max_by(F.struct(*group, "_cl_t"), "_cl_a").alias("_cl_last"))
    give = edge.select(*[F.col(f"_cl_last.{g}").alias(g) for g in group], "_cl_pid", F.col("_cl_last._cl_t").alias("_cl_t"),
                       F.lit(1).alias("_cl_gives"))
    ask = edge.select(*[F.col(f"_cl_first.{g}").alias(g) for g in group], "_cl_pid", F.lit(0).cast("long").alias("_cl_t"),
                      F.lit(0).alias("_cl_gives"))
    earlier = Window.partitionBy(*group).orderBy("_cl_pid", "_cl_gives").rowsBetween(Window.unboundedPreceding, 0)
    carry = (give.unionByName(ask).withColumn("_cl_carry", F.sum("_cl_t").over(earlier))
             .where((F.col("_cl_gives") == 0) & (F.col("_cl_carry") > 0))
             .select(F.col("_cl_pid").alias("_cl_cpid"), *[F.col(g).alias(f"_cl_c_{g}") for g in group], "_cl_carry"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_cl_c_{g}")) for g in group],
                  F.col("_cl_pid") == F.col("_cl_cpid"))
    summed = m.withColumn("_cl_in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return summed.join(F.broadcast(carry), same, "left").select(
        *pairs.columns, (F.col("_cl_in") + F.coalesce("_cl_carry", F.lit(0))).alias(name))


def tie_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank", method: str = "rank",
             nulls_last: bool = True, parts: int | None = None) -> DataFrame:
    """``df`` plus ``name``: ``rank`` (ties share the lowest number) or ``dense_rank`` in
    ascending ``order``. NULL values tie with each other, and so do NULL groups."""
    if method not in ("rank", "dense_rank"):
        raise ValueError(f"unknown method {method!r}")
    group, order = list(group), list(order)
    asc = [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first() for c in order]
    pairs = df.groupBy(*group, *order).agg(F.count(F.lit(1)).alias("_cl_n"))
    if method == "dense_rank":
        pairs = pairs.withColumn("_cl_n", F.lit(1).cast("long"))
    ranks = prefix_sums(pairs, group, asc, "_cl_n", "_cl_before", parts)
    ranks = ranks.select(*group, *order, (F.col("_cl_before") + 1).alias(name))
    return join_back(df, ranks, group + order, "inner", null_safe=True).select(*df.columns, name)
