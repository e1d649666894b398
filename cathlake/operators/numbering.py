"""Row numbering and de-duplication without an un-partitioned window.

* ``dense_ids``: consecutive ids in a total order. The frame is range
  partitioned and sorted on the order (so a hot value range is split over
  many tasks), cut from its lineage with ``checkpoint()`` into the shared
  checkpoint folder (so a lost executor recomputes the same partitions), and
  each row's id is its in-partition position plus the row count of all
  earlier partitions. The only table that is broadcast is that per-partition
  count table, whose size is the partition count.
* ``group_rank``: ``row_number`` inside groups from the same global positions:
  a row's number is its position minus the position of its group's first row.
  Minima come from windows over (range partition, group), bounded by the
  partition size; a group that started in an earlier partition (only a
  partition's first group can) takes its first position from a table with at
  most one row per partition. Rows are shuffled for the range sort and for
  those windows. ``rank`` and ``dense_rank`` number the distinct (group,
  value) pairs (``ties``), so that rows that tie are never gathered either.
* ``keep_first`` / ``pick_min``: subset de-dup keeping the first row in an
  explicit order, as a ``min(struct(order, payload))`` aggregate that combines
  map-side before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cathlake.functions.ordering import to_col

_MASK = (1 << 33) - 1


def _heavy(df: DataFrame) -> bool:
    """True when the frame's plan shuffles (joins / aggregates / windows)."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(t in plan for t in ("Join", "Aggregate", "Window"))


def sorted_checkpoint(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """``df`` range partitioned and sorted on ``order``, written to the shared
    checkpoint folder (stable partitions for the consumers that follow).

    Range partitioning runs its input twice (a sampling job for the bounds,
    then the shuffle); an input that itself shuffles is cached for those two
    runs and released once the checkpoint is written.
    """
    spark = df.sparkSession
    from cathlake.session import checkpoint_dir
    checkpoint_dir(spark)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cached = not df.is_cached and _heavy(df)  # never release a cache the caller made
    if cached:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    finally:
        if cached:
            df.unpersist()


def global_positions(df: DataFrame, order: Sequence, name: str = "_cl_pos",
                     parts: int | None = None) -> DataFrame:
    """``df`` plus ``name``: 0-based position in ``order`` (ties broken by
    storage order; give a total order for reproducible positions)."""
    order = [to_col(c) for c in order]
    s = sorted_checkpoint(df, order, parts)
    m = s.withColumn("_cl_mid", F.monotonically_increasing_id())
    m = m.withColumn("_cl_pid", F.shiftright(F.col("_cl_mid"), 33)) \
         .withColumn("_cl_loc", F.col("_cl_mid").bitwiseAND(F.lit(_MASK)))
    # One row per partition: the prefix sum over them is bounded by the
    # partition count, so a single-task window and a broadcast are safe here.
    counts = m.groupBy("_cl_pid").agg(F.count("*").alias("_cl_cnt"))
    offs = counts.select(
        "_cl_pid",
        (F.sum("_cl_cnt").over(Window.orderBy("_cl_pid")
                               .rowsBetween(Window.unboundedPreceding, -1))).alias("_cl_off"))
    out = m.join(F.broadcast(offs), "_cl_pid")
    out = out.withColumn(name, F.coalesce(F.col("_cl_off"), F.lit(0)) + F.col("_cl_loc"))
    return out.drop("_cl_mid", "_cl_pid", "_cl_loc", "_cl_off")


def dense_ids(df: DataFrame, order: Sequence, name: str = "rowid", start=0,
              parts: int | None = None) -> DataFrame:
    """Consecutive ``long`` ids from ``start`` in ``order``.

    ``start`` is an int, a scalar Column, or a one-row, one-column DataFrame
    (e.g. the current ``max(rowid) + 1`` of a table), used as a scalar
    subquery.
    """
    pos = global_positions(df, order, "_cl_pos", parts)
    if isinstance(start, DataFrame):
        start = start.select(F.col(start.columns[0]).cast("long")).scalar()
    elif not isinstance(start, Column):
        start = F.lit(int(start))
    return pos.withColumn(name, start.cast("long") + F.col("_cl_pos")).drop("_cl_pos")


def work_batches(df: DataFrame, order: Sequence, k: int, name: str = "batch") -> DataFrame:
    """``df`` plus its position ``idx`` in ``order`` and the work batch it falls
    in: ``k`` batches of ceil(n / k) consecutive rows (the last may be short)."""
    size = df.agg(F.ceil(F.count("*") / F.lit(k))).scalar()
    return dense_ids(df, order, "idx").withColumn(name, F.floor(F.col("idx") / size).cast("long"))


def group_rank(df: DataFrame, group: Sequence[str], order: Sequence[str],
               name: str = "rank", method: str = "rank", nulls_last: bool = True,
               tiebreak: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Per-group ``rank`` (ties share the lowest number), ``dense_rank`` or
    ``row_number`` in ascending ``order``; NULLs sort last by default (the
    PostgreSQL default). ``row_number`` is reproducible only when
    ``tiebreak`` makes the order total.
    """
    group, order = list(group), list(order)
    if not group:  # one global group
        out = group_rank(df.withColumn("_cl_g", F.lit(0)), ["_cl_g"], order, name, method,
                         nulls_last, tiebreak, parts)
        return out.drop("_cl_g")

    def asc(c):
        return F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first()

    gsort = [F.col(g).asc_nulls_first() for g in group]
    if method != "row_number":
        from cathlake.operators.ties import tie_rank
        return tie_rank(df, group, order, name, method, nulls_last, parts)
    # row_number: positions over the rows, then per-partition windows.
    sort = gsort + [asc(c) for c in order] + [asc(c) for c in tiebreak]
    s = sorted_checkpoint(df, [to_col(c) for c in sort], parts)
    m = (s.withColumn("_cl_mid", F.monotonically_increasing_id())
          .withColumn("_cl_pid", F.shiftright(F.col("_cl_mid"), 33))
          .withColumn("_cl_loc", F.col("_cl_mid").bitwiseAND(F.lit(_MASK))))
    counts = m.groupBy("_cl_pid").agg(F.count("*").alias("_cl_cnt"))
    offs = counts.select("_cl_pid", F.coalesce(F.sum("_cl_cnt").over(
        Window.orderBy("_cl_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_cl_off"))
    m = m.join(F.broadcast(offs), "_cl_pid").withColumn("_cl_pos", F.col("_cl_off") + F.col("_cl_loc"))
    # A group continued from earlier partitions can only be a partition's
    # first group. Its global first position comes from tables with at most
    # one row per partition (hash aggregates and broadcast lookups only).
    firsts = m.groupBy("_cl_pid").agg(F.min("_cl_pos").alias("_cl_fp")) \
              .withColumnRenamed("_cl_pid", "_cl_fpid")
    fgroups = m.join(F.broadcast(firsts), (F.col("_cl_pid") == F.col("_cl_fpid"))
                     & (F.col("_cl_pos") == F.col("_cl_fp"))).select("_cl_pid", *group)
    gkeys = fgroups.select(*group).distinct()
    gcond = [F.col(g).eqNullSafe(F.col(f"_cl_k_{g}")) for g in group]
    gfirst = (m.select(*group, "_cl_pos")
              .join(F.broadcast(gkeys.select(*[F.col(g).alias(f"_cl_k_{g}") for g in group])),
                    gcond, "left_semi")
              .groupBy(*group).agg(F.min("_cl_pos").alias("_cl_gf")))
    carry = fgroups.join(gfirst.select(*[F.col(g).alias(f"_cl_k_{g}") for g in group], "_cl_gf"),
                         gcond).select("_cl_pid", *[F.col(g).alias(f"_cl_c_{g}") for g in group], "_cl_gf")
    ccond = (F.col("_cl_pid") == F.col("_cl_cpid")) & reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_cl_c_{g}")) for g in group])
    x = m.join(F.broadcast(carry.withColumnRenamed("_cl_pid", "_cl_cpid")), ccond, "left")
    wg = Window.partitionBy("_cl_pid", *group)
    gstart = F.coalesce(F.col("_cl_gf"), F.min("_cl_pos").over(wg))
    out = x.withColumn(name, F.col("_cl_pos") - gstart + 1)
    return out.select(*df.columns, name)


def unique_rows(df: DataFrame, keys: Sequence[str], what: str = "key") -> DataFrame:
    """``df`` as it is, if ``keys`` is a key of it; else the query fails and names a repeated
    value. The check is part of the plan: one aggregate on the key, as ``keep_first``."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    held = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cl_n"), F.min(F.struct(F.lit(0).alias("_cl_z"), *[F.col(c) for c in rest])).alias("_cl_r"))
    told = F.concat(F.lit(f"repeated {what}: "), F.to_json(F.struct(*keys)))
    checked = F.when(F.col("_cl_n") > 1, F.raise_error(told).cast(held.schema["_cl_r"].dataType)).otherwise(F.col("_cl_r"))
    # The smallest column of the row goes through the check even if no other column is asked for.
    out = held.select(*[F.col(k).alias(k) for k in keys], checked.alias("_cl_r")).where(F.col("_cl_r._cl_z") == 0)
    return out.select(*[F.col(c) if c in keys else F.col(f"_cl_r.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys`` value: the first in ascending ``order`` (NULLs
    first). Rows equal in every order column are interchangeable only if the
    order covers all columns; otherwise the smallest remaining columns win."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_cl_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    carried = [(c, f"_cl_o{i}") for i, c in enumerate(order) if c not in keys]
    return (df.groupBy(*keys).agg(F.min(packed).alias("_cl_first"))
            .select(*keys, *[F.col(f"_cl_first.{f}").alias(c) for c, f in carried],
                    *[F.col(f"_cl_first.{c}").alias(c) for c in rest])
            .select(*df.columns))


def pick_min(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             payload: Sequence[str]) -> DataFrame:
    """Per ``keys``, the ``payload`` of the row with the smallest ``order``
    tuple (``DISTINCT ON`` with an explicit ORDER BY)."""
    packed = F.struct(*[o.alias(f"_cl_k{i}") for i, o in enumerate(order)],
                      *[F.col(c) for c in payload])
    return (df.groupBy(*keys).agg(F.min(packed).alias("_cl_first"))
            .select(*keys, *[F.col(f"_cl_first.{c}").alias(c) for c in payload]))
