"""Interval linkage of images to procedures (same patient, |dt| <= 6 h).

The original is a left join on patient with a BETWEEN on time followed by
``DISTINCT ON`` the image, whose survivor is unspecified. Here the survivor
is fixed: smallest |dt|, then the earlier procedure, then the smaller
procedure id. That survivor is always the image's nearest procedure at or
before it (predecessor) or after it (successor), so no candidate pairs are
needed at all (``link_window``, the default):

1. procedures are reduced to one row per (patient, time) with the smallest
   id (a map-side combined aggregate);
2. images and procedures are unioned (narrow: key, time, side, ids), range
   partitioned and sorted on (patient, time, side, image id), so a heavy
   patient is spread over many partitions, and checkpointed to the shared
   folder so partition ids are stable;
3. predecessor / successor come from running ``last`` / ``first`` windows
   over (range partition, patient): each window group is bounded by the
   partition size, never by the patient;
4. a patient continued from an earlier (later) partition takes the last
   (first) procedure of those partitions from a carry table with at most
   one row per partition (broadcast, bounded by the partition count);
5. the nearer of the two within the window wins, and images and procedure
   payload are joined back on their ids (a procedure picked by many images
   is split like any hot key).

``link_window_pairs`` is the direct form (equi-join on patient and a time
bucket of the window width, exact bound check, ``min(struct)`` pick); it
emits every pair within the window and is kept as a cross-check.

Images without a match (or with a NULL time / patient) keep NULLs on the
right, as in a left join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cathlake.functions.ordering import micros
from cathlake.operators.numbering import keep_first, sorted_checkpoint
from cathlake.operators.skew import join_back



def _micros(df: DataFrame, c: str):
    return micros(df, c)


def link_window_pairs(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                lts: str, rts: str, rid: str, lid: Sequence[str],
                hours: float = 6.0, rcols: Sequence[str] | None = None,
                prefix: str = "pats_") -> DataFrame:
    """One row per ``lid`` value of ``left`` with the nearest ``right`` row
    within +-``hours`` of the same key (inclusive), or NULLs.

    Right columns are renamed ``prefix + name`` when the name also exists on
    the left (so ``TimeStamp`` / ``timestamp`` and shared names never clash).
    """
    width = int(hours * 3600 * 1_000_000)
    rcols = list(rcols or right.columns)
    lid = list(lid)
    lower = {c.lower() for c in left.columns}
    out_name = {c: (prefix + c if c.lower() in lower else c) for c in rcols}
    for c in (rkey, rts, rid):
        out_name.setdefault(c, prefix + c if c.lower() in lower else c)

    r = right.select(
        F.col(rkey).alias("_cl_rk"), _micros(right, rts).alias("_cl_rt"),
        F.col(rid).alias("_cl_rid"),
        *[F.col(c).alias(f"_cl_r_{c}") for c in rcols])
    r = r.where(F.col("_cl_rk").isNotNull() & F.col("_cl_rt").isNotNull())
    r = r.withColumn("_cl_b", F.explode(F.array(
        *[F.floor(F.col("_cl_rt") / width) + d for d in (-1, 0, 1)])))
    lt = _micros(left, lts)
    l_ = left.withColumn("_cl_lt", lt).withColumn(
        "_cl_b", F.floor(F.col("_cl_lt") / width))
    cond = ((F.col(lkey) == F.col("_cl_rk")) & (F.col("_cl_b") == F.col("_cl_rb"))
            & (F.col("_cl_rt") >= F.col("_cl_lt") - width)
            & (F.col("_cl_rt") <= F.col("_cl_lt") + width))
    j = l_.join(r.withColumnRenamed("_cl_b", "_cl_rb"), cond, "left")
    lrest = [c for c in left.columns if c not in lid]
    packed = F.struct(
        F.col("_cl_rt").isNull().alias("_cl_nomatch"),
        F.abs(F.col("_cl_rt") - F.col("_cl_lt")).alias("_cl_d"),
        F.col("_cl_rt").alias("_cl_t"), F.col("_cl_rid").alias("_cl_i"),
        *[F.col(c) for c in lrest],
        *[F.col(f"_cl_r_{c}") for c in rcols])
    best = j.groupBy(*lid).agg(F.min(packed).alias("_cl_best"))
    return best.select(
        *lid, *[F.col(f"_cl_best.{c}").alias(c) for c in lrest],
        *[F.col(f"_cl_best._cl_r_{c}").alias(out_name[c]) for c in rcols])


def _out_names(left: DataFrame, rcols, extra, prefix):
    lower = {c.lower() for c in left.columns}
    names = {c: (prefix + c if c.lower() in lower else c) for c in rcols}
    for c in extra:
        names.setdefault(c, prefix + c if c.lower() in lower else c)
    return names


def link_window(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                lts: str, rts: str, rid: str, lid: Sequence[str],
                hours: float = 6.0, rcols: Sequence[str] | None = None,
                prefix: str = "pats_", parts: int | None = None,
                unique_left: bool = False) -> DataFrame:
    """One row per ``lid`` value of ``left`` with the nearest ``right`` row
    within +-``hours`` of the same key (inclusive), or NULLs.

    Right columns are renamed ``prefix + name`` when the name also exists on
    the left (``TimeStamp`` / ``timestamp`` and shared names never clash).
    Of left rows sharing an ``lid`` value one survives (``DISTINCT ON`` with a
    fixed order: has a match, smallest |dt|, procedure time, procedure id,
    image time, remaining columns), with its own match; ``unique_left=True`` states
    that ``lid`` is already a key and skips that reduction. ``rid`` must be
    a key of ``right``.
    """
    from cathlake.session import checkpoint_dir
    spark = left.sparkSession
    checkpoint_dir(spark)
    width = int(hours * 3600 * 1_000_000)
    rcols = list(rcols or right.columns)
    lid = list(lid)
    names = _out_names(left, rcols, (rkey, rts, rid), prefix)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # 1. one procedure per (key, time): the smallest id
    r1 = (right.select(F.col(rkey).alias("_k"), _micros(right, rts).alias("_t"),
                       F.col(rid).alias("_rid"))
          .where(F.col("_k").isNotNull() & F.col("_t").isNotNull())
          .groupBy("_k", "_t").agg(F.min("_rid").alias("_rid")))
    # 2. narrow union, range partitioned on (key, time, side, image id)
    lid_struct = F.struct(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(lid)])
    l1 = (left.select(F.col(lkey).alias("_k"), _micros(left, lts).alias("_t"),
                      lid_struct.alias("_lid"))
          .where(F.col("_k").isNotNull() & F.col("_t").isNotNull()))
    u = (l1.select("_k", "_t", F.lit(1).alias("_side"), "_lid",
                   F.lit(None).cast(r1.schema["_rid"].dataType).alias("_rid"))
         .unionByName(r1.select("_k", "_t", F.lit(0).alias("_side"),
                                F.lit(None).cast(l1.schema["_lid"].dataType).alias("_lid"), "_rid")))
    order = [F.col("_k"), F.col("_t"), F.col("_side"), F.col("_lid")]
    s = sorted_checkpoint(u, order, n).withColumn("_pid", F.spark_partition_id())

    # 4. carry table, one row per partition, from one aggregate pass: the
    # partition's first / last key and its first / last procedure. The last
    # procedure belongs to the last key exactly when their keys agree. Keys
    # ascend across partitions, so the nearest earlier partition with a
    # valid "last procedure of its last key" is the predecessor carry for a
    # partition whose first key equals that key (mirror for successors).
    # Each task holds a single partition id, so the struct aggregate's sort
    # by that id is a linear pass.
    rstruct = F.when(F.col("_side") == 0, F.struct("_k", "_t", "_rid"))
    stats = s.groupBy("_pid").agg(
        F.min("_k").alias("_pf"), F.max("_k").alias("_pl"),
        F.max(rstruct).alias("_lr"), F.min(rstruct).alias("_fr"))
    stats = (stats.withColumn("_lr", F.when(F.col("_lr._k") == F.col("_pl"), F.col("_lr")))
             .withColumn("_fr", F.when(F.col("_fr._k") == F.col("_pf"), F.col("_fr"))))
    wp = Window.orderBy("_pid")  # over partitions: the table has one row per partition
    before = F.last("_lr", ignorenulls=True).over(wp.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_fr", ignorenulls=True).over(wp.rowsBetween(1, Window.unboundedFollowing))
    carry = (stats.withColumn("_b", before).withColumn("_a", after)
             .select("_pid", "_pf", "_pl",
                     F.when(F.col("_b._k") == F.col("_pf"), F.struct("_b._t", "_b._rid")).alias("_pred_c"),
                     F.when(F.col("_a._k") == F.col("_pl"), F.struct("_a._t", "_a._rid")).alias("_succ_c")))

    # 3. running predecessor / successor inside (partition, key)
    x = s.join(F.broadcast(carry), "_pid", "left")
    rv = F.when(F.col("_side") == 0, F.struct("_t", "_rid"))
    w = Window.partitionBy("_pid", "_k").orderBy("_t", "_side", "_lid")
    pred = F.last(rv, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    succ = F.first(rv, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    y = (x.withColumn("_pred", pred).withColumn("_succ", succ).where(F.col("_side") == 1)
         .withColumn("_pred", F.coalesce("_pred", F.when(F.col("_k") == F.col("_pf"), F.col("_pred_c"))))
         .withColumn("_succ", F.coalesce("_succ", F.when(F.col("_k") == F.col("_pl"), F.col("_succ_c")))))
    dp = F.col("_t") - F.col("_pred._t")
    ds = F.col("_succ._t") - F.col("_t")
    best = (F.when(F.col("_pred").isNull(), F.col("_succ")).when(F.col("_succ").isNull(), F.col("_pred"))
            .when(dp <= ds, F.col("_pred")).otherwise(F.col("_succ")))
    y = y.withColumn("_best", best)
    y = y.withColumn("_best", F.when(F.abs(F.col("_best._t") - F.col("_t")) <= width, F.col("_best")))
    if unique_left:
        m = y.select(*[F.col(f"_lid._l{i}").alias(f"_cl_lid{i}") for i in range(len(lid))],
                     F.col("_best._rid").alias("_cl_brid"))
    else:
        # several left rows may share an lid value: one rule picks the match
        # and, with it, the key and time of the image that it belongs to
        m = (y.groupBy("_lid").agg(F.min(F.struct(
                F.col("_best").isNull().alias("_nm"), F.abs(F.col("_best._t") - F.col("_t")).alias("_d"),
                F.col("_best._t").alias("_bt"), F.col("_best._rid").alias("_brid"),
                F.col("_t").alias("_it"), F.col("_k").alias("_ik"))).alias("_m"))
             .select(*[F.col(f"_lid._l{i}").alias(f"_cl_lid{i}") for i in range(len(lid))],
                     F.col("_m._brid").alias("_cl_brid"), F.col("_m._it").alias("_cl_it"),
                     F.col("_m._ik").alias("_cl_ik")))

    # 5. join back the image columns and the procedure payload
    lrest = [c for c in left.columns if c not in lid]
    cond = [F.col(c).eqNullSafe(F.col(f"_cl_lid{i}")) for i, c in enumerate(lid)]
    out = left.join(m, cond, "left").drop(*[f"_cl_lid{i}" for i in range(len(lid))])
    if not unique_left:
        # the survivor is the image that the match belongs to; without a
        # match, the first in column order
        own = F.coalesce((_micros(left, lts) == F.col("_cl_it")) & (F.col(lkey) == F.col("_cl_ik")), F.lit(False))
        out = keep_first(out.withColumn("_cl_other", ~own), lid, ["_cl_other", *lrest]) \
            .drop("_cl_other", "_cl_it", "_cl_ik")
    # many images of a heavy patient may pick the same procedure
    rp = right.select(F.col(rid).alias("_cl_brid"), *[F.col(c).alias(f"_cl_r_{c}") for c in rcols])
    out = join_back(out, rp, ["_cl_brid"], "left")
    return out.select(*left.columns, *[F.col(f"_cl_r_{c}").alias(names[c]) for c in rcols])
