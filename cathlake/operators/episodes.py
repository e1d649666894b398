"""Per-study label sequences: leading diagnostic runs and their building blocks.

A study (``entry``) is a time-ordered sequence of images, each with a label.
The flagship operator keeps, for a target label L, the *leading contiguous
run* of L: from the first L image up to (not including) the first image with
a different non-NULL label, never past the last L image. Images tied in time
share a rank, so a tie with a foreign label at the run start empties the run.

Everything here is written as per-study aggregates (min / max / count_if,
all map-side combinable) joined back to the rows on the study key. No window
is partitioned by the study, so a study holding a third of all rows is
pre-aggregated before it is shuffled, and the join back (one stats row per
study) salts hot studies over several tasks (``cathlake.operators.skew``).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cathlake.functions.ordering import key_for, to_col
from cathlake.operators.skew import join_back

E, K, LAB = "_cl_entry", "_cl_key", "_cl_label"


def _any(preds: list) -> Column:
    return reduce(lambda a, b: a | b, preds)


def _tag(L) -> str:
    return str(L).replace("-", "m")


def run_bounds(df: DataFrame, entry, ts, label, targets: Iterable = (1, 0),
               where: Column | None = None):
    """One row per study holding any target label: ``lo_L``/``hi_L`` (order
    keys of the first / last L image) and ``n_L`` (order key of the first image
    at or after ``lo_L`` and not after ``hi_L`` whose label is non-NULL and
    not L). Columns are named ``_cl_lo_<L>`` etc.

    The first aggregate reads every row (``where`` is applied inside it), so
    it also yields the rows per study that size the salting of both joins
    back; the second pass is filtered by ``where`` at the scan.
    """
    targets = list(targets)
    ok = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    allrows = (df.select(to_col(entry).alias(E), key_for(df, ts).alias(K),
                         to_col(label).alias(LAB), ok.alias("_cl_ok"))
               .where(F.col(E).isNotNull()))
    k, lab, inc = F.col(K), F.col(LAB), F.col("_cl_ok")
    first = []
    for L in targets:
        isL = inc & (lab == F.lit(L))
        first += [F.min(F.when(isL, k)).alias(f"_cl_lo_{_tag(L)}"),
                  F.max(F.when(isL, k)).alias(f"_cl_hi_{_tag(L)}")]
    s0 = allrows.groupBy(E).agg(*first)
    s1 = s0.where(_any([F.col(f"_cl_lo_{_tag(L)}").isNotNull() for L in targets]))
    bound_cols = [c for c in s1.columns if c != E]
    second = []
    for L in targets:
        lo, hi = F.col(f"_cl_lo_{_tag(L)}"), F.col(f"_cl_hi_{_tag(L)}")
        foreign = (lab != F.lit(L)) & (k >= lo) & (k <= hi)
        second.append(F.min(F.when(foreign, k)).alias(f"_cl_n_{_tag(L)}"))
    # the second pass filters with the predicate itself, so it reaches the scan
    base = df if where is None else df.where(where)
    rows = (base.select(to_col(entry).alias(E), key_for(df, ts).alias(K), to_col(label).alias(LAB))
            .where(F.col(E).isNotNull()))
    # lo/hi are functions of the study, so grouping by them keeps them
    # without another join; hot studies are salted in the join.
    bounds = join_back(rows, s1, [E], "inner").groupBy(E, *bound_cols).agg(*second)
    return bounds


def in_run(L, key: Column | None = None) -> Column:
    """Predicate over a frame joined with ``run_bounds``: row is in L's run."""
    k = F.col(K) if key is None else key
    lo, hi, n = (F.col(f"_cl_{p}_{_tag(L)}") for p in ("lo", "hi", "n"))
    return F.coalesce(k.between(lo, hi) & (n.isNull() | (k < n)), F.lit(False))


def leading_runs(df: DataFrame, entry, ts, label, targets: Iterable = (1, 0),
                 where: Column | None = None, prefix: str = "run_") -> DataFrame:
    """``df`` plus one boolean column ``<prefix><L>`` per target label.

    Rows failing ``where`` (e.g. another modality) are never in a run.
    """
    targets = list(targets)
    stats = run_bounds(df, entry, ts, label, targets, where)
    cond = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    full = df.withColumn(E, to_col(entry)).withColumn(K, key_for(df, ts))
    out = join_back(full, stats, [E], "left")
    for L in targets:
        out = out.withColumn(f"{prefix}{_tag(L)}", cond & in_run(L))
    return out.drop(*[c for c in out.columns if c.startswith("_cl_")])


def flag_diagnostic(df: DataFrame, entry=None, ts="TimeStamp",
                    label="labels_predictions", targets: Iterable = (1, 0),
                    where: Column | None = None,
                    flag: str = "diagnostic_data") -> DataFrame:
    """Set ``flag`` TRUE on every row of a leading run of any target label.

    Other rows keep their previous flag value (the flag is never set FALSE).
    ``entry`` defaults to ``PatientID || '-' || StudyInstanceUID`` (NULL when
    either part is NULL, so such rows never match); ``where`` defaults to
    ``Modality = 'XA'``.
    """
    if entry is None:
        entry = F.concat(F.col("PatientID"), F.lit("-"), F.col("StudyInstanceUID"))
    if where is None and "Modality" in df.columns:
        where = F.col("Modality") == "XA"
    targets = list(targets)
    runs = leading_runs(df, entry, ts, label, targets, where, prefix="__run_")
    any_run = _any([F.col(f"__run_{_tag(L)}") for L in targets])
    old = F.col(flag) if flag in df.columns else F.lit(None).cast("boolean")
    out = runs.withColumn(flag, F.when(any_run, F.lit(True)).otherwise(old))
    return out.select(*[c for c in df.columns if c != flag], flag) \
        if flag in df.columns else out.select(*df.columns, flag)


def leading_runs_v1(df: DataFrame, entry, ts, label, L) -> DataFrame:
    """The earlier formulation of the same intent (kept as its own operator).

    Within studies having label L (T1): T2 = rows before the first L time,
    T3 = T1 minus T2; keep rows before the first non-L time of T1 (T4) or of
    T3 (T5), all of T1 when its only non-NULL label is L (T6), all of T3 when
    its only non-NULL label is L (T7). Times compare with SQL NULL rules, so a
    NULL time is never "before" and falls in T3; NULL labels are neither L
    nor non-L. Returns the kept rows of ``df``.
    """
    e, t, lab = to_col(entry), to_col(ts), to_col(label)
    rows = df.withColumn(E, e).withColumn("_cl_t", t).withColumn(LAB, lab)
    tt, lb = F.col("_cl_t"), F.col(LAB)
    isL, notL = lb == F.lit(L), lb != F.lit(L)
    s0 = (rows.where(F.col(E).isNotNull()).groupBy(E)
          .agg(F.count_if(isL).alias("_cl_nL"),
               F.min(F.when(isL, tt)).alias("_cl_fL"),
               F.min(F.when(notL, tt)).alias("_cl_fN1"),
               F.count_if(notL).alias("_cl_cN1")))
    s1 = s0.where(F.col("_cl_nL") > 0).drop("_cl_nL")
    in_t3 = ~F.coalesce(tt < F.col("_cl_fL"), F.lit(False))
    s1_cols = [c for c in s1.columns if c != E]
    s2 = (join_back(rows.select(E, "_cl_t", LAB), s1, [E], "inner")
          .groupBy(E, *s1_cols)
          .agg(F.min(F.when(in_t3 & notL, tt)).alias("_cl_fN3"),
               F.count_if(in_t3 & notL).alias("_cl_cN3")))
    j = join_back(rows, s2, [E], "inner")
    keep = (F.coalesce(tt < F.col("_cl_fN1"), F.lit(False))
            | (in_t3 & F.coalesce(tt < F.col("_cl_fN3"), F.lit(False)))
            | (F.col("_cl_cN1") == 0)
            | (in_t3 & (F.col("_cl_cN3") == 0)))
    out = j.where(keep)
    return out.select(*df.columns)


def group_extremum(df: DataFrame, entry, ts, label, L) -> DataFrame:
    """Rows tied with the first or the last L image of their study (the
    "join back to min/max rank" step), with ``at_first``/``at_last`` flags."""
    k = key_for(df, ts)
    rows = df.withColumn(E, to_col(entry)).withColumn(K, k)
    isL = to_col(label) == F.lit(L)
    stats = (rows.where(F.col(E).isNotNull()).groupBy(E)
             .agg(F.min(F.when(isL, F.col(K))).alias("_cl_lo"),
                  F.max(F.when(isL, F.col(K))).alias("_cl_hi")))
    stats = stats.where(F.col("_cl_lo").isNotNull())
    j = join_back(rows, stats, [E], "inner")
    out = (j.withColumn("at_first", F.col(K) == F.col("_cl_lo"))
           .withColumn("at_last", F.col(K) == F.col("_cl_hi"))
           .where(F.col("at_first") | F.col("at_last")))
    return out.select(*df.columns, "at_first", "at_last")


def before_first(df: DataFrame, entry, ts, cond: Column) -> DataFrame:
    """Rows strictly before the earliest time at which ``cond`` holds in the
    same study (the decorrelated form of ``ts < (SELECT min(ts) ... )``)."""
    t = to_col(ts)
    rows = df.withColumn(E, to_col(entry)).withColumn("_cl_t", t)
    stats = rows.groupBy(E).agg(F.min(F.when(cond, F.col("_cl_t"))).alias("_cl_f"))
    stats = stats.where(F.col("_cl_f").isNotNull())
    j = join_back(rows, stats, [E], "inner")
    return j.where(F.col("_cl_t") < F.col("_cl_f")).select(*df.columns)


def uniform_groups(df: DataFrame, keys: list, label) -> DataFrame:
    """Groups whose non-NULL labels are all equal (``count(DISTINCT l) = 1``),
    written as ``min = max`` so it combines map-side."""
    lab = to_col(label)
    return (df.groupBy(*keys)
            .agg(F.min(lab).alias("_cl_mn"), F.max(lab).alias("_cl_mx"),
                 F.count("*").alias("n_rows"))
            .where(F.col("_cl_mn") == F.col("_cl_mx"))
            .select(*keys, F.col("_cl_mn").alias("label"), "n_rows"))


def series_expand(df: DataFrame, start, stop, name: str = "n") -> DataFrame:
    """``generate_series(start, stop)`` per row; empty when start > stop (a bare
    ``sequence`` would count down)."""
    a, b = to_col(start), to_col(stop)
    seq = F.when(a <= b, F.sequence(a, b))
    return df.select("*", F.explode(seq).alias(name))
