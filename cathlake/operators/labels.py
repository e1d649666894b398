"""Annotation merge, cohort phase assignment and synthetic labels."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.functions import normalize as N
from cathlake.operators.skew import join_back

ANNOTATION_KEY = ("PatientID", "SeriesInstanceUID", "StudyInstanceUID", "SOPInstanceUID")


def merge_annotations(df: DataFrame, ann: DataFrame, keys: Sequence[str] = ANNOTATION_KEY,
                      values: Sequence[str] = ("labels",), keep_existing: bool = False,
                      dedupe: bool = False) -> DataFrame:
    """Left join annotations on all ``keys`` with NULL matching NULL.

    The annotation ``values`` replace the frame's columns of the same name,
    converted to their type (an unannotated row gets NULL), unless
    ``keep_existing``, which keeps the old value where no annotation exists.
    Duplicate annotations fan out unless ``dedupe`` keeps one (the smallest
    values) per key.
    """
    keys, values = list(keys), list(values)
    a = ann.select(*keys, *[F.col(v).alias(f"_cl_v_{v}") for v in values])
    if dedupe:
        a = a.groupBy(*keys).agg(
            F.min(F.struct(*[F.col(f"_cl_v_{v}") for v in values])).alias("_cl_s")) \
            .select(*keys, *[F.col(f"_cl_s._cl_v_{v}").alias(f"_cl_v_{v}") for v in values])
    j = join_back(df, a, keys, "left", null_safe=True)
    have = dict(df.dtypes)
    for v in values:
        new = F.col(f"_cl_v_{v}")
        # annotation files are text: values take the catalog column's type
        # (integers through a double, as the loader parses them)
        if v in have and have[v] != dict(a.dtypes)[f"_cl_v_{v}"]:
            if have[v] == "bigint":
                new = N.to_long(new.cast("string"))
            elif have[v] == "double":
                new = N.to_double(new.cast("string"))
            else:
                new = new.try_cast(have[v])
        if keep_existing and v in df.columns:
            new = F.coalesce(new, F.col(v))
        j = j.withColumn(v, new)
    cols = list(df.columns) + [v for v in values if v not in df.columns]
    return j.select(*cols)


def assign_phase(df: DataFrame, ids: DataFrame, key: str = "PatientID", id_col: str | None = None,
                 phase: str = "phase", value: str = "test") -> DataFrame:
    """``phase = value`` for rows whose ``key`` is in the id list; other rows
    keep their phase. The id list is de-duplicated first, so the left join
    never fans out; adaptive execution broadcasts it once measured small."""
    id_col = id_col or key
    hits = ids.select(F.col(id_col).alias(key)).where(F.col(key).isNotNull()) \
              .distinct().withColumn("_cl_hit", F.lit(True))
    j = join_back(df, hits, [key], "left")
    old = F.col(phase) if phase in df.columns else F.lit(None).cast("string")
    out = j.withColumn(phase, F.when(F.col("_cl_hit"), F.lit(value)).otherwise(old))
    cols = list(df.columns) + ([phase] if phase not in df.columns else [])
    return out.select(*cols)


def synthetic_labels(df: DataFrame, id_col: str = "rowid", seed: int = 0, k: int = 3,
                     label_cols: Sequence[str] = ("labels_transformed", "labels"),
                     forced: Sequence = (1, 2), forced_col: str | None = "labels_transformed",
                     float_cols: Sequence[str] = ()) -> DataFrame:
    """Dummy values for testing downstream jobs: each of ``label_cols`` gets
    an integer in ``0..k-1``, ``forced_col`` is 1 for the ids in ``forced``,
    and each of ``float_cols`` gets a number in [0, 1).

    Values come from the MD5 of "seed:column:id" (its first 28 bits), so a
    rerun or a retried task gives the same values whatever the partitioning.
    """
    def number(i: int):
        told = F.concat_ws(":", F.lit(str(seed)), F.lit(str(i)), rid.cast("string"))
        return F.conv(F.substring(F.md5(told), 1, 7), 16, 10).cast("long")

    rid = F.col(id_col)
    for i, c in enumerate(label_cols):
        df = df.withColumn(c, number(i) % k)
    if forced_col:
        df = df.withColumn(forced_col, F.when(rid.isin(*forced), F.lit(1).cast("long"))
                           .otherwise(F.col(forced_col)))
    for j, c in enumerate(float_cols):
        df = df.withColumn(c, number(1000 + j) / float(1 << 28))
    return df
