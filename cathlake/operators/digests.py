"""Table differences by digests of key buckets.

A table's rows fall into ``n`` buckets by a hash of their key. A bucket's
digest is its row count and two sums over row hashes; sums do not depend on
order, so digests are map-side combined, can be stored, and those of
appended rows can be added to them (``add``). Two versions of a table then
differ only in buckets whose digests differ, and only these are read again and
compared by key (``changes``). Tables written with ``write_bucketed`` are folders
by bucket, so the others are not opened.

The list of differing buckets has at most ``n`` numbers. Each digest sum
takes 64-bit hashes with a seed of its own: a bucket that changed keeps its digest
with a chance of about 2^-128.

Defined results: NULL is a value like any other, in keys and columns; a
row that a version holds several times counts that often; an empty table
differs in the other's buckets only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cathlake.operators.skew import join_back

BUCKET = "_cl_bucket"
N_BUCKETS = 1024
SUMS = ["n", "s1", "s2"]


def bucket_of(keys: Sequence[str], n: int = N_BUCKETS):
    """Bucket of a key; a NULL part is told from any value and from a NULL in another place."""
    parts = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return F.pmod(F.xxhash64(*parts), F.lit(n)).cast("int")


def _row_hash(cols: Sequence[str], seed: int):
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (F.col(c).isNull(), F.col(c))]).cast("decimal(38,0)")


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], n: int = N_BUCKETS) -> None:
    """``df`` as Parquet folders by bucket."""
    df.withColumn(BUCKET, bucket_of(keys, n)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _bucketed(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df if BUCKET in df.columns else df.withColumn(BUCKET, bucket_of(keys, n))


def digests(df: DataFrame, keys: Sequence[str], n: int = N_BUCKETS) -> DataFrame:
    """(bucket, n, s1, s2) of a table, bucketed already or not."""
    cols = sorted(c for c in df.columns if c != BUCKET)
    return _bucketed(df, keys, n).groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_row_hash(cols, 1)).alias("s1"), F.sum(_row_hash(cols, 2)).alias("s2"))


def add(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Digests of two tables' rows together."""
    return stored.unionByName(more).groupBy(BUCKET).agg(*[F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in SUMS])


def differing(old: DataFrame, new: DataFrame) -> list[int]:
    """Buckets whose digests differ, in order: at most as many as there are buckets."""
    a, b = (d.select(BUCKET, F.struct(*SUMS).alias(x)) for d, x in ((old, "a"), (new, "b")))
    rows = a.join(b, BUCKET, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(BUCKET).collect()
    return sorted(r[0] for r in rows)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str], old_digests: DataFrame | None = None,
            n: int = N_BUCKETS) -> DataFrame:
    """Rows of ``old`` and ``new`` that the other version does not hold as often: the
    columns, ``change`` (``removed`` or ``added``) and ``copies``.

    ``old_digests`` are those stored for ``old``; without them it is read once more.
    """
    old, new = _bucketed(old, keys, n), _bucketed(new, keys, n)
    touched = differing(digests(old, keys, n) if old_digests is None else old_digests, digests(new, keys, n))
    cols = [c for c in old.columns if c != BUCKET]
    hit = F.col(BUCKET).isin(touched) if touched else F.lit(False)
    both = old.where(hit).select(*cols, F.lit(-1).alias("_cl_side")).unionByName(
        new.where(hit).select(*cols, F.lit(1).alias("_cl_side")))
    net = both.groupBy(*cols).agg(F.sum("_cl_side").alias("_cl_net")).where("_cl_net != 0")
    return net.select(*cols, F.when(F.col("_cl_net") < 0, "removed").otherwise("added").alias("change"),
                      F.abs("_cl_net").alias("copies"))


def refresh(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str], old_digests: DataFrame | None = None,
            n: int = N_BUCKETS) -> DataFrame:
    """``old`` with ``cols`` of the rows whose key ``new`` holds with other values (``keys`` are
    unique in both). Only touched buckets are joined; the others are passed on."""
    old, new = _bucketed(old, keys, n), _bucketed(new, keys, n)
    touched = differing(digests(old, keys, n) if old_digests is None else old_digests, digests(new, keys, n))
    hit = F.col(BUCKET).isin(touched) if touched else F.lit(False)
    names = [c for c in old.columns if c != BUCKET]
    fresh = new.where(hit).select(*keys, F.struct(*cols).alias("_cl_new"))
    changed = join_back(old.where(hit), fresh, keys, "left", null_safe=True)
    for c in cols:
        changed = changed.withColumn(c, F.when(F.col("_cl_new").isNull(), F.col(c)).otherwise(F.col(f"_cl_new.`{c}`")))
    return old.where(~hit).select(*names).unionByName(changed.select(*names))
