"""Sets of row ids as bitmaps.

A set of non-negative ids is a table of one bitmap per bucket of 32 768 ids
(``bucket`` from 1, ``bits``), built by an aggregate that combines on the map
side. Unions merge bitmaps bucket by bucket, so a set of any size moves as
4 KB a bucket at most, however many rows name an id. NULL and negative ids
belong to no set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_IDS = 32_768  # ids of a bucket, fixed by the bitmap functions


def id_set(df: DataFrame, row_id, where: Column | None = None) -> DataFrame:
    """The set of ``row_id`` over the rows that satisfy ``where``."""
    x = F.col(row_id) if isinstance(row_id, str) else row_id
    ids = (df if where is None else df.where(where)).select(x.cast("long").alias("_cl_id")).where(F.col("_cl_id") >= 0)
    # The functions number buckets from ids of 1 on.
    one = F.col("_cl_id") + 1
    return ids.groupBy(F.bitmap_bucket_number(one).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))


def union(*sets: DataFrame) -> DataFrame:
    """The union of sets."""
    every = reduce(DataFrame.unionByName, sets)
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(ids: DataFrame) -> DataFrame:
    """One row with the number of ids (``n``); a union first makes buckets unique."""
    return ids.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def members(ids: DataFrame, name: str = "id") -> DataFrame:
    """The ids of a set, one row each; buckets are spread over their bytes first."""
    byte = ids.select("bucket", F.explode(F.sequence(F.lit(1), F.octet_length("bits"))).alias("at"), "bits")
    byte = byte.select("bucket", "at", F.conv(F.hex(F.substring("bits", F.col("at"), F.lit(1))), 16, 10).cast("int").alias("v"))
    bit = byte.where(F.col("v") != 0).select("bucket", "at", "v", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("b"))
    hit = bit.where(F.expr("(shiftright(v, b) & 1) = 1"))
    return hit.select(((F.col("bucket") - 1) * BUCKET_IDS + (F.col("at") - 1) * 8 + F.col("b")).cast("long").alias(name))
