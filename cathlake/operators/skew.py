"""Joining per-key results back to the rows when one key may hold a third
of all rows.

Adaptive execution splits a skewed join partition only when both sides arrive
through a fresh shuffle. A per-key stats table usually comes straight out of
an aggregate whose partitioning the join would reuse, and then a hot key is
one task. ``join_back`` therefore joins on the keys and on a hash of them: no
earlier partitioning covers that hash, so both sides get a shuffle of their
own, and adaptive execution splits a hot key by its measured size
(``spark.sql.adaptive.skewJoin.*``). Rows with a NULL key part take the same
join; under plain equality they match nothing, and their partition is split
like any other hot one. There are no salts, no key lists and no extra passes.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(rows: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner",
              null_safe: bool = False) -> DataFrame:
    """``rows`` joined with ``stats`` (few rows per key) on ``keys`` with
    ``how`` in ``inner`` / ``left`` / ``left_semi`` / ``left_anti``.

    Output columns: ``rows`` then the non-key ``stats`` columns (``rows`` only
    for semi / anti joins).
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    extra = [c for c in stats.columns if c not in keys]
    r = rows.select(*[F.col(c) for c in rows.columns], F.xxhash64(*keys).alias("_cl_left_hash"))
    s = stats.select(*[F.col(k).alias(f"_cl_s_{k}") for k in keys], *[F.col(c) for c in extra],
                     F.xxhash64(*keys).alias("_cl_right_hash"))
    same = [F.col(k).eqNullSafe(F.col(f"_cl_s_{k}")) if null_safe else F.col(k) == F.col(f"_cl_s_{k}")
            for k in keys]
    out = r.join(s, reduce(lambda x, y: x & y, [F.col("_cl_left_hash") == F.col("_cl_right_hash"), *same]), how)
    kept = rows.columns if how in ("left_semi", "left_anti") else [*rows.columns, *extra]
    return out.select(*[F.col(c) for c in kept])
