"""Set membership and set operations with SQL NULL semantics.

``x NOT IN (subquery)`` is true only when every comparison is definitely
false, so one NULL on the right empties the result and a NULL ``x`` is kept
only against an empty right side. Spark plans a single-column ``NOT IN`` as a
null-aware anti join that must broadcast the right side, and a multi-column
one as a nested loop. Both are rewritten here into hash anti joins:

* complete keys on both sides: an ordinary ``left_anti`` on all key columns;
* right rows with NULL parts: grouped by their NULL pattern (at most
  2^k - 1 patterns); a right row excludes a complete left row when the left
  row equals it on the right row's non-NULL columns, i.e. one ``left_anti``
  per pattern on that pattern's columns;
* left rows with NULL parts: excluded when some right row agrees with them
  on every column where both are non-NULL, again one ``left_anti`` per
  (left pattern, right pattern) pair on the shared non-NULL columns.

The distinct NULL patterns present are read with one small aggregate (at
most 2^k - 1 rows), so the plan only contains the joins that have rows.
Every anti / semi join salts hot left keys (``cathlake.operators.skew``).
Existence tests are uncorrelated ``EXISTS`` subqueries (at most one row read).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cathlake.operators.skew import join_back


def _mask(keys: Sequence[str]) -> Column:
    bits = [F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(keys)]
    return reduce(lambda a, b: a + b, bits)


def _patterns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[list, list]:
    """NULL patterns (bit i set = key i NULL) present on each side, complete
    rows excluded. Keys that the schema declares non-null need no read; else
    one job reads the patterns, at most 2 * (2^len(keys) - 1) values."""
    if not any(df.schema[k].nullable for df in (left, right) for k in keys):
        return [], []
    both = (left.select(F.lit(0).alias("_cl_side"), _mask(keys).alias("_cl_m"))
            .unionByName(right.select(F.lit(1).alias("_cl_side"), _mask(keys).alias("_cl_m")))
            .where(F.col("_cl_m") > 0).distinct().collect())
    return (sorted(r["_cl_m"] for r in both if r["_cl_side"] == 0),
            sorted(r["_cl_m"] for r in both if r["_cl_side"] == 1))


def _nonnull(keys: Sequence[str], pattern: int) -> list[str]:
    return [k for i, k in enumerate(keys) if not (pattern >> i) & 1]


def _drop_if_exists(left: DataFrame, other: DataFrame) -> DataFrame:
    """``left`` when ``other`` is empty, else no rows: an uncorrelated
    ``NOT EXISTS`` (a scalar subquery that reads at most one row)."""
    return left.where(~other.exists())


def not_in(left: DataFrame, right: DataFrame, lcol: str, rcol: str | None = None) -> DataFrame:
    """Rows of ``left`` where ``left.lcol NOT IN (SELECT rcol FROM right)``."""
    rcol = rcol or lcol
    r = right.select(F.col(rcol).alias("_cl_k"))
    rk = r.where(F.col("_cl_k").isNotNull()).distinct().withColumnRenamed("_cl_k", lcol)
    keep = join_back(left.where(F.col(lcol).isNotNull()), rk, [lcol], "left_anti")
    nulls = _drop_if_exists(left.where(F.col(lcol).isNull()), r)
    out = keep.unionByName(nulls)
    # Any NULL on the right makes every comparison unknown.
    return _drop_if_exists(out, r.where(F.col("_cl_k").isNull()))


def not_in_tuple(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 rkeys: Sequence[str] | None = None, left_unique: bool = False) -> DataFrame:
    """Rows of ``left`` where ``(keys) NOT IN (SELECT rkeys FROM right)``.

    ``left_unique=True`` states that ``keys`` is a key of ``left`` (e.g. it
    was just de-duplicated on them): the complete-key anti join then has no
    hot key and may reuse an earlier partitioning.
    """
    keys = list(keys)
    rkeys = list(rkeys or keys)
    r = right.select(*[F.col(a).alias(b) for a, b in zip(rkeys, keys)])
    lm, rm = _mask(keys), _mask(keys)
    l_full, l_part = left.where(lm == 0), left.where(lm > 0)
    r_full, r_part = r.where(rm == 0), r.where(rm > 0)
    l_pats, r_pats = _patterns(left, r, keys)

    def anti(df: DataFrame, rr: DataFrame, cols: list[str]) -> DataFrame:
        if not cols:
            return _drop_if_exists(df, rr)
        return join_back(df, rr.select(*cols).distinct(), cols, "left_anti")

    if left_unique:
        out = l_full.join(r_full.distinct(), keys, "left_anti")
    else:
        out = anti(l_full, r_full, keys)
    for p in r_pats:
        out = anti(out, r_part.where(rm == p), _nonnull(keys, p))
    parts = [out]
    for q in l_pats:
        src = l_part.where(lm == q)
        cq = _nonnull(keys, q)
        lq = anti(src, r_full, cq)
        for p in r_pats:
            shared = [c for c in cq if c in _nonnull(keys, p)]
            lq = anti(lq, r_part.where(rm == p), shared)
        parts.append(lq)
    return reduce(lambda a, b: a.unionByName(b), parts)


def semi_in(left: DataFrame, right: DataFrame, keys: Sequence[str],
            rkeys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``left`` whose key IN the right keys (NULL never matches)."""
    rkeys = list(rkeys or keys)
    r = right.select(*[F.col(a).alias(k) for a, k in zip(rkeys, keys)]).distinct()
    return join_back(left, r, list(keys), "left_semi")


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """``UNION`` of frames with the same columns (by name)."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenation by column name; columns missing in a frame are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
