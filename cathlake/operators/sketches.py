"""Distinct counts and exclusions from stored theta sketches.

A sketch of 2^k entries stands for a set of any size. Sketches of parts are
merged by union, and the difference of two is a sketch again ("in A and not
in B"), so cohort counts and exclusion reports of a grown table need the new
rows and the stored sketches only. Up to 2^k distinct values a sketch is
exact; beyond that its estimate has a relative standard error of
1 / sqrt(2^k - 1) for a set, and for a difference that error taken of the
union. ``LOG_ENTRIES`` = 12 gives 1.6 %.

NULL is no value, as in ``COUNT(DISTINCT x)``; for row values
(``COUNT(DISTINCT (a, b))``) NULL parts count.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES = 12


def relative_error(log_entries: int = LOG_ENTRIES, deviations: float = 3.0) -> float:
    """Bound of an estimate's relative error at so many standard deviations."""
    return deviations / math.sqrt((1 << log_entries) - 1)


def value_of(*cols: str) -> Column:
    """What a sketch takes in for a row value: its parts as JSON text, NULL parts named."""
    return F.to_json(F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"})


def sketch(df: DataFrame, values: dict[str, Column], by: Sequence[str] = (), log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One row per ``by`` group with a sketch column per entry of ``values`` (rows where it is
    NULL do not count); to be stored."""
    return df.groupBy(*by).agg(*[F.theta_sketch_agg(v, F.lit(log_entries)).alias(name) for name, v in values.items()])


def merged(stored: DataFrame, names: Sequence[str], by: Sequence[str] = (), log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Stored sketches of parts as one row per ``by`` group."""
    return stored.groupBy(*by).agg(*[F.theta_union_agg(n, F.lit(log_entries)).alias(n) for n in names])


def estimate(name: str) -> Column:
    """Distinct values of a sketch column."""
    return F.theta_sketch_estimate(name)


def without(a: str, b: str) -> Column:
    """Distinct values of sketch ``a`` that are not in sketch ``b``."""
    return F.theta_sketch_estimate(F.theta_difference(a, b))
