"""Leading runs from stored summaries of time ranges.

A study's images are cut into cells of ``grain`` order-key units. A cell's
summary holds, for each target label L,

* ``lo`` / ``hi``: the first and last L image,
* ``ff``: the first image with another non-NULL label,
* ``fa``: the first such image at or after ``lo``.

Summaries of later ranges follow those of earlier ones, and two neighbours
(A, B) make one: lo = A.lo or B.lo, hi = B.hi or A.hi, ff = A.ff or B.ff, and
fa = (A.fa or B.ff) if A has L, else B.fa. That is associative, so cells may
be merged in any grouping. Over all cells of a study it comes to plain minima
(``bounds``): the study's first foreign image is the ``fa`` of the cell that
holds ``lo`` or the ``ff`` of a later cell, whichever is first.

New rows change only the cells they fall in: ``refresh`` summarises those
again, from old and new rows, and keeps the others as stored. Times may
arrive in any order.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cathlake.functions.ordering import key_for, to_col
from cathlake.operators.episodes import E, K, LAB, _tag, in_run
from cathlake.operators.skew import join_back

CELL = "_cl_cell"
DAY = 86_400_000_000  # microseconds, the unit of a timestamp's order key


def _rows(df: DataFrame, entry, ts, label, where: Column | None, grain: int) -> DataFrame:
    base = df if where is None else df.where(where)
    keyed = base.select(to_col(entry).alias(E), key_for(df, ts).alias(K), to_col(label).alias(LAB)).where(F.col(E).isNotNull())
    return keyed.withColumn(CELL, _cell(F.col(K), grain))


def _cell(key: Column, grain: int) -> Column:
    """Number of the range that an order key falls in; ranges follow the keys' order."""
    return (key - F.pmod(key, F.lit(grain))) / F.lit(grain) if grain < 1 else F.floor(key / F.lit(grain)).cast("long")


def _summaries(rows: DataFrame, targets: list) -> DataFrame:
    lab, k = F.col(LAB), F.col(K)
    first = []
    for L in targets:
        t = _tag(L)
        first += [F.min(F.when(lab == F.lit(L), k)).alias(f"lo_{t}"), F.max(F.when(lab == F.lit(L), k)).alias(f"hi_{t}"),
                  F.min(F.when(lab != F.lit(L), k)).alias(f"ff_{t}")]
    s0 = rows.groupBy(E, CELL).agg(*first)
    stats = [c for c in s0.columns if c not in (E, CELL)]
    after = [F.min(F.when((lab != F.lit(L)) & (k >= F.col(f"lo_{_tag(L)}")), k)).alias(f"fa_{_tag(L)}") for L in targets]
    return join_back(rows, s0, [E, CELL]).groupBy(E, CELL, *stats).agg(*after)


def summarise(df: DataFrame, entry, ts, label, targets: Iterable = (1, 0), where: Column | None = None,
              grain: int = DAY) -> DataFrame:
    """One summary per study and cell (to be stored)."""
    return _summaries(_rows(df, entry, ts, label, where, grain), list(targets))


def refresh(stored: DataFrame, old: DataFrame, new: DataFrame, entry, ts, label, targets: Iterable = (1, 0),
            where: Column | None = None, grain: int = DAY) -> DataFrame:
    """Summaries of ``old`` and ``new`` rows together, given those of ``old``. Only rows of
    cells that ``new`` touches are read again."""
    fresh = _rows(new, entry, ts, label, where, grain)
    touched = fresh.select(E, CELL).distinct()
    again = join_back(_rows(old, entry, ts, label, where, grain), touched, [E, CELL], "left_semi")
    kept = join_back(stored, touched, [E, CELL], "left_anti")
    return kept.unionByName(_summaries(again.unionByName(fresh), list(targets)))


def merge(cells: DataFrame, per: Iterable[str] = (E,), grain: int = DAY, coarse: int | None = None) -> DataFrame:
    """Summaries of ranges of ``coarse`` cells, from those of single cells: the monoid
    itself, for storage that is coarser than its intake."""
    if not coarse or coarse < 2:
        return cells
    tags = [c[3:] for c in cells.columns if c.startswith("lo_")]
    wide = F.floor(F.col(CELL) / F.lit(coarse)).cast("long")
    firsts = cells.groupBy(*per, wide.alias("_cl_wide")).agg(*[F.min(f"lo_{t}").alias(f"_cl_lo_{t}") for t in tags])
    both = join_back(cells.withColumn("_cl_wide", wide), firsts, [*per, "_cl_wide"])
    out = []
    for t in tags:
        home = _cell(F.col(f"_cl_lo_{t}"), grain)
        out += [F.min(f"lo_{t}").alias(f"lo_{t}"), F.max(f"hi_{t}").alias(f"hi_{t}"), F.min(f"ff_{t}").alias(f"ff_{t}"),
                F.min(_after(t, home)).alias(f"fa_{t}")]
    order = [c for c in cells.columns if c not in (*per, CELL)]
    return both.groupBy(*per, "_cl_wide").agg(*out).withColumnRenamed("_cl_wide", CELL).select(*per, CELL, *order)


def _after(tag: str, home: Column) -> Column:
    """What a cell adds to the first foreign image at or after the first L, which is in cell ``home``."""
    return F.when(F.col(CELL) == home, F.col(f"fa_{tag}")).when(F.col(CELL) > home, F.col(f"ff_{tag}"))


def bounds(cells: DataFrame, grain: int = DAY) -> DataFrame:
    """Run bounds per study, as ``episodes.run_bounds`` gives them."""
    tags = [c[3:] for c in cells.columns if c.startswith("lo_")]
    g = cells.groupBy(E).agg(*[x for t in tags for x in (F.min(f"lo_{t}").alias(f"_cl_lo_{t}"), F.max(f"hi_{t}").alias(f"_cl_hi_{t}"))])
    held = [c for c in g.columns if c != E]
    return join_back(cells, g, [E]).groupBy(E, *held).agg(
        *[F.min(_after(t, _cell(F.col(f"_cl_lo_{t}"), grain))).alias(f"_cl_n_{t}") for t in tags])


def flag_from(cells: DataFrame, df: DataFrame, entry, ts, targets: Iterable = (1, 0), where: Column | None = None,
              grain: int = DAY, flag: str = "diagnostic_data") -> DataFrame:
    """``df`` with ``flag`` TRUE on rows of a leading run of any target, from summaries; other
    rows keep their flag (NULL where there is none)."""
    ok = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    full = df.withColumn(E, to_col(entry)).withColumn(K, key_for(df, ts))
    out = join_back(full, bounds(cells, grain), [E], "left")
    hit = F.lit(False)
    for L in targets:
        hit = hit | in_run(L)
    old = F.col(flag) if flag in df.columns else F.lit(None).cast("boolean")
    return out.withColumn(flag, F.when(ok & hit, F.lit(True)).otherwise(old)).select(*[c for c in df.columns if c != flag], flag)
