"""Catalog upsert: append new keys with continuing ids, refresh matching rows.

The result is one DataFrame (refreshed base rows + numbered new rows) meant
to be written to a new path and swapped in, never written over the path it
reads; see ``cathlake.sources.sinks.replace_table``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.operators.numbering import dense_ids, keep_first
from cathlake.operators.setjoin import not_in_tuple
from cathlake.operators.skew import join_back

CATALOG_KEY = ("PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID")


def upsert_catalog(base: DataFrame, staging: DataFrame,
                   keys: Sequence[str] = CATALOG_KEY,
                   refresh: Sequence[str] = ("DcmPathFlatten",),
                   id_col: str = "rowid", order: Sequence[str] | None = None,
                   base_unique: bool = True, id_start=None) -> DataFrame:
    """Merge ``staging`` into ``base`` (same columns).

    * staging is first reduced to one row per key (first in ``order``);
    * staging rows whose key tuple is ``NOT IN`` the base keys (SQL NULL
      rules: a key with a NULL part is new only if no base key can equal it)
      get ids ``max(base.id) + 1, + 2, ...`` in ``order``;
    * base rows whose key equals a staging key (plain equality, NULL parts
      never match) take the staging values of the ``refresh`` columns.

    ``id_start`` (int, Column or one-row frame) overrides the first new id,
    for a ``base`` that is only part of the table.

    ``base_unique`` states that the base is unique on ``keys`` (a catalog
    built with keep-first on its key is); both sides of the refresh join are
    then unique and it needs no salting. With ``False`` hot base keys are
    salted.
    """
    keys, refresh = list(keys), list(refresh)
    order = list(order or keys)
    stg = keep_first(staging, keys, order)
    fresh = not_in_tuple(stg, base, keys, left_unique=True)
    start = id_start if id_start is not None else \
        base.agg((F.coalesce(F.max(id_col), F.lit(-1)) + 1).alias("_cl_start"))
    fresh = dense_ids(fresh.drop(id_col), order, id_col, start=start)
    upd = stg.select(*keys, *[F.col(c).alias(f"_cl_new_{c}") for c in refresh])
    if base_unique:
        merged = base.join(upd, keys, "left")
    else:
        merged = join_back(base, upd, keys, "left")
    for c in refresh:
        merged = merged.withColumn(c, F.coalesce(F.col(f"_cl_new_{c}"), F.col(c)))
    merged = merged.select(*base.columns)
    return merged.unionByName(fresh.select(*base.columns))
