"""Procedure registry: long (one row per entry x site) to wide.

One grouped aggregation produces every measure x site column plus the
entry's first-row attributes (what a multi-measure ``pivot`` with explicit
values compiles to), so there is no per-measure pivot and no join of pivots:
one shuffle, partial aggregation on the map side, explicit site values (no
discovery job, no column for a NULL site).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.functions import normalize as N
from cathlake.functions.schema import conform
from cathlake.operators.numbering import dense_ids
from cathlake.operators.skew import join_back
from cathlake.session import checkpoint_dir


# The 16 coronary segment names used as registry site values, in
# the order of the wide table's columns (a pivot sorts them as text).
SITES = [
    "1 Prox RCA", "10 D2", "11 Prox LCX", "12 OM1", "13 Midt LCX", "14 OM2",
    "15 Distale LCX", "16 PLA fra RCA", "2 Midt RCA", "3 Distale RCA", "4 PDA",
    "5 LM", "6 Prox LAD", "7 Midt LAD", "8 Distale LAD", "9 D1",
]
# Wide-column prefixes for the three registry measures.
MEASURE_PREFIX = {"stenosegrad_eyeball": "Sten %: ", "ffr": "ffr %: ", "kartype": "kartype: "}


def pivot_measures(df: DataFrame, keys: Sequence[str], site: str, sites: Sequence,
                   measures: dict, reducer: str = "first",
                   order: Sequence[str] = (), attrs: Sequence[str] = ()) -> DataFrame:
    """Wide frame: one row per ``keys``; column ``prefix + str(site value)``
    for every measure (``measures`` maps column -> prefix) and site.

    ``reducer``: ``min`` / ``max`` of the values at (keys, site), or
    ``first`` = value of the first row in ``order`` (explicit, so the choice
    among duplicate (keys, site) rows is deterministic). ``attrs`` are taken
    from the entry's first row in ``order``. Rows with a NULL site only
    contribute attributes.
    """
    keys, order, attrs = list(keys), list(order), list(attrs)
    s = F.col(site)
    aggs = []
    if attrs:
        packed = F.struct(*[F.col(c).alias(f"_cl_o{i}") for i, c in enumerate(order)],
                          *[F.col(c) for c in attrs])
        aggs.append(F.min(packed).alias("_cl_attr"))
    for m, prefix in measures.items():
        for v in sites:
            hit = s == F.lit(v)
            name = f"{prefix}{v}"
            if reducer == "min":
                aggs.append(F.min(F.when(hit, F.col(m))).alias(name))
            elif reducer == "max":
                aggs.append(F.max(F.when(hit, F.col(m))).alias(name))
            elif reducer == "first":
                key = F.struct(*[F.col(c) for c in order], F.col(m).alias("_cl_v"))
                aggs.append(F.min(F.when(hit, key)).getField("_cl_v").alias(name))
            else:
                raise ValueError(reducer)
    wide = df.groupBy(*keys).agg(*aggs)
    if attrs:
        wide = wide.select(*keys, *[F.col(f"_cl_attr.{c}").alias(c) for c in attrs],
                           *[c for c in wide.columns if c not in keys and c != "_cl_attr"])
    return wide


def pivot_conflicts(df: DataFrame, keys: Sequence[str], site: str) -> DataFrame:
    """(keys, site) groups holding more than one row: where a strict
    long-to-wide pivot is ambiguous."""
    return (df.where(F.col(site).isNotNull()).groupBy(*keys, site)
            .agg(F.count("*").alias("n")).where(F.col("n") > 1))


def registry_wide(df: DataFrame, keys=("bth_pid", "entryid", "procedurestart_lokalbed_velse"),
                  site="proceduresite", sub="sub_entryid", start="procedurestart_lokalbed_velse",
                  mode: str = "entry", sites: Sequence = SITES, order: Sequence[str] = (),
                  strict: bool = False) -> DataFrame:
    """Registry pivot: rows without a procedure start dropped, measures
    ``Sten %: <site>``, ``ffr %: <site>`` (numbers) and ``kartype: <site>``
    (text), the other columns together from one row of the whole entry: the
    first in ``order`` (columns that give the file's row order; they are not
    attributes), ties and no order by the attributes themselves; start renamed
    ``timestamp`` and parsed strictly.

    Level 1 is one pivot row per sub-entry (duplicate (sub-entry, site)
    rows, which a strict pivot rejects, reduce to their smallest value; see
    ``pivot_conflicts``). ``mode="entry"``: one row per entry, the whole
    pivot row of its smallest sub-entry (string order). ``mode="sub_entry"``:
    one row per sub-entry where, as in the original merge, the ``Sten`` and
    ``ffr`` columns come from the entry's smallest sub-entry and ``kartype``
    from the sub-entry itself. ``strict`` fails on a (sub-entry, site) with more
    than one row and names it, from counts in the pivot's own aggregate.
    """
    keys = list(keys)
    base = df.where(F.col(start).isNotNull())
    attrs = [c for c in df.columns
             if c not in keys and c not in (site, sub, *order) and c not in MEASURE_PREFIX]
    first_row = F.struct(*[F.col(c).alias(f"_cl_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in attrs])
    s = F.col(site)
    place = F.coalesce(*[F.when(s == F.lit(v), F.lit(i)) for i, v in enumerate(sites)])
    # One narrow row per site first: the site columns are spread out in the rows of the result only.
    cells = base.groupBy(*keys, sub, site).agg(
        F.min(first_row).alias("_cl_attr"), *[F.min(m).alias(m) for m in MEASURE_PREFIX],
        F.count(F.lit(1)).alias("_cl_n")).withColumn("_cl_i", place)
    # Sten / ffr are numbers in the wide table (kartype stays text).
    values = [F.col(m) if m == "kartype" else N.to_double(F.col(m)).alias(m) for m in MEASURE_PREFIX]
    cell = F.struct("_cl_i", *values, *["_cl_n"] * strict)
    # A sub-entry's list holds at most one cell per known site.
    level1 = cells.groupBy(*keys, sub).agg(
        F.min("_cl_attr").alias("_cl_attr"), F.collect_list(F.when(F.col("_cl_i").isNotNull(), cell)).alias("_cl_cells"))
    if strict:
        names = F.array(*[F.lit(str(v)) for v in sites])
        repeated = F.transform(F.filter(F.array_sort("_cl_cells"), lambda c: c["_cl_n"] > 1), lambda c: F.get(names, c["_cl_i"]))
        told = F.concat(F.lit("several rows for "), F.to_json(F.struct(*keys, sub, repeated.alias("sites"))))
        checked = F.when(F.size(repeated) > 0, F.raise_error(told).cast("string")).otherwise(F.col(sub))
        # Every later step needs the sub-entry, so none can leave the check out.
        level1 = level1.withColumn(sub, checked)

    if mode == "sub_entry":
        checkpoint_dir(df.sparkSession)
        level1 = level1.checkpoint()  # read twice below

    def by_site(cells_col: str):
        return F.map_from_entries(F.transform(cells_col, lambda c: F.struct(c["_cl_i"], c)))

    def spread(by: str, *measures: str):
        return [F.element_at(by, F.lit(i)).getField(m).alias(f"{MEASURE_PREFIX[m]}{v}") for m in measures for i, v in enumerate(sites)]

    first = level1.groupBy(*keys).agg(F.min("_cl_attr").alias("_cl_attr"), F.min(F.struct(sub, "_cl_cells")).alias("_cl_r"))
    first = first.select(*keys, "_cl_attr", F.col("_cl_r._cl_cells").alias("_cl_first"))
    attributes = [F.col(f"_cl_attr.{a}").alias(a) for a in attrs]
    if mode == "entry":
        wide = first.withColumn("_cl_at", by_site("_cl_first")).select(*keys, *attributes, *spread("_cl_at", *MEASURE_PREFIX))
    elif mode == "sub_entry":
        j = join_back(level1.select(*keys, sub, "_cl_cells"), first, keys, "inner", null_safe=True)
        j = j.withColumn("_cl_at", by_site("_cl_first")).withColumn("_cl_own", by_site("_cl_cells"))
        wide = j.select(*keys, sub, *attributes, *spread("_cl_at", "stenosegrad_eyeball", "ffr"), *spread("_cl_own", "kartype"))
    else:
        raise ValueError(mode)
    return (wide.withColumnRenamed(start, "timestamp")
            .withColumn("timestamp", F.to_timestamp_ntz(F.col("timestamp"))))


def registry_types(attrs: Sequence[str], named: dict | None = None, sites: Sequence = SITES,
                   keys: dict | None = None) -> dict:
    """Type dictionary of the wide table: ``rowid``, the keys, ``timestamp``, the attributes in
    their order (SQL types by name in ``named``, else text), then the measures of all sites."""
    types = {"rowid": "BIGINT PRIMARY KEY", **(keys or {"bth_pid": "varchar(255)", "entryid": "int8"}), "timestamp": "TIMESTAMP"}
    for c in attrs:
        types.setdefault(c, (named or {}).get(c, "varchar(255)"))
    for m, prefix in MEASURE_PREFIX.items():
        for v in sites:
            types[f"{prefix}{v}"] = "varchar(255)" if m == "kartype" else "float8"
    return types


def typed_registry(wide: DataFrame, named: dict | None = None, order: Sequence[str] = ("bth_pid", "entryid", "timestamp"),
                   keys: dict | None = None) -> DataFrame:
    """The wide table as it is loaded: ids from 0 in ``order`` and every column typed by
    ``registry_types`` (text that does not fit its type is NULL)."""
    measures = tuple(MEASURE_PREFIX.values())
    types = registry_types([c for c in wide.columns if not c.startswith(measures) and c not in ("rowid", "timestamp")], named, keys=keys)
    loaded = conform(dense_ids(wide, list(order), "rowid"), {c: t for c, t in types.items() if c in wide.columns or c == "rowid"})
    return loaded


def cardinality_profile(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: how many distinct per-group distinct-counts it has, and
    whether that is more than one (the column varies inside some groups but
    not others). Groups with a NULL key part do not count."""
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    named = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    text = df.where(named).select(*keys, *[F.col(c).cast("string").alias(c) for c in cols])
    # One narrow row per value instead of one wide row per counted column; its column is told by one character before
    # the value, and the value by another before its text, so that null and the empty text differ.
    tagged = [F.concat(F.lit(chr(i + 1)), F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))) for i, c in enumerate(cols)]
    values = text.select(*[F.col(k).alias(f"_cl_k{i}") for i, k in enumerate(keys)], F.explode(F.array(*tagged)).alias("_cl_v")).distinct()
    by = [f"_cl_k{i}" for i in range(len(keys))]
    per_group = values.groupBy(*by, F.ascii("_cl_v").alias("_cl_i")).agg(F.count_if(F.length("_cl_v") > 1).alias("n"))
    long = per_group.groupBy("_cl_i").agg(F.count_distinct("n").cast("long").alias("distinct_counts"))
    names = F.array(*[F.lit(c) for c in cols])
    return long.select(F.get(names, F.col("_cl_i") - 1).alias("column"), "distinct_counts", (F.col("distinct_counts") != 1).alias("multi_entry"))
