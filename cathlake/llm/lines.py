"""Line dedup by distinct-site spread.

A line's spread is the number of distinct sites (column ``source``) that it
occurs on. Every (line hash, site) occurrence feeds a HyperLogLog sketch per
line hash; sketches merge on the map side and again after the shuffle. A line
whose estimate lies within ``MARGIN`` of the threshold gets its exact distinct
count; the others are decided by the estimate. A line that reaches the
threshold is cross-site boilerplate and is removed everywhere but at its first
occurrence (smallest document key, then position), so that one copy of every
text stays in the corpus.

Lines are compared after trimming; lines without a word are kept as they are.

Defined results: a null text stays null; a null site counts as one site of
its own; a document whose lines all go keeps the empty text; rows with equal
doc_id and text are one document and stay equal; an empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, materialize, packed, row_key, whole_text
from .quality import SPACE

MIN_SITES = 5    # sites from which a line is boilerplate
MARGIN = 0.25    # relative distance from the threshold that asks for exact counts
SKETCH_BITS = 10  # 2^10 registers: about 3 per cent standard error


def line_hash(line: Column) -> Column:
    """128-bit hash of a trimmed line."""
    return F.unhex(F.md5(F.btrim(line, F.lit(SPACE))))


def occurrences(keyed: DataFrame) -> DataFrame:
    """(hash, key, pos, site) for every line with a word. ``keyed`` has _cl_key, _cl_text, _cl_site."""
    lines = F.posexplode(F.split(F.col("_cl_text"), "\n")).alias("pos", "line")
    return (keyed.select("_cl_key", "_cl_site", lines)
            .where(F.length(F.btrim("line", F.lit(SPACE))) > 0)
            .select(line_hash(F.col("line")).alias("hash"), F.col("_cl_key").alias("key"), "pos",
                    F.col("_cl_site").alias("site")))


def boilerplate(occ: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(hash, first) of the lines found on ``min_sites`` sites or more."""
    low, high = min_sites * (1 - MARGIN), min_sites * (1 + MARGIN)
    spread = occ.groupBy("hash").agg(
        F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"), F.count(F.lit(1)).alias("n"),
        F.min(F.struct("key", "pos")).alias("first"))
    # A line cannot be on more sites than it has occurrences.
    spread = spread.where(F.col("n") >= min_sites).select(
        "hash", "first", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= low)
    spread = materialize(spread, "spread")
    near = spread.where(F.col("estimate") <= high)
    # Exact counts of near-threshold lines: their (line, site) pairs, without repeats, then a count.
    pairs = occ.select("hash", "site").join(near.select("hash"), "hash", "left_semi").distinct()
    exact = pairs.groupBy("hash").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    far = spread.where(F.col("estimate") > high).select("hash", "first")
    return far.unionByName(near.join(exact.select("hash"), "hash", "left_semi").select("hash", "first"))


def dedup(docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id",
          min_sites: int = MIN_SITES) -> DataFrame:
    """``_cl_row`` of every document with ``_cl_clean`` (text without boilerplate) and ``_cl_removed`` (lines)."""
    keyed = packed(docs).withColumn("_cl_text", whole_text(field(text)))
    keyed = keyed.withColumn("_cl_key", row_key(field(doc_id), F.col("_cl_text")))
    occ = occurrences(keyed.select("_cl_key", "_cl_text", F.coalesce(field(site).cast("string"), F.lit("\x00")).alias("_cl_site")))
    found = materialize(boilerplate(occ, min_sites), "boilerplate")
    # One row per occurrence of boilerplate, then one per document; a document's list is bounded by its lines.
    hit = occ.select("hash", "key", "pos").join(found, "hash").where(F.struct("key", "pos") != F.col("first"))
    drop = materialize(hit.groupBy("key").agg(F.collect_set("pos").alias("_cl_drop")), "drop")
    out = keyed.join(drop.withColumnRenamed("key", "_cl_key"), "_cl_key", "left")
    lines = F.split(F.col("_cl_text"), "\n")
    # Dropped positions are sorted; the kept lines are the runs between them.
    edges = F.concat(F.array(F.lit(-1)), F.sort_array("_cl_drop"), F.array(F.size(lines)))
    runs = F.transform(F.sequence(F.lit(0), F.size("_cl_drop")), lambda i: F.slice(
        F.col("_cl_lines"), F.get(F.col("_cl_edges"), i) + 2,
        F.get(F.col("_cl_edges"), i + 1) - F.get(F.col("_cl_edges"), i) - 1))
    cut = out.withColumn("_cl_lines", F.when(F.col("_cl_drop").isNotNull(), lines)) \
        .withColumn("_cl_edges", F.when(F.col("_cl_drop").isNotNull(), edges))
    return cut.select(
        ROW, F.when(F.col("_cl_drop").isNull(), field(text)).otherwise(F.array_join(F.flatten(runs), "\n")).alias("_cl_clean"),
        F.when(F.col("_cl_drop").isNull(), 0).otherwise(F.size("_cl_drop")).cast("bigint").alias("_cl_removed"))


def clean(docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id",
          min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text; all other columns as they were."""
    out = dedup(docs, text, site, doc_id, min_sites)
    return out.select(*[F.col("_cl_clean").alias(c) if c == text else field(c).alias(c) for c in docs.columns])
