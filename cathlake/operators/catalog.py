"""Catalog-level jobs with the catalog's own column names: build from header
records (K1), link to the procedure registry (K4), repair patient ids from
paths (K9). They compose the generic operators of this package.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.functions import normalize as N
from cathlake.functions import paths as P
from cathlake.functions.schema import catalog_types, conform
from cathlake.operators.linkage import link_window
from cathlake.operators.numbering import dense_ids, keep_first

KEY4 = ["PatientID", "StudyInstanceUID", "SeriesInstanceUID", "SOPInstanceUID"]


def build_catalog(records: DataFrame, types: dict | None = None, base_folder: str | None = None,
                  path_col: str = "path", header_col: str = "header",
                  date_col: str = "StudyDate", time_col: str = "SeriesTime"):
    """Header records -> typed catalog. Returns ``(catalog, rejects)``.

    ``records`` holds one row per file: its path and a ``map<string,string>``
    of header attributes (NULL when the file could not be read).
    * ``DcmPathFlatten`` = path from the first match of ``base_folder`` on
      (records whose path does not contain it are rejected), else the path;
    * dictionary attributes are looked up in the map (absent -> NULL);
    * ``TimeStamp`` = ``date_col`` + ``time_col`` (coerced, bad -> NULL),
      ``DateStamp`` = the date text ('0' when missing), ``SeriesTime`` =
      its first 6 characters ('000000' when missing);
    * one row per 4-part key, the first by path;
    * columns converted by type and put in dictionary order; ``rowid`` =
      dense ids in path order.
    """
    types = types or catalog_types()
    readable = F.col(header_col).isNotNull()
    if base_folder:
        rel = P.relative_to(path_col, base_folder)
        readable = readable & rel.isNotNull()
    else:
        rel = F.col(path_col)
    rejects = records.where(~readable)
    ok = records.where(readable)
    attrs = [c for c in types if c not in ("rowid", "DcmPathFlatten", "TimeStamp", "DateStamp")]
    raw = ok.select(rel.alias("DcmPathFlatten"),
                    *[F.element_at(F.col(header_col), F.lit(c)).alias(c) for c in attrs])
    dcol, tcol = N.null_tokens(date_col), N.null_tokens(time_col)
    raw = (raw.withColumn("TimeStamp", N.combine_ts(dcol, tcol))
              .withColumn("DateStamp", F.coalesce(dcol, F.lit("0")))
              .withColumn(time_col, N.time_prefix(tcol)))
    first = keep_first(raw, KEY4, ["DcmPathFlatten"])
    typed = conform(first, {c: t for c, t in types.items() if c != "rowid"})
    with_ids = dense_ids(typed, ["DcmPathFlatten"], "rowid")
    return with_ids.select(*[c for c in types]), rejects


def inventory_stages(spark, root: str, stage_dir: str | None = None, header_only: bool = True):
    """The inventory steps before a build: every file below ``root``, those
    whose header carries the image marker, and the funnel counts
    (``n_candidates``, ``n_valid``). With ``stage_dir`` each stage list is
    stored as a table there and re-read on a rerun (resumable).
    Returns ``(valid_paths, funnel)``; the funnel also counts files that could
    not be read (``n_unreadable``), which ``inventory_rejects`` lists."""
    from cathlake.sources import files

    def listed():
        return files.inventory(spark, root)

    def flagged():
        base = files.staged(spark, f"{stage_dir}/candidates", listed) if stage_dir else listed()
        return files.header_flags(base) if header_only else files.with_header_flag(spark, root)

    checked = files.staged(spark, f"{stage_dir}/checked", flagged) if stage_dir else flagged()
    counts = checked.agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if("valid").alias("n_valid"),
                         F.count_if(F.col("error").isNotNull()).alias("n_unreadable"))
    return checked.where(F.col("valid")).select("path", "length", "modificationTime"), counts


def inventory_rejects(spark, stage_dir: str) -> DataFrame:
    """Files that an ``inventory_stages`` run with this ``stage_dir`` could not read, with the
    reason (path, length, modificationTime, error)."""
    from cathlake.sources import files

    checked = spark.read.parquet(f"{stage_dir}/checked")
    return files.unreadable(checked).select("path", "length", "modificationTime", "error")


def link_procedures(catalog: DataFrame, registry: DataFrame, hours: float = 6.0,
                    registry_id: str = "rowid", unique_images: bool = False,
                    view: str | None = None) -> DataFrame:
    """Each image (``PatientID``, ``DcmPathFlatten``) with its nearest
    procedure of the same patient (``bth_pid``) within +-``hours`` of
    ``TimeStamp`` vs the registry's ``timestamp``, or NULLs. Image columns
    come first (patient and path leading), then the registry's columns
    without its id; names present on both sides get a ``pats_`` prefix. With
    ``view`` the result is also registered as a temporary view of that name."""
    lid = ["PatientID", "DcmPathFlatten"]
    ordered = catalog.select(*lid, *[c for c in catalog.columns if c not in lid])
    rcols = [c for c in registry.columns if c != registry_id]
    out = link_window(ordered, registry, "PatientID", "bth_pid", "TimeStamp", "timestamp",
                      registry_id, lid=lid, hours=hours, rcols=rcols, unique_left=unique_images)
    if view:
        out.createOrReplaceTempView(view)
    return out


def repair_patient_id(catalog: DataFrame, marker: str = "/DICOM",
                      patient: str = "PatientID", path: str = "DcmPathFlatten") -> DataFrame:
    """``PatientID`` taken from the folder above ``marker`` in the path,
    where the path contains it; other rows unchanged."""
    return catalog.withColumn(patient, P.repair_key(patient, path, marker))


def preview_patient_repair(catalog: DataFrame, n: int = 10, marker: str = "/DICOM",
                           patient: str = "PatientID", path: str = "DcmPathFlatten") -> DataFrame:
    """The first ``n`` rows (by path) the repair would change, old and new id
    side by side, without changing anything."""
    new = P.parent_of(path, marker)
    hit = catalog.where(F.col(path).contains(marker))
    return (hit.select(path, F.col(patient).alias("old_id"), new.alias("new_id"))
            .orderBy(path).limit(n))


def assign_test_phase(catalog: DataFrame, cohort: DataFrame, id_col: str = "PatientID") -> DataFrame:
    """``phase = 'test'`` for images of patients on the cohort list."""
    from cathlake.operators.labels import assign_phase
    return assign_phase(catalog, cohort, key="PatientID", id_col=id_col)


__all__: Sequence[str] = ["inventory_stages", "inventory_rejects", "build_catalog", "link_procedures", "repair_patient_id",
                          "preview_patient_repair", "assign_test_phase"]
