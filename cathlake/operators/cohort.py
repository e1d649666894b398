"""Cohort reports: every count the deployment report asks for in one pass.

``count_if`` per condition and ``count_distinct`` per column all sit in one
aggregation, so the table is scanned once. ``COUNT(DISTINCT (a, b))`` over a
row value counts rows with a NULL part (the row itself is not NULL), which
``count(DISTINCT a, b)`` would skip: it is written as a distinct count of a
struct.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cohort_report(df: DataFrame, modality: str = "Modality", patient: str = "PatientID",
                  study: str = "StudyInstanceUID", path: str = "DcmPathFlatten",
                  modalities: Sequence[str] = ("XA", "OT", "IVUS"), main: str = "XA",
                  approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row: total rows, rows per modality, non-NULL paths, distinct
    patients / (patient, study) pairs / paths overall and for ``main``.

    ``approx=True`` replaces the exact distinct counts by HyperLogLog
    sketches (relative standard deviation ``rsd``): fixed-size per task,
    merged without expanding the rows once per distinct count.
    """
    m = F.col(modality)

    def count_distinct(c):
        return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(m == F.lit(v)).alias(f"n_{v.lower()}") for v in modalities]
    aggs += [
        F.count(F.col(path)).alias("n_paths"),
        count_distinct(F.col(patient)).alias("n_patients"),
        count_distinct(F.struct(F.col(patient), F.col(study))).alias("n_studies"),
        count_distinct(F.col(path)).alias("n_loops"),
        count_distinct(F.when(m == F.lit(main), F.col(patient))).alias(f"n_patients_{main.lower()}"),
        count_distinct(F.when(m == F.lit(main), F.struct(F.col(patient), F.col(study))))
        .alias(f"n_studies_{main.lower()}"),
    ]
    return df.agg(*aggs)


def dup_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``GROUP BY keys HAVING count(*) > 1``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def funnel(df: DataFrame, stages: dict) -> DataFrame:
    """Validity funnel: one row with the count of rows passing each stage
    predicate (stages are cumulative: each includes the previous ones)."""
    aggs, acc = [], F.lit(True)
    for name, pred in stages.items():
        acc = acc & F.coalesce(pred, F.lit(False))
        aggs.append(F.count_if(acc).alias(name))
    return df.agg(*aggs)


def exclusion_report(all_rows: DataFrame, kept: DataFrame, path: str = "DcmPathFlatten",
                     patient: str = "PatientID") -> DataFrame:
    """Rows of ``all_rows`` whose path is ``NOT IN`` the kept table (SQL NULL
    rules), counted: ``n_excluded`` rows and ``n_patients_excluded``
    distinct patients, in one row."""
    from cathlake.operators.setjoin import not_in
    out = not_in(all_rows, kept, path)
    return out.agg(F.count(F.lit(1)).alias("n_excluded"),
                   F.count_distinct(F.col(patient)).alias("n_patients_excluded"))
