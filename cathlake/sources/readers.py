"""Text sources read without type inference (every column a string), the
cohort id list, and SQL over registered tables."""

from __future__ import annotations

import warnings
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cathlake.functions import normalize as N

# Quotes inside a quoted cell are doubled; a quoted cell may hold line breaks.
CSV_FORM = {"quote": '"', "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False, "maxCharsPerColumn": -1}


def read_strings(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", header: bool = True,
                 missing: Sequence[str] | None = N.READER_NULLS) -> DataFrame:
    """CSV / TSV files with a header, all columns strings; cells as ``CSV_FORM``
    has them, and those that hold a token of ``missing`` read as NULL. Several
    files with the same header are read as one frame (their concatenation).

    A cell may hold line breaks, so a file is read by one task: tables of many
    rows should come as many files, as ``sinks.write_csv`` writes them.
    """
    raw = (spark.read.options(**CSV_FORM).option("header", header).option("inferSchema", False)
           .option("sep", sep).csv(paths))
    if not missing:
        return raw
    return raw.select(*[N.null_tokens(F.col(f"`{c}`"), missing).alias(c) for c in raw.columns])


def read_tsv(spark: SparkSession, paths, header: bool = True, missing: Sequence[str] | None = N.READER_NULLS) -> DataFrame:
    return read_strings(spark, paths, sep="\t", header=header, missing=missing)


def read_path_list(spark: SparkSession, path: str, name: str = "path") -> DataFrame:
    """Headerless one-column list of file paths."""
    return spark.read.schema(f"`{name}` string").options(**CSV_FORM).option("header", False).csv(path)


def read_id_list(spark: SparkSession, path: str, column: str = "PatientID") -> DataFrame:
    """The cohort list: one id column of a header CSV, as strings, distinct,
    NULLs dropped."""
    return (read_strings(spark, path).select(F.col(column).alias(column))
            .where(F.col(column).isNotNull()).distinct())


def sql_source(spark: SparkSession, query: str, tables: dict | None = None,
               warn_empty: bool = False) -> DataFrame:
    """Run ``query`` over the session catalog; ``tables`` (name -> DataFrame)
    are registered as temporary views first. ``warn_empty`` warns when the
    result has no rows (reads at most one)."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    out = spark.sql(query)
    if warn_empty and is_empty(out):
        warnings.warn(f"no rows: {query}", stacklevel=2)
    return out


def is_empty(df: DataFrame) -> bool:
    """True when the frame has no rows (reads at most one row)."""
    return df.isEmpty()
