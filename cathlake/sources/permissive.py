"""Typed loads that tell what they had to leave out.

* ``read_records``: CSV / TSV with a listed header; a line whose cells do not
  fit the header goes to a rejects frame with its text, not to an error.
* ``load_counted``: a frame is conformed to a type dictionary and written; how
  many values of each column became NULL although they were not missing is
  counted by an ``Observation`` in the writing pass itself, so there is no
  second scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cathlake.functions import normalize as N
from cathlake.functions.schema import conform, lost_values
from cathlake.sources.readers import CSV_FORM

BAD = "_bad_record"


def read_records(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str = ",",
                 missing: Sequence[str] | None = N.READER_NULLS) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files with a header of ``columns``, all strings.

    A record with more or fewer cells than the header is rejected: rejects
    hold its text in ``record``, the cells that were read in ``cells`` and its
    file in ``path``. Tokens of ``missing`` read as NULL.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + f", `{BAD}` string"
    raw = (spark.read.schema(schema).options(**CSV_FORM).option("header", True).option("enforceSchema", False)
           .option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).csv(paths))
    rows = raw.where(F.col(BAD).isNull()).select(
        *[N.null_tokens(F.col(f"`{c}`"), missing).alias(c) if missing else F.col(f"`{c}`") for c in columns])
    # The cells that were read are named too: a scan of the record text alone is not allowed.
    cells = F.array(*[F.col(f"`{c}`") for c in columns])
    rejects = raw.where(F.col(BAD).isNotNull()).select(F.col(BAD).alias("record"), cells.alias("cells"), F.input_file_name().alias("path"))
    return rows, rejects


def observed(df: DataFrame, types: dict, name: str = "rejected") -> tuple[DataFrame, Observation]:
    """``df`` conformed to ``types``, and an observation of ``rows`` and, by column, the
    values lost. It is filled by the first action on the result."""
    seen = Observation(name)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(x).alias(c) for c, x in lost_values(df, types).items()])
    return conform(watched, types), seen


def load_counted(df: DataFrame, types: dict, path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` conformed to ``types`` at ``path``. Returns the table read back and
    (column, rows, rejected) counted while writing."""
    spark = df.sparkSession
    out, seen = observed(df, types)
    out.write.mode("errorifexists").parquet(path)
    counts = dict(seen.get)
    rows = counts.pop("rows")
    found = [(c, rows, n) for c, n in counts.items()]
    return spark.read.parquet(path), spark.createDataFrame(found, "column string, rows long, rejected long")
