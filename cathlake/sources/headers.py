"""Sparse header records -> fixed typed columns.

A header record is a ``map<string,string>`` of the attributes a file has
(here parsed from JSON object text). Each dictionary column is one
``element_at`` lookup, an absent attribute gives NULL, and the dictionary's
types are applied by ``conform``. Records that could not be read go to a
rejects frame instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cathlake.functions.schema import conform


def project_map(df: DataFrame, map_col: str, types: dict, keep=()) -> DataFrame:
    """``keep`` columns plus one typed column per dictionary entry, looked
    up in the map column (absent -> NULL)."""
    raw = df.select(*keep, *[F.element_at(F.col(map_col), F.lit(k)).alias(k) for k in types])
    return conform(raw, types, keep=keep)


def parse_json_records(df: DataFrame, text_col: str, out: str = "header") -> DataFrame:
    """JSON object text -> ``map<string,string>`` (NULL when unreadable)."""
    return df.withColumn(out, F.from_json(F.col(text_col), "map<string,string>"))


def split_rejects(df: DataFrame, map_col: str = "header"):
    """(readable records, unreadable records)."""
    ok = F.col(map_col).isNotNull()
    return df.where(ok), df.where(~ok)
