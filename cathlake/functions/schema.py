"""Type dictionaries (column -> SQL type text) turned into Spark schemas.

The catalog is described by one ordered dictionary; everything downstream
(table DDL, which header attributes are extracted, which normaliser runs on
a column, final column order) is derived from it. SQL type text maps to a
Spark type by prefix, checked in a fixed order so that ``TEXT []`` wins over
``TEXT`` and ``TIMESTAMP`` over ``time``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

from cathlake.functions import normalize as N

# SQL type prefix (lower case) -> Spark type, in match order.
TYPE_PREFIX = [
    ("serial", "bigint"), ("bigint", "bigint"), ("int8", "bigint"), ("float8", "double"),
    ("text []", "array<string>"), ("text", "string"), ("varchar", "string"),
    ("boolean", "boolean"), ("timestamp", "timestamp_ntz"), ("time", "string"),
]

# The catalog's named (non-segment) columns and their SQL types,
# in table order.
CATALOG_HEAD = {
    "rowid": "serial PRIMARY KEY", "DcmPathFlatten": "varchar(255)", "phase": "varchar(255)",
    "SeriesDate": "varchar (255)", "StudyDate": "varchar (255)", "TimeStamp": "TIMESTAMP",
    "DateStamp": "varchar(255)", "StudyTime": "time", "SeriesTime": "time",
    "BodyPartExamined": "varchar(255)", "Modality": "varchar(255)", "PatientID": "varchar(255)",
    "PatientSex": "varchar(255)", "StudyInstanceUID": "varchar(255)",
    "SeriesInstanceUID": "varchar(255)", "SOPInstanceUID": "varchar(255)",
    "SOPClassUID": "varchar(255)", "StudyDescription": "varchar(255)",
    "SeriesDescription": "varchar(255)", "AcquisitionDate": "varchar(255)",
    "ProtocolName": "varchar(255)", "PatientAddress": "varchar(255)",
    "AccessionNumber": "varchar(255)", "AdditionalPatientHistory": "varchar(255)",
    "Manufacturer": "varchar(255)", "InstitutionalName": "varchar(255)",
    "NumberOfFrames": "int8", "FrameIncrementPointer": "varchar(255)", "FrameTime": "float8",
    "PositionerMotion": "varchar(255)", "DistanceSourceToPatient": "float8",
    "DistanceSourceToDetector": "float8", "PositionerPrimaryAngle": "float8",
    "PositionerSecondaryAngle": "float8", "CineRate": "float8", "labels": "int8",
    "labels_transformed": "int8", "predictions": "int8", "confidences": "TEXT []",
    "labels_predictions": "int8", "labels_confidences": "varchar(255)",
    "labels_transformed_predictions": "int8", "duration_transformed": "int8",
    "labels_transformed_confidences": "varchar(255)", "diagnostic_data": "BOOLEAN",
}
CATALOG_TAIL = {"kommentar": "varchar(255)", "text_raw": "varchar(225)"}
# Coronary segment slugs used in catalog column names.
SEGMENTS = ["1_prox_rca", "2_midt_rca", "3_dist_rca", "4_pda", "5_lm", "6_prox_lad",
            "7_midt_lad", "8_dist_lad", "9_d1", "10_d2", "11_prox_lcx", "12_om1",
            "13_midt_lcx", "14_om2", "15_dist_lcx", "16_pla_rca"]


def catalog_types() -> dict:
    """The full image-catalog dictionary: named head, then per measure
    (sten, ffr) and suffix the 16 segment columns, then the tail."""
    types = dict(CATALOG_HEAD)
    for m in ("sten", "ffr"):
        for suffix, t in (("_transformed", "float8"), ("_transformed_predictions", "float8"),
                          ("_transformed_confidences", "varchar(255)")):
            for seg in SEGMENTS:
                types[f"{m}_proc_{seg}{suffix}"] = t
    types.update(CATALOG_TAIL)
    return types


def spark_type(sql_type: str) -> str:
    t = sql_type.strip().lower()
    for prefix, st in TYPE_PREFIX:
        if t.startswith(prefix):
            return st
    raise ValueError(f"no Spark type for {sql_type!r}")


_TYPES = {"bigint": LongType(), "double": DoubleType(), "string": StringType(),
          "array<string>": ArrayType(StringType()), "boolean": BooleanType(),
          "timestamp_ntz": TimestampNTZType()}


def to_struct(types: dict) -> StructType:
    return StructType([StructField(c, _TYPES[spark_type(t)], True) for c, t in types.items()])


def _convert(col: Column, src: str, dst: str, sql_type: str) -> Column:
    if src == dst and dst != "string":
        return col
    if dst == "bigint":
        return N.to_long(col.cast("string")) if src == "string" else col.try_cast("bigint")
    if dst == "double":
        return N.to_double(col) if src == "string" else col.try_cast("double")
    if dst == "string":
        s = col.cast("string")
        if sql_type.strip().lower().startswith("time"):
            return N.time_text(N.null_tokens(s))
        return N.clean_text(N.null_tokens(s))
    if dst == "timestamp_ntz":
        return N.null_tokens(col.cast("string")).try_cast("timestamp_ntz") if src == "string" \
            else col.cast("timestamp_ntz")
    if dst == "boolean":
        return N.null_tokens(col.cast("string")).try_cast("boolean") if src == "string" \
            else col.cast("boolean")
    if dst == "array<string>":
        return col if src.startswith("array") else F.array(col.cast("string"))
    return col.try_cast(dst)


def conform(df: DataFrame, types: dict, keep=()) -> DataFrame:
    """Project ``df`` onto the dictionary: dictionary order, every column
    converted to its type by the type-driven normalisers (bad values ->
    NULL), missing columns NULL, other columns dropped except ``keep``
    (placed first)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = [F.col(c) for c in keep]
    for c, t in types.items():
        st = spark_type(t)
        if c in have:
            out.append(_convert(F.col(c), have[c], st, t).cast(st).alias(c))
        else:
            out.append(F.lit(None).cast(st).alias(c))
    return df.select(*out)


def lost_values(df: DataFrame, types: dict) -> dict[str, Column]:
    """By column of the dictionary, whether ``conform`` turns a row's value into NULL
    although it is not missing."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    lost = {}
    for c in types:
        if c in have:
            text = F.col(c) if have[c].startswith("array") else N.null_tokens(F.col(c).cast("string"))
            made = _convert(F.col(c), have[c], spark_type(types[c]), types[c])
            lost[c] = text.isNotNull() & made.isNull()
    return lost


def conform_rejects(df: DataFrame, types: dict) -> DataFrame:
    """(column, rejected): how many values ``conform`` loses, one pass. See
    ``sources.permissive.load_counted`` for counts out of the writing pass."""
    lost = lost_values(df, types)
    return df.agg(*[F.count_if(x).alias(c) for c, x in lost.items()]).unpivot([], list(lost), "column", "rejected")


def create_table_sql(name: str, types: dict, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` DDL (Parquet) for the dictionary,
    optionally at an explicit ``location``."""
    cols = ", ".join(f"`{c}` {spark_type(t).upper()}" for c, t in types.items())
    loc = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}"
