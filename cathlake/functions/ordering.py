"""Order keys that make "rank by time, NULLs last" a plain comparison.

Ranking a row inside its group and comparing two ranks is the same as
comparing the ordering values themselves, with NULL placed after every value
(the PostgreSQL default for ascending order). Mapping the ordering column to a
non-null ``long`` lets min/max aggregates stay in Spark's fixed-width hash
aggregate (a struct key would fall back to sort-based aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, IntegralType,
                               TimestampNTZType, TimestampType)

# Fixed value: NULL orders after all values, so it maps to the largest long.
NULL_LAST = 9223372036854775807


def to_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_micros(c) -> Column:
    """Microseconds since 1970-01-01 00:00 of a ``timestamp_ntz`` wall-clock
    value, built from its date and time fields, so it does not depend on the
    session time zone (a cast to ``timestamp`` would shift wall-clock times
    that fall in a daylight-saving gap)."""
    col = to_col(c)
    return (F.unix_date(F.to_date(col)).cast("long") * 86_400_000_000
            + F.hour(col).cast("long") * 3_600_000_000
            + F.minute(col).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("long"))


def micros(df, c: str) -> Column:
    """Microseconds of a timestamp column of either kind (instants for
    ``timestamp``, wall-clock for ``timestamp_ntz``)."""
    if isinstance(df.schema[c].dataType, TimestampNTZType):
        return ntz_micros(c)
    return F.unix_micros(F.col(c))


def order_key(c, dtype: DataType | None = None) -> Column:
    """``long`` key with the same ascending order as ``c``, NULL last.

    Timestamps become microseconds, dates days; integral columns are used as
    they are. Other types have no such key and are refused. A real value equal
    to the largest long would tie with NULL.
    """
    col = to_col(c)
    if isinstance(dtype, TimestampNTZType):
        v = ntz_micros(col)
    elif isinstance(dtype, TimestampType):
        v = F.unix_micros(col)
    elif isinstance(dtype, DateType):
        v = F.unix_date(col).cast("long")
    elif dtype is None or isinstance(dtype, (IntegralType, BooleanType)):
        v = col.cast("long")
    else:
        raise TypeError(f"no order key for {dtype.simpleString()}: use a time, date or integer column")
    return F.coalesce(v, F.lit(NULL_LAST))


def key_for(df, c) -> Column:
    """``order_key`` for a named column of ``df`` (type looked up)."""
    if isinstance(c, str):
        return order_key(c, df.schema[c].dataType)
    return order_key(c, df.select(c).schema.fields[0].dataType)
