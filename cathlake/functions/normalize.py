"""Column -> Column normalisers for header text (all JVM-side built-ins).

Fixed behaviours that must match the original loaders:
* padding never truncates (Spark's ``lpad``/``rpad`` would cut a longer
  value, so the target width is ``greatest(n, length)``);
* number text becomes an integer by truncation through a double
  (``'3.0'`` -> 3, ``'12.7'`` -> 12), bad text -> NULL instead of an error;
* a carriage return becomes the letter ``r`` and backslashes are deleted;
* date + time text combine into a timestamp with bad or all-zero parts ->
  NULL (the fraction of a second is dropped).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cathlake.functions.ordering import to_col

# Cells that the original reader takes as missing.
READER_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                "NULL", "NaN", "None", "n/a", "nan", "null")
# Text tokens that stand for a missing value, in cells and in header text.
NULL_TOKENS = (*READER_NULLS, "NaT", "None00")


def null_tokens(c, tokens=NULL_TOKENS) -> Column:
    """NULL when the text is one of the missing-value tokens."""
    col = to_col(c)
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def pad_left(c, n: int, ch: str = "0") -> Column:
    """Left-pad to at least ``n`` characters; longer values stay whole."""
    col = to_col(c)
    return F.lpad(col, F.greatest(F.lit(n), F.length(col)), F.lit(ch))


def pad_right(c, n: int, ch: str = "0") -> Column:
    """Right-pad to at least ``n`` characters; longer values stay whole."""
    col = to_col(c)
    return F.rpad(col, F.greatest(F.lit(n), F.length(col)), F.lit(ch))


def time_text(c) -> Column:
    """Stored time text: right-pad to 6 with zeros, then the first 8
    characters (``'9'`` -> ``'900000'``, ``'093015.123'`` -> ``'093015.1'``)."""
    return F.substring(pad_right(c, 6), 1, 8)


def time_prefix(c) -> Column:
    """First 6 characters of the time; missing or empty -> ``'000000'``."""
    col = to_col(c)
    return F.substring(F.coalesce(F.nullif(col, F.lit("")), F.lit("000000")), 1, 6)


def to_double(c) -> Column:
    """Number text -> double; missing tokens and bad text -> NULL."""
    return null_tokens(c).try_cast("double")


def to_long(c) -> Column:
    """Number text -> long by truncation through a double (``'3.0'`` -> 3)."""
    return null_tokens(c).try_cast("double").try_cast("long")


def digits(c, n: int) -> Column:
    """Number text -> integer digits, zero-padded to ``n`` (no truncation);
    missing -> ``0`` padded."""
    v = F.coalesce(to_long(c), F.lit(0))
    return pad_left(v.cast("string"), n)


def combine_ts(date_c, time_c) -> Column:
    """``YYYYMMDD`` date text + ``HHMMSS[.f]`` time text -> timestamp_ntz.

    Both parts go through number -> integer text (so ``'20200101.0'`` and
    ``'93015.5'`` are accepted), are zero-padded to 8 / 6, and parsed with
    ``yyyyMMddHHmmss``; an impossible date or time, or a missing date
    (all zeros) gives NULL.
    """
    s = F.concat(digits(date_c, 8), digits(time_c, 6))
    fmt = F.lit("yyyyMMddHHmmss")
    # try_to_timestamp only validates; the value is parsed as wall-clock
    # time, so no session time zone can move it.
    return F.when(F.try_to_timestamp(s, fmt).isNotNull(), F.to_timestamp_ntz(s, fmt))


def parse_ts_strict(c, fmt: str | None = None) -> Column:
    """Strict timestamp parse (raises on bad input under ANSI mode)."""
    col = to_col(c)
    return F.to_timestamp_ntz(col, F.lit(fmt)) if fmt else F.to_timestamp_ntz(col)


def clean_text(c) -> Column:
    """Carriage return -> ``r``; backslash removed."""
    return F.translate(to_col(c), "\r\\", "r")


def export_text(c) -> Column:
    """Text for a ``|``-separated bulk export: missing tokens and NULL ->
    ``\\N``, newline -> the two characters ``\\n``."""
    col = null_tokens(c, ("None", "NaT"))
    return F.coalesce(F.replace(col, F.lit("\n"), F.lit("\\n")), F.lit("\\N"))


def valid_utf8(c) -> Column:
    """Replace invalid UTF-8 byte sequences (binary input) with U+FFFD."""
    return F.make_valid_utf8(to_col(c))
