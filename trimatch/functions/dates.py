"""Dates: tolerant parsing over a format list, period windows, ledger dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

# Formats tried in order when a column arrives as text.
DEFAULT_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "yyyyMMdd",
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_timestamp(col: Column | str, formats=DEFAULT_FORMATS, dtype=None) -> Column:
    """Text -> timestamp trying each format; unparseable -> NULL.  Columns that
    are already dates or timestamps pass through."""
    c = _c(col)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return c
    if isinstance(dtype, DateType):
        return c.cast("timestamp")
    s = F.trim(c.cast("string"))
    if tuple(formats) == DEFAULT_FORMATS:
        return _by_form(s)
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def _by_form(s: Column) -> Column:
    """The default formats, told apart by length and separators: a value is
    parsed once at most."""
    f1, f2, f3, f4, f5, f6, f7 = (F.try_to_timestamp(s, F.lit(f)) for f in DEFAULT_FORMATS)
    n, sep, mid = F.length(s), F.substring(s, 5, 1), F.substring(s, 11, 1)
    return (F.when(n == 19, F.when(sep == "/", f4).when(mid == "T", f3).otherwise(f1))
            .when(n == 10, F.when(sep == "/", f6).otherwise(f5)).when(n == 8, f7).when(n > 19, f2))


def in_period(col: Column | str, start: str | dt.date | None, end: str | dt.date | None) -> Column:
    """Half-open window ``start <= col < end`` on a timestamp.  Written as a
    range (not ``year(col) == y``) so Parquet row groups can be skipped."""
    c = _c(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(str(start)).cast("timestamp"))
    if end is not None:
        cond = cond & (c < F.lit(str(end)).cast("timestamp"))
    return cond


def ledger_date(col: Column | str | None) -> Column:
    """``yyyy-MM-dd`` text; empty text when the source column is missing."""
    if col is None:
        return F.lit("")
    return F.date_format(_c(col), "yyyy-MM-dd")
