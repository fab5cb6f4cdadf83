"""Numbers: tolerant parsing, money rounding, zero fill, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

# Working precision for parsed measures (32 digits before the point); results
# are rounded to MONEY.
NUMBER = "decimal(38,6)"
MONEY = "decimal(18,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_number(col: Column | str, dtype: DataType | None = None) -> Column:
    """Text or number -> decimal; anything unparseable (``'1,234.5'``, ``'x'``,
    ``'inf'``) becomes NULL instead of failing the job.  When the column is
    known to be numeric already, it is cast directly (no text round trip)."""
    if isinstance(dtype, DecimalType):
        return _c(col)
    if isinstance(dtype, IntegralType):
        return _c(col).cast("decimal(20,0)")
    return F.trim(_c(col).cast("string")).try_cast(NUMBER)


def unparsed(col: Column | str, dtype: DataType | None = None) -> Column:
    """Whether a value that is not blank gives no number."""
    return safe_number(col, dtype).isNull() & (F.trim(_c(col).cast("string")) != "")


def money(col: Column | str, scale: int = 2) -> Column:
    """HALF_UP rounding on decimals (never on doubles)."""
    return F.round(_c(col).cast(NUMBER), scale).cast(f"decimal(38,{scale})")


def zero_fill(col: Column | str, scale: int | None = 2) -> Column:
    """Unparseable or missing -> 0; optionally rounded (amounts) or not (quantities)."""
    v = F.coalesce(safe_number(col), F.lit(0).cast(NUMBER))
    return money(v, scale) if scale is not None else v


def within(col: Column | str, tol) -> Column:
    """``abs(col) < tol``; a tolerance of 0 means exact equality to zero."""
    c = _c(col)
    if tol == 0:
        return c == 0
    return F.abs(c) < F.lit(tol)
