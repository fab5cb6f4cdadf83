"""Codes and keys: normalisation, key display, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def code_text(col: Column | str, dtype: DataType | None = None) -> Column:
    """Render a code as text.  Floating codes go through ``decimal(20,0)`` so
    ``12345678.0`` prints as ``12345678`` and not in scientific notation."""
    c = _c(col)
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.when(c == F.floor(c), c.cast("decimal(20,0)").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def norm_code(col: Column | str, dtype: DataType | None = None) -> Column:
    """Code as text with one trailing ``.0`` removed (``'123.0'`` -> ``'123'``)."""
    return F.regexp_replace(code_text(col, dtype), r"\.0$", "")


def delivery_order_no(main_no: Column | str | None, order_no: Column | str,
                      prefix: str = "DD") -> Column:
    """Main order number when it starts with ``prefix``, else the order number."""
    if main_no is None:
        return _c(order_no)
    m = _c(main_no)
    return F.when(m.startswith(prefix), m).otherwise(_c(order_no))


# Characters a file or partition label may not contain; each is
# replaced by an underscore.
FORBIDDEN_LABEL_CHARS = r'[/\\:*?"<>|]'


def safe_label(col: Column | str) -> Column:
    return F.regexp_replace(_c(col).cast("string"), FORBIDDEN_LABEL_CHARS, "_")
