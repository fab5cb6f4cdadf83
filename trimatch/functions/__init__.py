"""Scalar column functions (all JVM-side expressions)."""

from trimatch.functions.codes import delivery_order_no, norm_code, safe_label
from trimatch.functions.dates import in_period, ledger_date, safe_timestamp
from trimatch.functions.numbers import money, safe_number, within, zero_fill

__all__ = [
    "delivery_order_no", "in_period", "ledger_date", "money",
    "norm_code", "safe_label", "safe_number", "safe_timestamp",
    "within", "zero_fill",
]
