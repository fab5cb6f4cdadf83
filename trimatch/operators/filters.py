"""Row filters (statuses, types, periods, channels, invoice types, routing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trimatch.functions.dates import in_period
from trimatch.plans import spec as S


def drop_status(orders: DataFrame, statuses=S.EXCLUDED_STATUSES, col: str = "order_status") -> DataFrame:
    """Drop listed statuses; a NULL status is kept (``!=`` semantics of the
    original scripts, where a missing value is "not equal")."""
    c = F.col(col)
    return orders.where(c.isNull() | ~c.isin(*statuses))


def keep_types(orders: DataFrame, types=S.KEPT_ORDER_TYPES, col: str = "order_type") -> DataFrame:
    return orders.where(F.col(col).isin(*types))


PERIOD_PARTITION = "period_year"


def period_filter(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows whose timestamp lies in ``[start, end)``; NULL or unparsed dates
    drop.  On a staged leg partitioned by ``period_year`` (the year of its
    business date) the matching partition predicate is added too, so whole
    directories are skipped; the exact range still decides row by row."""
    cond = in_period(col, start, end)
    if PERIOD_PARTITION in df.columns:
        y = F.col(PERIOD_PARTITION)
        if start is not None:
            cond = cond & (y >= int(str(start)[:4]))
        if end is not None:
            cond = cond & (y <= int(str(end)[:4]))
    return df.where(cond)


def channel_contains(orders: DataFrame, token: str = S.DMS_CHANNEL_TOKEN, col: str = "channel_name") -> DataFrame:
    """Channel contains ``token`` in any case; whole table if the column is absent."""
    if col not in orders.columns:
        return orders
    return orders.where(F.upper(F.col(col)).contains(token.upper()))


def has_value(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def code_hit(col: str, pattern: str = S.INVOICE_CODE_PATTERN) -> Column:
    """Whether a value fully matches ``pattern``; NULL does not."""
    return F.coalesce(F.col(col).rlike(pattern), F.lit(False))


def code_share(invoices: DataFrame, col: str, pattern: str = S.INVOICE_CODE_PATTERN) -> Column:
    """Share of all rows (NULLs count as non-matching) whose value fully
    matches ``pattern``, as a scalar subquery: evaluated once, one value."""
    hit = code_hit(col, pattern).cast("double")
    return invoices.select(F.coalesce(F.avg(hit), F.lit(0.0))).scalar()


def invoice_type_keep_text(col: str) -> Column:
    c = F.col(col)
    return c.rlike(S.KEPT_INVOICE_TEXT_PATTERN) | c.contains(S.KEPT_INVOICE_TEXT_CONTAINS)


def keep_invoice_type_adaptive(invoices: DataFrame, col: str | None = "invoice_type",
                               codes=S.KEPT_INVOICE_CODES, share: float = 0.5) -> Column:
    """OMS invoice-type rule.  If more than ``share`` of the type values are
    codes (two capitals + two digits) keep the listed codes, else keep the
    standard 2B and standard return texts (their cancellations included).
    No type column -> all are kept.  The decision is a one-value subquery, so
    the table is never collected and no join is needed."""
    if col is None or col not in invoices.columns:
        return F.lit(True)
    is_code = code_share(invoices, col) > F.lit(share)
    keep = F.when(is_code, F.col(col).isin(*codes)).otherwise(invoice_type_keep_text(col))
    return F.coalesce(keep, F.lit(False))


def filter_invoice_type_adaptive(invoices: DataFrame, col: str | None = "invoice_type",
                                 codes=S.KEPT_INVOICE_CODES, share: float = 0.5) -> DataFrame:
    """Rows that :func:`keep_invoice_type_adaptive` keeps."""
    return invoices.where(keep_invoice_type_adaptive(invoices, col, codes, share))


def keep_invoice_type_text(invoices: DataFrame, col: str | None = "invoice_type",
                           must=S.DMS_INVOICE_MUST, must_not=S.DMS_INVOICE_MUST_NOT) -> Column:
    """DMS invoice-type rule: contains every ``must`` and no ``must_not``."""
    if col is None or col not in invoices.columns:
        return F.lit(True)
    cond = F.lit(True)
    for m in must:
        cond = cond & F.col(col).contains(m)
    for m in must_not:
        cond = cond & ~F.col(col).contains(m)
    return F.coalesce(cond, F.lit(False))


def filter_invoice_type_text(invoices: DataFrame, col: str | None = "invoice_type",
                             must=S.DMS_INVOICE_MUST, must_not=S.DMS_INVOICE_MUST_NOT) -> DataFrame:
    """Rows that :func:`keep_invoice_type_text` keeps."""
    return invoices.where(keep_invoice_type_text(invoices, col, must, must_not))


def route_invoices(invoices: DataFrame, oms_col: str = "oms_order_no",
                   dms_col: str = "dms_order_no") -> tuple[DataFrame, DataFrame]:
    """Split invoices: ``direct`` has an OMS number (even if it also has a DMS
    number); ``to_map`` has only a DMS number.  Rows with neither drop out."""
    direct = invoices.where(F.col(oms_col).isNotNull())
    if dms_col not in invoices.columns:
        return direct, invoices.where(F.lit(False))
    to_map = invoices.where(F.col(oms_col).isNull() & F.col(dms_col).isNotNull())
    return direct, to_map


def of_category(result: DataFrame, category: str, col: str = "category") -> DataFrame:
    return result.where(F.col(col) == category)
