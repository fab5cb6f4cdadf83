"""Source profiles.  OMS and DMS run the same pipeline with different rules."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from decimal import Decimal

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------
# The five classes, in report order.
NOT_TEST = "2.Not test"
FULL_MATCH = "1.1完全匹配"
AMOUNT_DIFFERS = "1.2金额不一致"
QTY_DIFFERS = "1.3数量不一致"
BOTH_DIFFER = "1.4均不一致"
CATEGORIES = (NOT_TEST, FULL_MATCH, AMOUNT_DIFFERS, QTY_DIFFERS, BOTH_DIFFER)
# Summary row labels: all data, and the (legacy) grand total.
ALL_DATA = "全部数据"
GRAND_TOTAL = "总计"
# Order filters (OMS).
EXCLUDED_STATUSES = ("OBSOLETE", "CANCEL")
KEPT_ORDER_TYPES = ("liquid_milk_order", "factory_item", "oem_order")
# Invoice-type filter (OMS): code form, and text form.
INVOICE_CODE_PATTERN = r"^[A-Z]{2}[0-9]{2}$"
KEPT_INVOICE_CODES = ("ZA01", "ZB02", "ZB06")
KEPT_INVOICE_TEXT_PATTERN = r"标准发票\s*[（(]?\s*2B"
KEPT_INVOICE_TEXT_CONTAINS = "标准退货发票"
# Invoice-type filter (DMS): all of MUST, none of MUST_NOT.
DMS_INVOICE_MUST = ("标准发票", "2B")
DMS_INVOICE_MUST_NOT = ("退货",)
# DMS orders: channel contains this token, any case.
DMS_CHANNEL_TOKEN = "DMS"
# Delivery: a main order number is used when it starts with this prefix.
MAIN_ORDER_PREFIX = "DD"
# Sales organisations reported apart from the rest.
SPLIT_ORGS = ("1240", "1250", "1260")
ORG_GROUP_SPLIT = "1240/1250/1260"
ORG_GROUP_REST = "other"
# Invoice scenes; later rules override earlier ones.
SCENE_DEFAULT = "其他"
SCENE_TO_B_DMS = "To B (DMS)"
SCENE_TO_B_OMS = "To B (OMS)"
SCENE_FUTURES = "期货"
SCENE_TO_C = "To C"
TO_B_INVOICE_TYPES = ("标准发票（2B)", "标准退货发票", "取消标准发票（2B)", "取消标准退货发票")
FUTURES_INVOICE_TYPES = ("取消传统贸易发票", "期货贸易发票")
TO_C_INVOICE_TYPES = ("标准发票（2C)",)
# Missing-leg breakdown labels.
MISSING_ORDER = "order missing"
MISSING_DELIVERY = "delivery missing"
MISSING_BOTH = "both missing"
# Rows per report file part (spreadsheet row limit minus the header).
REPORT_MAX_ROWS = 1_048_575


@dataclass(frozen=True)
class SourceSpec:
    """Rules of one source profile.

    ``normalize_codes``  strip a trailing ``.0`` from item codes before keying.
    ``round_before_sum`` round each line to cents before summing (OMS) or the
                         sums after (DMS).
    ``amount_tol`` / ``qty_tol`` thresholds of the class rule; ``qty_tol=0``
                         means exact equality.
    ``period``           optional half-open ``(start, end)`` date window on the
                         order and delivery dates (OMS only; the DMS path has
                         no date filter).
    ``map_dms_invoices`` OMS: also bring in invoices carrying only a DMS number
                         through the order cross-reference (needs
                         ``external_order_no`` on the orders).
    ``dedupe_map``       de-duplicate that cross-reference (avoids fan-out).
    ``legacy_total``     add the old doubled grand-total row to summaries.
    ``invoice_first``    how invoice attributes are carried: ``"non_null"``
                         (first non-NULL value per column) or ``"row"``
                         (the whole first row, NULLs kept).
    ``strict``           OMS: Not test when any column of the joined row is NULL.
    ``prefiltered``      the legs hold only rows that the filters keep, with DMS
                         numbers mapped (``accounting.observed_legs``).
    """

    name: str
    normalize_codes: bool
    round_before_sum: bool
    amount_tol: Decimal = Decimal("1")
    qty_tol: Decimal = Decimal("0")
    period: tuple[str, str] | None = None
    map_dms_invoices: bool = False
    dedupe_map: bool = True
    legacy_total: bool = False
    invoice_first: str = "non_null"
    strict: bool = False
    prefiltered: bool = False
    excluded_statuses: tuple[str, ...] = field(default=EXCLUDED_STATUSES)
    kept_order_types: tuple[str, ...] = field(default=KEPT_ORDER_TYPES)

    def with_(self, **kw) -> "SourceSpec":
        return replace(self, **kw)


OMS = SourceSpec(name="OMS", normalize_codes=True, round_before_sum=True,
                 amount_tol=Decimal("1"), qty_tol=Decimal("0"))
DMS = SourceSpec(name="DMS", normalize_codes=False, round_before_sum=False,
                 amount_tol=Decimal("1"), qty_tol=Decimal("0.01"))
# Partial-year OMS run: raw codes, Not test as soon as any joined column is NULL.
OMS_PARTIAL = OMS.with_(normalize_codes=False, strict=True)
# Partial-year DMS run: invoice attributes come from the whole first row.
DMS_PARTIAL = DMS.with_(invoice_first="row")
