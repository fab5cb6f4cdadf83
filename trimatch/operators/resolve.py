"""Column-role resolution over source headers (driver-side, metadata only).

Extract headers drift between months; a role (amount, quantity, material,
order number, ...) is found by candidate lists.  Each resolver looks only at
``df.columns`` except :func:`sniff_type_column`, which reads one column.
Resolved columns are then selected under canonical names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Candidate headers per role, in priority order.
OMS_ORDER_CANDIDATES = ("OMS销售单号", "OMS订单号", "销售单号")
MATERIAL_CANDIDATES = ("物料编码", "料号", "品号", "物料编号")
DMS_ORDER_EXACT = "DMS销售单号"
DMS_ORDER_TOKENS = ("DMS", "销售", "单号")
DMS_AMOUNT = "含税金额"
DMS_QTY_SALES = "开票数量（销售单位）"
DMS_QTY_BASE = "开票数量（基本单位数量）"
DMS_QTY_SALES_TOKENS = ("开票数量", "销售单位")
DMS_QTY_BASE_TOKENS = ("开票数量", "基本单位")
DMS_MATERIAL_TOKENS = ("物料", "编码")
OMS_AMOUNT_RULES = (("实际金额",), ("金额", "ZFN1"))
OMS_QTY_RULES = (("开票数量",), ("数量", "基本单位"))
INVOICE_TYPE_TOKEN = "发票类型"
INVOICE_TYPE_DUPLICATE = "发票类型.1"
INVOICE_TYPE_POSITION = 14
INVOICE_TYPE_SNIFF_TOKEN = "发票"
INVOICE_ATTRIBUTES = (
    (("SAP发票号", "SAP发票编号", "SAP账单号", "发票号", "发票编号"), "invoice_no"),
    (("公司代码", "公司"), "company_code"),
    (("发票备注", "备注", "发票说明", "说明"), "remark"),
    (("发票类型", "发票类型.1"), "invoice_type"),
    (("销售组织", "销售组织代码"), "sales_org"),
    (("开票日期", "发票日期"), "invoice_date"),
    (("客户名称", "客户"), "customer_name"),
    (("物料名称", "名称"), "item_name"),
    (("数据源文件",), "src_file"),
    (("DMS销售单号",), "dms_order_no"),
)
# DMS attributes, in priority order; they differ from the OMS ones.
DMS_INVOICE_ATTRIBUTES = (
    (("SAP发票号", "SAP发票编号", "SAP账单号", "发票号", "发票编号"), "invoice_no"),
    (("SAP订单号",), "sap_order_no"),
    (("OMS订单号", "OMS主订单号", "OMS系统订单号"), "oms_order_no"),
    (("公司代码", "公司"), "company_code"),
    (("发票备注", "备注", "发票说明"), "remark"),
    (("发票类型", "发票类型.1"), "invoice_type"),
    (("销售组织", "销售组织代码"), "sales_org"),
    (("客户名称", "客户"), "customer_name"),
    (("名称", "物料名称"), "item_name"),
    (("开票日期", "发票日期"), "invoice_date"),
    (("数据源文件",), "src_file"),
)


class MissingColumn(ValueError):
    """A required role could not be resolved."""


def first_exact(columns: Sequence[str], candidates: Sequence[str], default: str | None = None) -> str | None:
    """First candidate, in candidate order, present exactly."""
    return next((c for c in candidates if c in columns), default)


def exact_then_contains(columns: Sequence[str], exact: str, tokens: Sequence[str]) -> str | None:
    """Exact header if present, else the first header containing every token."""
    if exact in columns:
        return exact
    return next((c for c in columns if all(t in c for t in tokens)), None)


def last_contains(columns: Sequence[str], rules: Sequence[Sequence[str]]) -> str | None:
    """Last header (in column order) matching any rule; a rule matches when
    the header contains all its tokens."""
    found = None
    for c in columns:
        if any(all(t in c for t in rule) for rule in rules):
            found = c
    return found


def contains_any_first(columns: Sequence[str], candidates: Sequence[str], taken: set[str]) -> str | None:
    """First header, in column order, containing any candidate and not taken."""
    return next((c for c in columns if c not in taken and any(k in c for k in candidates)), None)


def positional(columns: Sequence[str], index: int = INVOICE_TYPE_POSITION) -> str | None:
    return columns[index] if len(columns) > index else None


def require(role: str, col: str | None) -> str:
    if not col:
        raise MissingColumn(f"no column found for role {role!r}")
    return col


def restore_duplicate_headers(df: DataFrame, base: str = INVOICE_TYPE_TOKEN) -> DataFrame:
    """Spark's CSV reader renames a duplicated header ``h`` to ``h<i>`` (by
    column index) for *both* copies; restore the ``h`` / ``h.1`` pair the
    candidate lists expect."""
    dup = [c for c in df.columns if c != base and c.startswith(base) and c[len(base):].isdigit()]
    if len(dup) < 2:
        return df
    ren = {dup[0]: base, dup[1]: f"{base}.1"}
    return df.withColumnsRenamed(ren)


def sniff_type_column(df: DataFrame) -> str | None:
    """``发票类型.1`` if present; else ``发票类型`` only if any of its values
    contains ``发票`` (one aggregate over the whole column)."""
    if INVOICE_TYPE_DUPLICATE in df.columns:
        return INVOICE_TYPE_DUPLICATE
    if INVOICE_TYPE_TOKEN not in df.columns:
        return None
    hit = df.agg(F.bool_or(F.col(INVOICE_TYPE_TOKEN).cast("string").contains(INVOICE_TYPE_SNIFF_TOKEN))).first()[0]
    return INVOICE_TYPE_TOKEN if hit else None


def oms_invoice_roles(columns: Sequence[str]) -> dict[str, str]:
    """Canonical name -> source header for the OMS invoice extract."""
    cols = list(columns)
    roles = {"oms_order_no": first_exact(cols, OMS_ORDER_CANDIDATES),
             "item_code": first_exact(cols, MATERIAL_CANDIDATES),
             "amount": last_contains(cols, OMS_AMOUNT_RULES),
             "qty": last_contains(cols, OMS_QTY_RULES)}
    taken = {v for v in roles.values() if v}
    for cands, name in INVOICE_ATTRIBUTES:
        c = contains_any_first(cols, cands, taken)
        if c:
            roles.setdefault(name, c)
            taken.add(c)
    if "invoice_type" not in roles:
        c = next((c for c in cols if INVOICE_TYPE_TOKEN in c), None) or positional(cols)
        if c:
            roles["invoice_type"] = c
    return {k: v for k, v in roles.items() if v}


def dms_invoice_roles(df: DataFrame) -> dict[str, str]:
    cols = df.columns
    roles = {
        "dms_order_no": require("dms_order_no", exact_then_contains(cols, DMS_ORDER_EXACT, DMS_ORDER_TOKENS)),
        "amount": require("amount", exact_then_contains(cols, DMS_AMOUNT, (DMS_AMOUNT,))),
        "qty_sales_unit": require("qty_sales_unit", exact_then_contains(cols, DMS_QTY_SALES, DMS_QTY_SALES_TOKENS)),
        "qty_base_unit": require("qty_base_unit", exact_then_contains(cols, DMS_QTY_BASE, DMS_QTY_BASE_TOKENS)),
        "item_code": require("item_code", exact_then_contains(cols, MATERIAL_CANDIDATES[0], DMS_MATERIAL_TOKENS)),
    }
    t = sniff_type_column(df)
    if t:
        roles["invoice_type"] = t
    for cands, name in DMS_INVOICE_ATTRIBUTES:
        if name in roles:
            continue
        c = first_exact(cols, cands)
        if c:
            roles[name] = c
    return roles


def resolve_invoice_columns(df: DataFrame, profile: str = "DMS", keep: Sequence[str] = ("src_pos", "src_file")) -> DataFrame:
    """Select the resolved roles under canonical names (measures stay text;
    the aggregation parses them tolerantly)."""
    df = restore_duplicate_headers(df)
    roles = dms_invoice_roles(df) if profile == "DMS" else oms_invoice_roles(df.columns)
    if profile != "DMS":
        require("oms_order_no", roles.get("oms_order_no"))
        require("item_code", roles.get("item_code"))
    extra = [c for c in keep if c in df.columns and c not in roles]
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in roles.items()], *extra)
