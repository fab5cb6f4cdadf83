"""Order and delivery ledgers and their totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trimatch.functions.dates import ledger_date, safe_timestamp
from trimatch.functions.numbers import safe_number, zero_fill

# Ledger summary items and units.
ORDER_AMOUNT = "订单总金额"
ORDER_QTY = "订单总数量"
ORDER_ROWS = "订单记录数"
SHIPPED_QTY = "发货总数量"
DELIVERY_ROWS = "发货记录数"
UNIT_MONEY = "元"
UNIT_PIECES = "件"
UNIT_ROWS = "条"

ORDER_LEDGER_COLS = ("business_date", "platform_order_no", "sale_order_no", "channel_name",
                     "item_code", "item_num", "line_amount", "pay_amount", "order_type",
                     "order_status", "create_time", "update_time")
DELIVERY_LEDGER_COLS = ("business_date", "business_type", "order_no", "external_order_no",
                        "item_code", "item_name", "shipped_qty", "biz_time")


# Headers of the delivery dumps, and of the ledgers as printed.
SOURCE_NAMES = {"主单号": "main_no", "订单号": "order_no", "业务时间": "biz_time", "料号": "item_code",
                "名称": "item_name", "已发货数量": "shipped_qty"}
ORDER_LEDGER_LABELS = {
    "business_date": "业务日期", "platform_order_no": "平台订单号", "sale_order_no": "销售订单号",
    "channel_name": "渠道名称", "item_code": "商品代码", "item_num": "商品数量", "line_amount": "行金额",
    "pay_amount": "支付金额", "order_type": "订单类型", "order_status": "订单状态",
    "create_time": "创建时间", "update_time": "更新时间",
}
DELIVERY_LEDGER_LABELS = {
    "business_date": "业务日期", "business_type": "业务类型", "order_no": "订单号",
    "external_order_no": "外部订单号", "item_code": "料号", "item_name": "商品名称",
    "shipped_qty": "已发货数量", "biz_time": "业务时间",
}


def canonical(df: DataFrame) -> DataFrame:
    """Source headers under the names the operators use."""
    return df.withColumnsRenamed({k: v for k, v in SOURCE_NAMES.items() if k in df.columns and v not in df.columns})


def labelled(ledger: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Printed headers; columns without one keep their name."""
    return ledger.withColumnsRenamed(labels)


def _as_timestamp(df: DataFrame, col: str) -> DataFrame:
    """Text dates (as parsed from dumps) become timestamps; others pass."""
    if col not in df.columns:
        return df
    return df.withColumn(col, safe_timestamp(col, dtype=df.schema[col].dataType))


def order_ledger(orders: DataFrame) -> DataFrame:
    """Order lines in ledger form: business date, amounts zero-filled and
    rounded to cents, quantity zero-filled; only columns that exist."""
    cols = orders.columns
    orders = _as_timestamp(orders, "create_time")
    o = orders.withColumn("business_date", ledger_date("create_time" if "create_time" in cols else None))
    fills = {c: zero_fill(c, 2) for c in ("line_amount", "pay_amount") if c in cols}
    if "item_num" in cols:
        fills["item_num"] = zero_fill("item_num", None)
    o = o.withColumns(fills)
    return o.select(*[c for c in ORDER_LEDGER_COLS if c in o.columns])


def delivery_ledger(deliveries: DataFrame) -> DataFrame:
    """Delivery lines in ledger form; source headers are understood."""
    deliveries = canonical(deliveries)
    cols = deliveries.columns
    deliveries = _as_timestamp(deliveries, "biz_time")
    d = deliveries.withColumn("business_date", ledger_date("biz_time" if "biz_time" in cols else None))
    if "shipped_qty" in cols:
        d = d.withColumn("shipped_qty", zero_fill("shipped_qty", None))
    return d.select(*[c for c in DELIVERY_LEDGER_COLS if c in d.columns])


def ledger_summary(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Totals from the unformatted inputs as (item, value, unit) rows; one
    global aggregate per leg, stacked and unioned (no join)."""
    deliveries = canonical(deliveries)
    o = orders.agg(F.coalesce(F.sum(safe_number("pay_amount")), F.lit(0)).alias("amt"),
                   F.coalesce(F.sum(safe_number("item_num")), F.lit(0)).alias("qty"),
                   F.count(F.lit(1)).alias("n"))
    o = o.select(F.expr(
        f"stack(3, '{ORDER_AMOUNT}', {_fmt('amt', 2)}, '{UNIT_MONEY}', "
        f"'{ORDER_QTY}', {_fmt('qty', 0)}, '{UNIT_PIECES}', "
        f"'{ORDER_ROWS}', {_fmt('n', 0)}, '{UNIT_ROWS}') as (item, value, unit)"))
    d = deliveries.agg(F.coalesce(F.sum(safe_number("shipped_qty")), F.lit(0)).alias("qty"),
                       F.count(F.lit(1)).alias("n"))
    d = d.select(F.expr(
        f"stack(2, '{SHIPPED_QTY}', {_fmt('qty', 0)}, '{UNIT_PIECES}', "
        f"'{DELIVERY_ROWS}', {_fmt('n', 0)}, '{UNIT_ROWS}') as (item, value, unit)"))
    return o.unionByName(d)


def _fmt(col: str, scale: int) -> str:
    return f"format_number({col}, {scale})"


__all__ = ["canonical", "delivery_ledger", "labelled", "ledger_summary", "order_ledger"]
