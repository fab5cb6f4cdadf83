"""The reconciliation pipeline: leg totals -> three-way match -> classes.

Everything here is lazy; nothing triggers a Spark job.  The three leg totals
are aggregated on the same two key columns (``order_no``, ``item_code``) the
joins use, so the join stage reuses the aggregates' hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trimatch.functions.codes import code_text, delivery_order_no, norm_code
from trimatch.functions.dates import safe_timestamp
from trimatch.operators.aggregate import aggregate_leg
from trimatch.operators.classify import (classify_dms, classify_oms, dms_variances, oms_variances,
                                          strict_not_test)
from trimatch.operators.filters import (channel_contains, drop_status, filter_invoice_type_adaptive,
                                        filter_invoice_type_text, has_value, keep_types,
                                        period_filter, route_invoices)
from trimatch.operators.join import KEYS, map_dms_to_oms, three_way_match
from trimatch.plans.spec import OMS, SourceSpec

ORDER_CARRY_OMS = {
    "ord_sale_order_no": "sale_order_no", "ord_platform_order_no": "platform_order_no",
    "ord_main_order_no": "main_order_no", "ord_channel_name": "channel_name",
    "ord_order_type": "order_type", "ord_order_status": "order_status",
    "ord_create_time": "create_time", "ord_update_time": "update_time",
    "ord_item_code": "item_code",
}
DELIVERY_CARRY_OMS = {
    "dlv_order_no": "order_no", "dlv_main_no": "main_no",
    "dlv_external_order_no": "external_order_no", "dlv_biz_time": "biz_time",
    "dlv_item_code": "item_code", "dlv_item_name": "item_name",
    "dlv_business_type": "business_type",
}
INVOICE_CARRY_OMS = {
    "inv_invoice_no": "invoice_no", "inv_company_code": "company_code",
    "inv_remark": "remark", "inv_invoice_type": "invoice_type",
    "inv_sales_org": "sales_org", "inv_invoice_date": "invoice_date",
    "inv_customer_name": "customer_name", "inv_item_name": "item_name",
    "inv_src_file": "src_file", "inv_oms_order_no": "oms_order_no",
    "inv_item_code": "item_code", "inv_dms_order_no": "dms_order_no",
}
ORDER_CARRY_DMS = {
    "ord_platform_order_no": "platform_order_no", "ord_item_code": "item_code",
    "ord_sale_order_no": "sale_order_no", "ord_main_order_no": "main_order_no",
    "ord_channel_name": "channel_name", "ord_order_type": "order_type",
    "ord_order_status": "order_status", "ord_create_time": "create_time",
    "ord_update_time": "update_time",
}
DELIVERY_CARRY_DMS = {
    "dlv_external_order_no": "external_order_no", "dlv_item_code": "item_code",
    "dlv_order_no": "order_no", "dlv_main_no": "main_no", "dlv_biz_time": "biz_time",
    "dlv_item_name": "item_name", "dlv_business_type": "business_type",
}
INVOICE_CARRY_DMS = {
    "inv_invoice_no": "invoice_no", "inv_sap_order_no": "sap_order_no", "inv_oms_order_no": "oms_order_no",
    "inv_company_code": "company_code", "inv_remark": "remark",
    "inv_invoice_type": "invoice_type", "inv_sales_org": "sales_org",
    "inv_customer_name": "customer_name", "inv_item_name": "item_name",
    "inv_invoice_date": "invoice_date", "inv_src_file": "src_file",
}


def _timestamps(df: DataFrame, *cols: str) -> DataFrame:
    """Text date columns (as read from dumps) become timestamps."""
    conv = {c: safe_timestamp(c) for c in cols
            if c in df.columns and isinstance(df.schema[c].dataType, StringType)}
    return df.withColumns(conv) if conv else df


def _pick(carry_map: dict[str, str], carry) -> dict[str, str]:
    """The carried attributes a caller asked for: all (True), none (False)
    or the named ones.  Unused attributes are pruned by Catalyst anyway;
    not building them keeps plan construction short."""
    if carry is True:
        return carry_map
    if not carry:
        return {}
    return {k: v for k, v in carry_map.items() if k in carry}


def _item(spec: SourceSpec, df: DataFrame, col: str = "item_code"):
    """Item code as text; floating codes never in scientific notation."""
    kind = df.schema[col].dataType
    return norm_code(col, kind) if spec.normalize_codes else code_text(col, kind)


# --- OMS --------------------------------------------------------------------

def oms_filtered_orders(orders: DataFrame, spec: SourceSpec = OMS) -> DataFrame:
    o = _timestamps(orders, "create_time", "update_time")
    if spec.prefiltered:
        return o
    o = keep_types(drop_status(o, spec.excluded_statuses), spec.kept_order_types)
    if spec.period:
        o = period_filter(o, "create_time", *spec.period)
    return o


def oms_filtered_deliveries(deliveries: DataFrame, spec: SourceSpec = OMS) -> DataFrame:
    d = _timestamps(deliveries, "biz_time")
    if spec.period and not spec.prefiltered:
        d = period_filter(d, "biz_time", *spec.period)
    return d


def oms_invoices_used(invoices: DataFrame, orders: DataFrame | None = None,
                      spec: SourceSpec = OMS) -> DataFrame:
    """Type-filtered invoices keyed by an OMS number: direct ones, plus (when
    the spec asks and the orders carry ``external_order_no``) those mapped
    from a DMS number."""
    if spec.prefiltered:
        return invoices
    inv = filter_invoice_type_adaptive(invoices, "invoice_type")
    direct, to_map = route_invoices(inv)
    if spec.map_dms_invoices and orders is not None and "external_order_no" in orders.columns:
        mapped = map_dms_to_oms(to_map, orders, normalize=spec.normalize_codes, dedupe=spec.dedupe_map)
        return direct.unionByName(mapped, allowMissingColumns=True)
    return direct


def oms_order_totals(orders: DataFrame, spec: SourceSpec = OMS, carry=True) -> DataFrame:
    o = oms_filtered_orders(orders, spec)
    return aggregate_leg(o, {"order_no": F.col("sale_order_no"), "item_code": _item(spec, o)},
                         {"order_amount": "pay_amount", "order_qty": "item_num"},
                         _pick(ORDER_CARRY_OMS, carry), spec.round_before_sum)


def oms_delivery_totals(deliveries: DataFrame, spec: SourceSpec = OMS, carry=True) -> DataFrame:
    d = oms_filtered_deliveries(deliveries, spec)
    main = "main_no" if "main_no" in d.columns else None
    return aggregate_leg(d, {"order_no": delivery_order_no(main, "order_no"), "item_code": _item(spec, d)},
                         {"shipped_qty": "shipped_qty"}, _pick(DELIVERY_CARRY_OMS, carry), spec.round_before_sum)


def _measures_or_empty(df: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """A leg whose measure columns could not be resolved yields an empty,
    typed result (and so an empty reconciliation) instead of an error."""
    missing = [m for m in measures if m not in df.columns]
    if not missing:
        return df
    return df.withColumns({m: F.lit(None).cast("string") for m in missing}).where(F.lit(False))


def oms_invoice_totals(invoices: DataFrame, orders: DataFrame | None = None,
                       spec: SourceSpec = OMS, carry=True) -> DataFrame:
    mapped_orders = oms_filtered_orders(orders, spec) if orders is not None else None
    used = _measures_or_empty(oms_invoices_used(invoices, mapped_orders, spec), ("amount", "qty"))
    return aggregate_leg(used, {"order_no": F.col("oms_order_no"), "item_code": _item(spec, used)},
                         {"invoice_amount": "amount", "invoice_qty": "qty"},
                         _pick(INVOICE_CARRY_OMS, carry), spec.round_before_sum)


def reconcile_oms(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
                  spec: SourceSpec = OMS, carry=True) -> DataFrame:
    inv = oms_invoice_totals(invoices, orders, spec, carry)
    j = three_way_match(inv, oms_delivery_totals(deliveries, spec, carry),
                        oms_order_totals(orders, spec, carry))
    out = classify_oms(oms_variances(j), spec.amount_tol, spec.qty_tol)
    return strict_not_test(out) if spec.strict else out


# --- DMS --------------------------------------------------------------------

def dms_order_totals(orders: DataFrame, spec: SourceSpec, carry=True) -> DataFrame:
    o = _timestamps(orders if spec.prefiltered else channel_contains(orders), "create_time", "update_time")
    return aggregate_leg(o, {"order_no": F.col("platform_order_no"), "item_code": _item(spec, o)},
                         {"order_amount": "pay_amount", "order_qty": "item_num"},
                         _pick(ORDER_CARRY_DMS, carry), spec.round_before_sum)


def dms_delivery_totals(deliveries: DataFrame, spec: SourceSpec, carry=True) -> DataFrame:
    d = _timestamps(deliveries if spec.prefiltered else has_value(deliveries, "external_order_no"), "biz_time")
    return aggregate_leg(d, {"order_no": F.col("external_order_no"), "item_code": _item(spec, d)},
                         {"shipped_qty": "shipped_qty"}, _pick(DELIVERY_CARRY_DMS, carry), spec.round_before_sum)


def dms_invoice_totals(invoices: DataFrame, spec: SourceSpec, carry=True) -> DataFrame:
    i = invoices if spec.prefiltered else has_value(filter_invoice_type_text(invoices, "invoice_type"), "dms_order_no")
    i = _measures_or_empty(i, ("amount", "qty_sales_unit", "qty_base_unit"))
    return aggregate_leg(i, {"order_no": F.col("dms_order_no"), "item_code": _item(spec, i)},
                         {"invoice_amount": "amount", "invoice_qty_sales": "qty_sales_unit",
                          "invoice_qty": "qty_base_unit"},
                         _pick(INVOICE_CARRY_DMS, carry), spec.round_before_sum,
                         first=spec.invoice_first)


def reconcile_dms(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
                  spec: SourceSpec, carry=True) -> DataFrame:
    j = three_way_match(dms_invoice_totals(invoices, spec, carry), dms_order_totals(orders, spec, carry),
                        dms_delivery_totals(deliveries, spec, carry))
    return classify_dms(dms_variances(j), spec.amount_tol, spec.qty_tol)


def reconcile(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
              spec: SourceSpec = OMS, carry=True) -> DataFrame:
    """Classified three-way match, one row per invoice key.

    ``carry`` selects the carried leg attributes (``ord_*``, ``dlv_*``,
    ``inv_*``): all by default, none with ``False``, or a set of names."""
    if spec.name == "DMS":
        return reconcile_dms(orders, deliveries, invoices, spec, carry)
    return reconcile_oms(orders, deliveries, invoices, spec, carry)


__all__ = ["KEYS", "reconcile", "reconcile_dms", "reconcile_oms"]
