"""Variances, the five-class rule, scenes and the organisation split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trimatch.functions.codes import norm_code
from trimatch.functions.numbers import within
from trimatch.plans import spec as S

DIFF = "decimal(28,2)"


def oms_variances(j: DataFrame) -> DataFrame:
    """order - delivery qty, order - invoice qty, delivery - invoice qty,
    order - invoice amount (rounded to cents)."""
    return j.withColumns({
        "order_minus_shipped_qty": (F.col("order_qty") - F.col("shipped_qty")).cast(DIFF),
        "order_minus_invoice_qty": (F.col("order_qty") - F.col("invoice_qty")).cast(DIFF),
        "shipped_minus_invoice_qty": (F.col("shipped_qty") - F.col("invoice_qty")).cast(DIFF),
        "order_minus_invoice_amount": F.round(F.col("order_amount") - F.col("invoice_amount"), 2).cast(DIFF),
    })


def dms_variances(j: DataFrame) -> DataFrame:
    """invoice - order amount, base invoice qty - order qty, base invoice qty -
    shipped qty; all rounded to cents."""
    return j.withColumns({
        "invoice_minus_order_amount": F.round(F.col("invoice_amount") - F.col("order_amount"), 2).cast(DIFF),
        "invoice_minus_order_qty": F.round(F.col("invoice_qty") - F.col("order_qty"), 2).cast(DIFF),
        "invoice_minus_shipped_qty": F.round(F.col("invoice_qty") - F.col("shipped_qty"), 2).cast(DIFF),
    })


def category_expr(not_test: Column, qty_ok: Column, amount_ok: Column) -> Column:
    """Exactly one of the five classes per row."""
    return (F.when(not_test, S.NOT_TEST)
            .when(qty_ok & amount_ok, S.FULL_MATCH)
            .when(qty_ok, S.AMOUNT_DIFFERS)
            .when(amount_ok, S.QTY_DIFFERS)
            .otherwise(S.BOTH_DIFFER))


def any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def classify_oms(j: DataFrame, amount_tol=1, qty_tol=0) -> DataFrame:
    """Not test when any compared total is missing; quantities agree when order
    and delivery both equal the invoice; amounts when ``abs < amount_tol``."""
    not_test = any_null(["order_amount", "order_qty", "shipped_qty", "invoice_amount", "invoice_qty"])
    qty_ok = within("order_minus_invoice_qty", qty_tol) & within("shipped_minus_invoice_qty", qty_tol)
    amount_ok = within("order_minus_invoice_amount", amount_tol)
    return j.withColumn("category", category_expr(not_test, qty_ok, amount_ok))


def classify_dms(j: DataFrame, amount_tol=1, qty_tol="0.01") -> DataFrame:
    """Not test when the order amount or the shipped quantity is missing;
    quantities agree when ``abs(invoice - shipped) < qty_tol`` (the order
    quantity is reported but not tested)."""
    not_test = any_null(["order_amount", "shipped_qty"])
    qty_ok = within("invoice_minus_shipped_qty", qty_tol)
    amount_ok = within("invoice_minus_order_amount", amount_tol)
    return j.withColumn("category", category_expr(not_test, qty_ok, amount_ok))


def strict_not_test(j: DataFrame, cols=None) -> DataFrame:
    """Partial-year OMS rule: Not test when any joined column is NULL."""
    cols = cols or [c for c in j.columns if c != "category"]
    return j.withColumn("category", F.when(any_null(cols), S.NOT_TEST).otherwise(F.col("category")))


def invoice_scene(invoices: DataFrame, type_col: str = "invoice_type",
                  dms_col: str = "dms_order_no", out: str = "scene") -> DataFrame:
    """Scene of each invoice line; the later rule of the original wins, so the
    ``when`` chain lists the rules in reverse."""
    t = F.col(type_col)
    to_b = t.isin(*S.TO_B_INVOICE_TYPES)
    scene = (F.when(t.isin(*S.TO_C_INVOICE_TYPES), S.SCENE_TO_C)
             .when(t.isin(*S.FUTURES_INVOICE_TYPES), S.SCENE_FUTURES)
             .when(to_b & F.col(dms_col).isNull(), S.SCENE_TO_B_OMS)
             .when(to_b, S.SCENE_TO_B_DMS)
             .otherwise(S.SCENE_DEFAULT))
    return invoices.withColumn(out, scene)


def org_group(col: Column | str | None, orgs=S.SPLIT_ORGS) -> Column:
    """``1240/1250/1260`` for the listed organisations (text, number or
    ``1240.0``), ``other`` for everything else including NULL."""
    if col is None:
        return F.lit(S.ORG_GROUP_REST)
    c = F.col(col) if isinstance(col, str) else col
    return F.when(norm_code(c).isin(*orgs), S.ORG_GROUP_SPLIT).otherwise(S.ORG_GROUP_REST)


def split_by_org(result: DataFrame, col: str = "inv_sales_org", orgs=S.SPLIT_ORGS) -> DataFrame:
    return result.withColumn("org_group", org_group(col if col in result.columns else None, orgs))
