"""Joins: three-way match, uninvoiced lines, DMS -> OMS cross-reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trimatch.functions.codes import norm_code

KEYS = ["order_no", "item_code"]


def three_way_match(invoices: DataFrame, first: DataFrame, second: DataFrame,
                    keys=KEYS) -> DataFrame:
    """Invoice totals left-joined to two other leg totals.

    All three inputs are aggregated on exactly ``keys``, so each is already
    hash-partitioned on them and the two joins add no exchange."""
    return invoices.join(first, keys, "left").join(second, keys, "left")


def uninvoiced(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
               keys=KEYS) -> DataFrame:
    """Order/delivery keys with no invoice (the full join of orders and
    deliveries, less the invoice keys).

    The anti join is applied to each side *before* the full join: a key is
    invoiced or not whichever side it comes from, so the result is the same,
    but every join then meets inputs already hash-partitioned on ``keys`` and
    no exchange is added (anti-joining the full join's coalesced keys would
    re-shuffle it).  Catalyst does not rewrite full join + IS NULL into anti
    joins by itself."""
    inv = invoices.select(*keys)
    return (orders.join(inv, keys, "left_anti")
            .join(deliveries.join(inv, keys, "left_anti"), keys, "full"))


def dms_order_map(orders: DataFrame, normalize: bool = True, dedupe: bool = True) -> DataFrame:
    """Cross-reference (external order no., item) -> sale order no."""
    item = norm_code("item_code", orders.schema["item_code"].dataType) if normalize else F.col("item_code")
    m = (orders.where(F.col("external_order_no").isNotNull())
         .select(F.col("external_order_no").alias("__ext"), item.alias("__item"),
                 F.col("sale_order_no").alias("__sale")))
    return m.distinct() if dedupe else m


def map_dms_to_oms(to_map: DataFrame, orders: DataFrame, dms_col: str = "dms_order_no",
                   normalize: bool = True, dedupe: bool = True) -> DataFrame:
    """Give invoices that carry only a DMS number the OMS sale order number.

    Inner join on two columns (no concatenated key); unmapped rows drop.  With
    ``dedupe`` the map is distinct, so a repeated order line cannot multiply
    invoice rows; an item sold on several orders still maps to each."""
    m = dms_order_map(orders, normalize, dedupe)
    item = norm_code("item_code", to_map.schema["item_code"].dataType) if normalize else F.col("item_code")
    j = to_map.join(m, (F.col(dms_col) == F.col("__ext")) & (item == F.col("__item")), "inner")
    return j.withColumn("oms_order_no", F.col("__sale")).drop("__ext", "__item", "__sale")
