"""A key holding a third of all rows: results stay exact and whole."""

from decimal import Decimal

from pyspark.sql import functions as F

from trimatch.plans import spec as S
from trimatch.plans.reconcile import oms_invoice_totals, reconcile
from trimatch.plans.summary import category_summary

N = 30_000


def _legs(spark):
    i = F.col("id")
    hot = (i % 3 == 0)
    order_no = F.when(hot, F.lit("DDHOT")).otherwise(F.concat(F.lit("DD"), i.cast("string")))
    base = spark.range(N).select(i, order_no.alias("k"), hot.alias("hot"))
    one = F.lit("1.00").cast("decimal(18,2)")
    orders = base.select(F.col("k").alias("sale_order_no"), F.col("id").cast("string").alias("platform_order_no"),
                         F.when(F.col("hot"), "EHOT").alias("external_order_no"),
                         F.lit("oem_order").alias("order_type"), F.lit("DONE").alias("order_status"),
                         F.lit("OMS-X").alias("channel_name"), F.lit("7").alias("item_code"),
                         one.alias("pay_amount"), one.alias("item_num"),
                         F.lit("o").alias("src_file"), F.col("id").alias("src_pos"))
    deliveries = base.select(F.lit(None).cast("string").alias("main_no"), F.col("k").alias("order_no"),
                             F.lit("7").alias("item_code"), one.alias("shipped_qty"),
                             F.lit("d").alias("src_file"), F.col("id").alias("src_pos"))
    invoices = base.select(F.col("k").alias("oms_order_no"), F.lit(None).cast("string").alias("dms_order_no"),
                           F.lit("7").alias("item_code"), F.lit("标准发票（2B)").alias("invoice_type"),
                           one.alias("amount"), one.alias("qty"), F.lit("1240").alias("sales_org"),
                           F.lit("i").alias("src_file"), F.col("id").alias("src_pos"))
    return orders, deliveries, invoices


def test_hot_key_totals_exact(spark):
    o, d, i = _legs(spark)
    r = reconcile(o, d, i, S.OMS, carry={"inv_sales_org"})
    hot = r.where("order_no = 'DDHOT'").first()
    assert hot["invoice_amount"] == Decimal(N // 3) and hot["order_qty"] == Decimal(N // 3)
    assert hot["category"] == S.FULL_MATCH and hot["inv_sales_org"] == "1240"
    s = {x["category"]: x["n_rows"] for x in category_summary(r).collect()}
    assert s == {S.FULL_MATCH: 1 + N - N // 3, S.ALL_DATA: 1 + N - N // 3}


def test_hot_dms_number_maps_without_fan_out(spark):
    o, d, i = _legs(spark)
    to_map = i.withColumn("dms_order_no", F.when(F.col("oms_order_no") == "DDHOT", "EHOT")) \
              .withColumn("oms_order_no", F.when(F.col("oms_order_no") != "DDHOT", F.col("oms_order_no")))
    spec = S.OMS.with_(map_dms_invoices=True)
    t = oms_invoice_totals(to_map, o, spec, carry=False)
    hot = t.where("order_no = 'DDHOT'").first()
    assert hot["invoice_amount"] == Decimal(N // 3)                      # 10,000 order lines, no fan-out
    assert t.count() == 1 + N - N // 3
