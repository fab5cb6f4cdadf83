"""Properties of the reconciliation."""

from pyspark.sql import functions as F

from trimatch.plans import spec as S
from trimatch.plans.reconcile import oms_delivery_totals, oms_invoice_totals, oms_order_totals, reconcile
from trimatch.plans.summary import category_summary
from trimatch.operators.join import uninvoiced
from trimatch.sources import tpch_legs as L

SF = "/root/testdata/sf0.001"


def test_classes_partition_rows_and_keys_unique(spark):
    lg = L.legs(spark, SF)
    for spec in (S.OMS, S.DMS):
        r = reconcile(lg.orders, lg.deliveries, lg.invoices, spec)
        inv_keys = (oms_invoice_totals(lg.invoices) if spec is S.OMS else None)
        n = r.count()
        assert r.select("order_no", "item_code").distinct().count() == n      # one row per invoice key
        assert r.where(F.col("category").isin(*S.CATEGORIES)).count() == n    # exactly one class each
        if inv_keys is not None:
            assert inv_keys.count() == n
        s = {x["category"]: (x["n_rows"], x["invoice_amount"]) for x in category_summary(r).collect()}
        assert sum(v[0] for k, v in s.items() if k != S.ALL_DATA) == s[S.ALL_DATA][0]
        assert sum(v[1] for k, v in s.items() if k != S.ALL_DATA) == s[S.ALL_DATA][1]


def test_uninvoiced_disjoint_from_invoiced(spark):
    lg = L.legs(spark, SF)
    o, d, i = oms_order_totals(lg.orders), oms_delivery_totals(lg.deliveries), oms_invoice_totals(lg.invoices)
    u = uninvoiced(o.select("order_no", "item_code"), d.select("order_no", "item_code"), i)
    assert u.join(i, ["order_no", "item_code"], "inner").count() == 0
    union_keys = o.select("order_no", "item_code").union(d.select("order_no", "item_code")).distinct()
    assert u.count() == union_keys.join(i, ["order_no", "item_code"], "left_anti").count()


def test_result_independent_of_partitioning(spark):
    lg = L.legs(spark, SF)
    base = sorted(tuple(r) for r in category_summary(reconcile(lg.orders, lg.deliveries, lg.invoices)).collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        shuffled = [x.repartition(5) for x in (lg.orders, lg.deliveries, lg.invoices)]
        other = sorted(tuple(r) for r in category_summary(reconcile(*shuffled)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == other


def test_legacy_total_row_doubles_all_data(spark):
    lg = L.legs(spark, SF)
    r = reconcile(lg.orders, lg.deliveries, lg.invoices, carry=False)
    s = {x["category"]: (x["n_rows"], x["invoice_amount"]) for x in category_summary(r, legacy_total=True).collect()}
    assert s[S.GRAND_TOTAL][0] == 2 * s[S.ALL_DATA][0]
    assert s[S.GRAND_TOTAL][1] == 2 * s[S.ALL_DATA][1]
