"""Plan-shape checks: what the engine promises about shuffles and scans."""

from trimatch.plans import spec as S
from trimatch.plans.reconcile import reconcile
from trimatch.plans.report import DMS_REPORT_LABELS, label_columns, report_columns
from trimatch.sources import tpch_legs as L

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_round_robin_in_any_leg(spark):
    lg = L.legs(spark, SF)
    r = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS, carry=False)
    assert "RoundRobin" not in _plan(r)


def test_joins_reuse_aggregate_partitioning(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        lg = L.legs(spark, SF)
        plan = _plan(reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS, carry=False)
                     .select("order_no", "item_code", "category"))
        keyed = [line for line in plan.split("\n") if "Exchange hashpartitioning(order_no" in line]
        assert len(keyed) == 3                                           # one per leg, none for the joins
        assert plan.count("SortMergeJoin [order_no") == 2                # the two leg joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_summary_reads_no_carried_columns(spark):
    lg = L.legs(spark, SF)
    r = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS)              # all attributes requested
    from trimatch.plans.summary import category_summary
    plan = _plan(category_summary(r))
    assert "min_by" not in plan and "SortAggregate" not in plan          # pruned by Catalyst


def test_carry_selection(spark):
    lg = L.legs(spark, SF)
    none = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS, carry=False).columns
    some = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS, carry={"inv_sales_org"}).columns
    assert not [c for c in none if c.startswith(("ord_", "dlv_", "inv_"))]
    assert [c for c in some if c.startswith(("ord_", "dlv_", "inv_"))] == ["inv_sales_org"]


def test_report_labels_and_order(spark):
    lg = L.legs(spark, SF)
    r = reconcile(lg.orders, lg.deliveries, lg.invoices, S.DMS, carry={"inv_sales_org", "inv_invoice_no"})
    out = label_columns(r, DMS_REPORT_LABELS)
    assert "DMS订单" in out.columns and "SAP开票含税金额" in out.columns and "order_no" not in out.columns
    oms = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS, carry={"inv_dms_order_no", "inv_sales_org"})
    assert report_columns(oms).columns[-1] == "inv_dms_order_no"
