"""Sinks, staging, monthly invoice files, streaming staging, quality checks."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from trimatch.operators.quality import check_schema, null_share
from trimatch.plans import spec as S
from trimatch.plans.reconcile import reconcile
from trimatch.plans.report import write_by_label, write_report
from trimatch.sources import tpch_legs as L
from trimatch.sources.invoices import monthly_paths, read_monthly_invoices
from trimatch.sources.staging import read_back, stage
from trimatch.streaming.invoice_drop import stage_invoice_stream

SF = "/root/testdata/sf0.001"


def test_write_report_layout_and_caps(spark):
    lg = L.legs(spark, SF)
    r = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS)
    out = tempfile.mkdtemp(prefix="trimatch-report-")
    assert write_report(r, out, max_rows=500)[S.ALL_DATA] == 2115
    detail = spark.read.parquet(f"{out}/detail")
    assert detail.count() == 2115
    groups = {x["org_group"] for x in detail.select("org_group").distinct().collect()}
    assert groups == {S.ORG_GROUP_SPLIT, S.ORG_GROUP_REST}
    nt_dir = os.path.join(out, "detail", f"org_group={S.ORG_GROUP_REST}", f"category={S.NOT_TEST}")
    assert os.path.isdir(nt_dir)
    for root, _, files in os.walk(f"{out}/detail"):
        for f in files:
            if f.endswith(".parquet"):
                assert spark.read.parquet(os.path.join(root, f)).count() <= 500
    assert detail.columns[-3:] == ["inv_dms_order_no", "org_group", "category"][-3:] or \
        "inv_dms_order_no" in detail.columns
    summ = spark.read.parquet(f"{out}/summary")
    tot = {(x["org_group"], x["category"]): x["n_rows"] for x in summ.collect()}
    assert tot[(S.ORG_GROUP_SPLIT, S.ALL_DATA)] + tot[(S.ORG_GROUP_REST, S.ALL_DATA)] == 2115


def test_write_report_csv_and_empty(spark):
    lg = L.legs(spark, SF)
    r = reconcile(lg.orders, lg.deliveries, lg.invoices, S.OMS)
    out = tempfile.mkdtemp(prefix="trimatch-report-")
    assert write_report(r.where(F.col("category") == S.NOT_TEST), out, fmt="csv")
    back = read_back(spark, f"{out}/detail", fmt="csv")
    assert back.count() == 780
    assert back.where(F.col("shipped_qty").isNull()).count() == 146 + 56     # the marker reads as NULL
    assert read_back(spark, f"{out}/detail", fmt="csv", null_value="").where(F.col("shipped_qty") == "N/A").count() == 146 + 56
    empty = tempfile.mkdtemp(prefix="trimatch-report-")
    assert write_report(r.where(F.lit(False)), f"{empty}/x") is None
    assert not os.path.exists(f"{empty}/x")


def test_write_by_label(spark, mk):
    inv = mk.invoices([{"invoice_type": "a/b"}, {"invoice_type": "a/b"}, {"invoice_type": None}, {"invoice_type": "c"}])
    out = tempfile.mkdtemp(prefix="trimatch-label-")
    write_by_label(inv, "invoice_type", out)
    assert sorted(d for d in os.listdir(out) if d.startswith("label=")) == ["label=a_b", "label=c"]
    assert spark.read.parquet(out).count() == 3


def test_stage_reuses_existing(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    a = stage(spark, "unit-stage", build, refresh=True)
    b = stage(spark, "unit-stage", build)
    assert a.count() == b.count() == 5 and len(calls) == 1


def test_staged_legs_equal_derived(spark):
    from trimatch.plans.queries import oms_category_summary
    before = sorted(tuple(r) for r in oms_category_summary(spark, SF).collect())
    L.stage_legs(spark, SF, refresh=True)
    try:
        after = sorted(tuple(r) for r in oms_category_summary(spark, SF).collect())
    finally:
        L.unstage_legs(SF)
    assert before == after


def _csv(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_monthly_invoice_union(spark):
    d = tempfile.mkdtemp(prefix="trimatch-inv-")
    _csv(f"{d}/2025-01.csv", ["OMS销售单号", "物料编码", "实际金额"], [["DD1", "7", "1.5"]])
    _csv(f"{d}/2025-02.csv", ["OMS销售单号", "物料编码", "发票备注"], [["DD2", "8", "r"]])
    with open(f"{d}/2025-03.csv", "wb") as f:
        f.write(b"")                                                      # unreadable
    paths = monthly_paths(spark, d, 2025)
    assert [os.path.basename(p) for p in paths] == ["2025-01.csv", "2025-02.csv", "2025-03.csv"]
    with pytest.raises(ValueError, match="2025-03"):
        read_monthly_invoices(spark, paths)
    skipped = []
    u = read_monthly_invoices(spark, paths, skipped=skipped)
    rows = {r["OMS销售单号"]: r for r in u.collect()}
    assert rows["DD1"]["发票备注"] is None and rows["DD2"]["实际金额"] is None
    assert rows["DD1"]["src_file"] == "2025-01.csv"
    assert [os.path.basename(p) for p, _ in skipped] == ["2025-03.csv"]


def test_first_value_is_the_first_months(spark):
    """One key in two months: whatever Spark does with the rows, the month
    listed first gives the carried value."""
    from trimatch.operators.resolve import resolve_invoice_columns
    from trimatch.plans.reconcile import oms_invoice_totals
    d = tempfile.mkdtemp(prefix="trimatch-inv-")
    head = ["OMS销售单号", "物料编码", "实际金额", "开票数量", "销售组织"]
    _csv(f"{d}/2025-01.csv", head, [["DD0", "1", "1", "1", "1"]] * 5 + [["DD1", "7", "1", "1", "1240"]])
    _csv(f"{d}/2025-02.csv", head, [["DD1", "7", "1", "1", "1270"]])
    inv = resolve_invoice_columns(read_monthly_invoices(spark, monthly_paths(spark, d, 2025)), "OMS")
    for n in (1, 3, 8):
        got = {r["order_no"]: r for r in oms_invoice_totals(inv.repartition(n)).collect()}
        assert got["DD1"]["inv_sales_org"] == "1240" and got["DD1"]["inv_src_file"] == "2025-01.csv"


def test_one_year_is_staged_by_several_tasks(spark):
    """A year's rows aren't sent through one task: AQE splits the rebalance."""
    from trimatch.sources.staging import by_period
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        df = spark.range(0, 200_000, numPartitions=16).selectExpr("id", "timestamp'2025-03-01' + make_dt_interval(id % 200) as t")
        out = tempfile.mkdtemp(prefix="trimatch-year-")
        by_period(df, "t").write.mode("overwrite").partitionBy("period_year").parquet(out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(f"{out}/period_year=2025") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(out).count() == 200_000


def test_new_extracts_are_not_served_the_old_table(spark):
    from trimatch.sources.files import inputs_digest
    d = tempfile.mkdtemp(prefix="trimatch-dig-")
    _csv(f"{d}/a.csv", ["x"], [["1"]])
    one = inputs_digest(spark, [f"{d}/a.csv"], "OMS")
    assert one == inputs_digest(spark, [f"{d}/a.csv"], "OMS") != inputs_digest(spark, [f"{d}/a.csv"], "DMS")
    _csv(f"{d}/a.csv", ["x"], [["1"], ["2"]])
    assert one != inputs_digest(spark, [f"{d}/a.csv"], "OMS")


def test_accounting_covers_every_row(spark, mk):
    from trimatch.plans.accounting import leg_accounting, set_aside
    o = mk.orders([{"sale_order_no": "DD1", "item_code": None, "pay_amount": 3}, {"sale_order_no": "DD1", "item_code": "1"},
                   {"sale_order_no": "DD2", "item_code": "1", "order_status": "CANCEL"}])
    i = mk.invoices([{"oms_order_no": "DD1", "item_code": None, "amount": 5}, {"dms_order_no": "9", "item_code": "1"}])
    got = {(r["leg"], r["outcome"], r["reason"]): r["n_rows"] for r in leg_accounting(o, mk.deliveries([]), i).collect()}
    assert got == {("orders", "set aside", "no item code"): 1, ("orders", "used", ""): 1, ("orders", "filtered", "status"): 1,
                   ("invoices", "set aside", "no item code"): 1, ("invoices", "filtered", "needs map"): 1}
    assert [(r["leg"], r["order_no"], r["measure"]) for r in set_aside(o, mk.deliveries([]), i).orderBy("leg").collect()] == \
        [("invoices", "DD1", "5.00"), ("orders", "DD1", "3.00")]


def test_invoice_stream_stages_new_files_once(spark):
    src = tempfile.mkdtemp(prefix="trimatch-drop-")
    out = tempfile.mkdtemp(prefix="trimatch-staged-")
    ck = tempfile.mkdtemp(prefix="trimatch-ck-")
    schema = "oms_order_no string, item_code string, amount string"
    _csv(f"{src}/2025-01.csv", ["oms_order_no", "item_code", "amount"], [["DD1", "7", "1.5"]])
    q = stage_invoice_stream(spark, src, schema, out, checkpoint=ck)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    _csv(f"{src}/2025-02.csv", ["oms_order_no", "item_code", "amount"], [["DD2", "8", "2"], ["DD3", "9", "3"]])
    q = stage_invoice_stream(spark, src, schema, out, checkpoint=ck)
    q.awaitTermination(120)
    staged = spark.read.parquet(out)
    assert staged.count() == 3
    from trimatch.plans.reconcile import oms_invoice_totals
    from trimatch.streaming.invoice_drop import staged_invoices
    named = staged.withColumnsRenamed({"oms_order_no": "OMS销售单号", "item_code": "物料编码", "amount": "实际金额"}) \
        .withColumn("开票数量", F.lit("1"))
    named.write.mode("overwrite").partitionBy("src_month").parquet(f"{out}-named")
    totals = oms_invoice_totals(staged_invoices(spark, f"{out}-named"))
    assert {r["order_no"]: float(r["invoice_amount"]) for r in totals.collect()} == {"DD1": 1.5, "DD2": 2, "DD3": 3}
    assert {r["src_month"] for r in staged.select("src_month").distinct().collect()} == {"2025-01", "2025-02"}


def test_streamed_months_keep_the_order_of_their_files(spark):
    from trimatch.plans.reconcile import oms_invoice_totals
    from trimatch.streaming.invoice_drop import staged_invoices
    src, out, ck = (tempfile.mkdtemp(prefix=f"trimatch-{x}-") for x in ("drop", "staged", "ck"))
    head = ["OMS销售单号", "物料编码", "实际金额", "开票数量", "备注"]
    schema = ", ".join(f"`{c}` string" for c in head)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for drop in (["2025-02-b", "2025-02-a"], ["2025-01"]):       # the earliest month comes last
            for name in drop:
                _csv(f"{src}/{name}.csv", head, [[f"DD{k}", "7", "1", "1", f"{name}/{k}/{n}"] for n in range(2) for k in range(300 if name == "2025-02-b" else 100)])
            q = stage_invoice_stream(spark, src, schema, out, checkpoint=ck)
            q.awaitTermination(120)
            rows = oms_invoice_totals(staged_invoices(spark, out), carry={"inv_remark"}).collect()
            first = drop[-1]
            assert {r["order_no"]: r["inv_remark"] for r in rows} == {
                f"DD{k}": f"{first}/{k}/0" if k < 100 else f"2025-02-b/{k}/0" for k in range(300)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(int(r["invoice_qty"]) for r in rows) == 1000


def test_quality_checks(spark):
    lg = L.legs(spark, SF)
    early, late = L.order_extracts(lg.orders)
    f = {r["finding"] for r in check_schema(spark, early, L.ORDER_COLS_13, "orders").collect()}
    assert "missing" in f
    ok = check_schema(spark, late.select(*L.ORDER_COLS_13), L.ORDER_COLS_13, "orders").first()
    assert ok["finding"] == "ok"
    from trimatch.sources.invoices import align_union
    ns = {r["period"]: r for r in null_share(align_union([early, late]), "line_amount", "create_time").collect()}
    assert ns["early"]["mostly_null"] and not ns["late"]["mostly_null"]
