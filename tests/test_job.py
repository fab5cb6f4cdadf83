"""End to end: the sf0.001 legs written as SQL dumps and monthly invoice
files, read back by the job (parse, layouts, shifted-column repair, header
resolution, staging), must reconcile to the golden class counts."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from trimatch.plans import jobs
from trimatch.plans import reconcile as R
from trimatch.plans import spec as S
from trimatch.plans.accounting import leg_accounting
from trimatch.sources import tpch_legs as L

SF = "/root/testdata/sf0.001"


def _values_lines(df, cols):
    def tok(c):
        v = F.col(c).cast("string")
        if dict(df.dtypes)[c] == "timestamp":
            v = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return F.when(v.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), v, F.lit("'")))
    return df.select(F.concat(F.lit("VALUES ("), F.concat_ws(", ", *[tok(c) for c in cols]), F.lit(");")).alias("value"))


def _write_dump(df, cols, path, header=None):
    lines = _values_lines(df, cols)
    if header:
        lines = df.sparkSession.createDataFrame([(header,)], "value string").union(lines)
    lines.coalesce(1).write.mode("overwrite").text(path)
    return path


@pytest.fixture(scope="module")
def extracts(spark):
    """The sf0.001 legs as order/delivery dumps and monthly invoice CSVs."""
    lg = L.legs(spark, SF)
    d = tempfile.mkdtemp(prefix="trimatch-job-")
    early, late = L.order_extracts(lg.orders)
    o1 = _write_dump(early, L.ORDER_COLS_11, f"{d}/orders_01_09.sql")
    o2 = _write_dump(late, L.ORDER_COLS_13, f"{d}/orders_10_12.sql", header="INSERT INTO orders VALUES")
    shifted = L.shifted_delivery_file(lg.deliveries)
    d1 = _write_dump(shifted.where("src_file = 'early'"), L.DELIVERY_COLS_7, f"{d}/delivery_01_09.sql")
    d2 = _write_dump(shifted.where("src_file = 'late'"), L.DELIVERY_COLS_7, f"{d}/delivery_10_12.sql")
    raw = L.invoice_with_source_headers(lg.invoices).drop("src_pos")
    m = F.month(F.to_timestamp(F.col("开票日期")))
    inv_paths = []
    for name, cond in (("2025-01", m <= 9), ("2025-10", m > 9)):
        p = f"{d}/inv/{name}.csv"
        raw.where(cond).coalesce(1).write.mode("overwrite").option("header", True).csv(p)
        inv_paths.append(p)
    return d, o1, o2, d1, d2, inv_paths


def test_job_reproduces_golden_counts(spark, extracts):
    d, o1, o2, d1, d2, inv_paths = extracts
    orders = jobs.load_orders(spark, [o1, o2])
    deliveries = jobs.load_deliveries(spark, [d1, d2])
    invoices = jobs.load_invoices(spark, inv_paths, "OMS")
    assert (orders.count(), deliveries.count(), invoices.count()) == (6000, 5412, 5540)
    o, dl, i = jobs.stage_inputs(spark, "job-test", orders, deliveries, invoices, refresh=True)
    out = f"{d}/out"
    counts = jobs.run(spark, S.OMS, o, dl, i, out)
    assert counts[S.FULL_MATCH] == 1076 and counts[S.AMOUNT_DIFFERS] == 180
    assert counts[S.QTY_DIFFERS] == 62 and counts[S.BOTH_DIFFER] == 17 and counts[S.NOT_TEST] == 780
    assert spark.read.parquet(f"{out}/match/detail").count() == 2115
    assert os.path.isdir(f"{out}/scenes/label=To B (OMS)")
    assert spark.read.parquet(f"{out}/uninvoiced").count() == 2399 + 1046 + 266

    b = {r["missing"]: r["n_rows"] for r in jobs.breakdown(spark, out).collect()}
    assert (b[S.MISSING_ORDER], b[S.MISSING_DELIVERY], b[S.MISSING_BOTH]) == (578, 146, 56)
    findings = {(r["table"], r["finding"]) for r in jobs.check(spark, o, dl, i).collect()}
    assert ("orders", "ok") in findings and ("deliveries", "ok") in findings
    assert ("invoices", "missing") not in findings

    jobs.ledgers(spark, [o1, o2], [d1, d2], f"{d}/ledger")
    summ = {r["item"]: r["value"] for r in spark.read.option("header", True).csv(f"{d}/ledger/summary").collect()}
    assert (summ["订单总金额"], summ["订单总数量"], summ["订单记录数"]) == ("301,270,840.87", "152,257", "6,000")
    assert (summ["发货总数量"], summ["发货记录数"]) == ("136,654", "5,412")
    led = spark.read.option("header", True).csv(f"{d}/ledger/order_ledger")
    assert led.count() == 6000 and {"业务日期", "支付金额"} <= set(led.columns)
    acc = spark.read.parquet(f"{out}/accounting")
    assert {r["leg"]: r["n"] for r in acc.groupBy("leg").agg(F.sum("n_rows").alias("n")).collect()} == \
        {"orders": 6000, "deliveries": 5412, "invoices": 5540}

    jobs.split_types(spark, inv_paths, f"{d}/types")
    assert sorted(x for x in os.listdir(f"{d}/types") if x.startswith("label=")) == \
        ["label=标准发票（2B)", "label=标准发票（2C)", "label=标准退货发票"]

    dms_inv = jobs.load_invoices(spark, inv_paths, "DMS")
    assert {"dms_order_no", "amount", "qty_sales_unit", "qty_base_unit", "item_code", "invoice_type"} <= set(dms_inv.columns)
    counts = jobs.run(spark, S.DMS, o, dl, dms_inv, f"{d}/out_dms", labels=True)
    assert "SAP开票含税金额" in spark.read.parquet(f"{d}/out_dms/match/detail").columns
    assert [counts[c] for c in (S.FULL_MATCH, S.AMOUNT_DIFFERS, S.QTY_DIFFERS, S.BOTH_DIFFER, S.NOT_TEST)] == \
        [326, 61, 35, 9, 367]


def _rows(accounting):
    return sorted(tuple(r) for r in accounting)


@pytest.mark.parametrize("spec", [S.OMS, S.DMS, S.OMS.with_(map_dms_invoices=True), S.OMS.with_(period=("1997-01-01", "1998-01-01"), strict=True)])
def test_run_observes_the_accounting(spark, spec):
    lg = L.with_missing_keys(L.legs(spark, SF))
    out = tempfile.mkdtemp(prefix="trimatch-observed-")
    counts = jobs.run(spark, spec, lg.orders, lg.deliveries, lg.invoices, out)
    want = leg_accounting(lg.orders, lg.deliveries, lg.invoices, spec).collect()
    assert counts.observed and _rows(counts.accounting) == _rows(want)
    assert _rows(spark.read.parquet(f"{out}/accounting").collect()) == _rows(want)
    plain = R.reconcile(lg.orders, lg.deliveries, lg.invoices, spec)
    got = spark.read.parquet(f"{out}/match/detail").drop("org_group", "part").select(plain.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    used = sum(r.n_rows for r in want if (r.leg, r.outcome) == ("invoices", "used"))
    if spec.map_dms_invoices:       # here no item has several orders, so no row is multiplied
        assert R.oms_invoices_used(lg.invoices, R.oms_filtered_orders(lg.orders, spec), spec).where(
            "oms_order_no is not null and item_code is not null").count() == used
        assert {r.reason for r in want if r.leg == "invoices"} >= {"mapped", "unmapped"}


def test_a_mapped_run_writes_the_allocation(spark, mk):
    o = mk.orders([dict(sale_order_no=f"DD{k}", item_code="7", external_order_no="55", order_type="oem_order", item_num=2, pay_amount=4) for k in (1, 2)])
    i = mk.invoices([dict(dms_order_no="55", item_code="7", qty=3, amount=6, invoice_no="a")])
    out = tempfile.mkdtemp(prefix="trimatch-alloc-")
    jobs.run(spark, S.OMS.with_(map_dms_invoices=True), o, mk.deliveries([]), i, out)
    got = {(r.oms_order_no, r.status): (r.qty, r.amount) for r in spark.read.parquet(f"{out}/dms_allocation").collect()}
    assert got == {("DD1", "allocated"): (2, 4), ("DD2", "allocated"): (1, 2)}


def test_a_match_without_invoices_counts_its_legs_apart(spark, mk):
    o = mk.orders([dict(sale_order_no="DD1", item_code="1", pay_amount=1, item_num=1, external_order_no="1")])
    counts = jobs.run(spark, S.OMS, o, mk.deliveries([]), mk.invoices([]), tempfile.mkdtemp(prefix="trimatch-none-"))
    assert dict(counts) == {} and [(r.leg, r.outcome, r.n_rows) for r in counts.accounting] == [("orders", "used", 1)]


def test_items_of_several_orders_are_reported(spark, mk):
    o = mk.orders([dict(sale_order_no=f"DD{i}", item_code="7.0", external_order_no="55", order_type="oem_order") for i in (1, 2)]
                  + [dict(sale_order_no="DD3", item_code="8", external_order_no="55")] * 2)
    i = mk.invoices([dict(dms_order_no="55", item_code=c, amount=3) for c in ("7", "8", "9", None)])
    spec = S.OMS.with_(map_dms_invoices=True)
    got = {(r.outcome, r.reason): r.n_rows for r in leg_accounting(o, mk.deliveries([]), i, spec).collect() if r.leg == "invoices"}
    assert got == {("used", "mapped to several orders"): 1, ("used", "mapped"): 1, ("filtered", "unmapped"): 1, ("set aside", "no item code"): 1}


def test_cli_match(spark, extracts, capsys):
    d, o1, o2, d1, d2, inv_paths = extracts
    jobs.main(["match", "OMS", "--orders", o1, o2, "--deliveries", d1, d2,
               "--invoices", *inv_paths, "--out", f"{d}/cli", "--refresh"])
    lines = dict(line.split("\t", 1) for line in capsys.readouterr().out.splitlines()
                 if "\t" in line and not line.startswith("check"))
    assert lines[S.FULL_MATCH] == "1076" and lines[S.NOT_TEST] == "780" and lines[S.ALL_DATA] == "2115"


def test_cli_options_take_effect(spark, extracts, capsys):
    d, o1, o2, d1, d2, inv_paths = extracts
    args = ["match", "OMS", "--orders", o1, o2, "--deliveries", d1, d2, "--invoices", *inv_paths]
    jobs.main([*args, "--out", f"{d}/legacy", "--legacy-total", "--format", "csv", "--labels"])
    summary = spark.read.option("header", True).csv(f"{d}/legacy/match/summary")
    assert summary.where(F.col("category") == S.GRAND_TOTAL).count() == 2
    b = {r["missing"]: r["n_rows"] for r in jobs.breakdown(spark, f"{d}/legacy", "csv").collect()}
    assert (b[S.MISSING_ORDER], b[S.MISSING_DELIVERY], b[S.MISSING_BOTH]) == (578, 146, 56)
    assert spark.read.option("header", True).csv(f"{d}/legacy/rejected").count() == 0
    with pytest.raises(ValueError, match="external_order_no"):
        jobs.main([*args, "--out", f"{d}/mapped", "--map-dms"])


def test_cli_keeps_parsed_files(spark, extracts, capsys):
    d, o1, o2, d1, d2, inv_paths = extracts
    name = os.path.basename(d)

    def run(orders, out):
        jobs.main(["match", "OMS", "--orders", *orders, "--deliveries", d1, d2, "--invoices", *inv_paths, "--out", f"{d}/{out}", "--keep", name])
        return dict(line.split("\t", 1) for line in capsys.readouterr().out.splitlines() if "\t" in line and not line.startswith("check"))
    assert run([o1], "kept-early")["parsed"] == "5"
    lines = run([o1, o2], "kept-all")
    assert (lines["parsed"], lines[S.FULL_MATCH], lines[S.NOT_TEST], lines[S.ALL_DATA]) == ("1", "1076", "780", "2115")
    with pytest.raises(SystemExit):
        jobs.main(["match", "OMS", "--orders", o1, "--deliveries", d1, "--invoices", *inv_paths, "--out", d, "--keep", name, "--refresh"])
