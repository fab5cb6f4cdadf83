"""Micro-fixtures for each policy (FIXTURES.md §5)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trimatch.functions import codes, dates, numbers
from trimatch.operators import filters, resolve
from trimatch.operators.aggregate import aggregate_leg, first_non_null, first_row, leg_sum
from trimatch.operators.classify import invoice_scene, org_group
from trimatch.operators.repair import repair_shift, shift_flags
from trimatch.plans import spec as S
from trimatch.plans.reconcile import oms_invoice_totals, reconcile


# --- shift repair -----------------------------------------------------------

def _shift_df(spark, rows):
    return spark.createDataFrame(rows, "src_file string, order_no string, item_code string")


def test_shift_exactly_half_does_not_swap(spark):
    rows = [("f", "123", "DD1"), ("f", "DD2", "456")]
    assert shift_flags(_shift_df(spark, rows)).first()["swapped"] is False


def test_shift_majority_swaps_whole_file(spark):
    rows = [("f", "123", "DD1"), ("f", "124", "DD2"), ("f", "DD3", "125"), ("g", "DD9", "9")]
    out = {(r["src_file"], r["item_code"]): r["order_no"] for r in repair_shift(_shift_df(spark, rows)).collect()}
    assert out[("f", "123")] == "DD1" and out[("f", "DD3")] == "125"   # whole file swapped
    assert out[("g", "9")] == "DD9"                                   # other file untouched


def test_shift_nulls_and_empty(spark):
    rows = [("f", None, "DD1"), ("f", "12", None), ("f", "13", "DD2")]
    f = shift_flags(_shift_df(spark, rows)).first()
    assert (f["digits_col2"], f["dd_col5"], f["swapped"]) == (2, 2, True)
    assert repair_shift(_shift_df(spark, [])).count() == 0


# --- numbers and dates ------------------------------------------------------

def test_large_amounts_sum_exactly(mk):
    from trimatch.plans.reconcile import oms_order_totals
    import pyspark.sql.functions as F
    o = mk.orders([{"sale_order_no": "DD1", "item_code": "1", "pay_amount": "1"}] * 2) \
        .withColumn("pay_amount", F.lit("1000000000000.25"))
    assert str(oms_order_totals(o, carry=False).first()["order_amount"]) == "2000000000000.50"


def test_double_codes_match_their_text(spark, mk):
    from trimatch.plans.reconcile import oms_order_totals
    import pyspark.sql.functions as F
    o = mk.orders([{"sale_order_no": "DD1", "item_code": "1", "pay_amount": "1"}]).withColumn("item_code", F.lit(12345678.0))
    assert oms_order_totals(o, carry=False).first()["item_code"] == "12345678"


def test_safe_number(spark):
    df = spark.createDataFrame([(v,) for v in ["", " 12.5 ", "1e3", "1,234.5", "abc", None, "inf", "-3"]], "v string")
    got = [r[0] for r in df.select(numbers.safe_number("v")).collect()]
    assert got == [None, Decimal("12.5"), Decimal("1000"), None, None, None, None, Decimal("-3")]


def test_all_null_group_sums_to_zero_and_half_up(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "0.125"), ("b", "0.125")], "k string, v string")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(leg_sum("v", True).alias("s")).collect()}
    assert got == {"a": Decimal("0.00"), "b": Decimal("0.26")}          # 0.125 -> 0.13 per line
    after = {r["k"]: r["s"] for r in df.groupBy("k").agg(leg_sum("v", False).alias("s")).collect()}
    assert after["b"] == Decimal("0.25")


def test_safe_timestamp_and_period(spark):
    df = spark.createDataFrame([("2025-01-31 23:59:59",), ("2025/02/01",), ("20251231",), ("bad",), (None,)], "v string")
    ts = [r[0] for r in df.select(dates.safe_timestamp("v")).collect()]
    assert ts[:3] == [dt.datetime(2025, 1, 31, 23, 59, 59), dt.datetime(2025, 2, 1), dt.datetime(2025, 12, 31)]
    assert ts[3:] == [None, None]
    inside = df.select(dates.safe_timestamp("v").alias("t")).where(dates.in_period("t", "2025-01-01", "2025-02-01"))
    assert inside.count() == 1


def test_codes(spark):
    df = spark.createDataFrame([(12345678.0, "12.0", "DD9", "S1"), (1.5, "12.05", None, "S2"),
                                (3.0, "12", "XX1", "S3")], "d double, s string, m string, o string")
    from pyspark.sql.types import DoubleType
    r = df.select(codes.norm_code("d", DoubleType()).alias("d"), codes.norm_code("s").alias("s"),
                  codes.delivery_order_no("m", "o").alias("k")).collect()
    assert [x["d"] for x in r] == ["12345678", "1.5", "3"]
    assert [x["s"] for x in r] == ["12", "12.05", "12"]
    assert [x["k"] for x in r] == ["DD9", "S2", "S3"]
    lab = spark.createDataFrame([('a/b\\c:d*e?f"g<h>i|j',)], "v string").select(codes.safe_label("v")).first()[0]
    assert lab == "a_b_c_d_e_f_g_h_i_j"


# --- filters ----------------------------------------------------------------

def test_status_filter_keeps_null(spark, mk):
    o = mk.orders([{"order_status": None}, {"order_status": "CANCEL"}, {"order_status": "OBSOLETE"},
                   {"order_status": "DONE"}])
    assert sorted(filters.drop_status(o).select("order_status").collect(), key=str) == \
        sorted([(None,), ("DONE",)], key=str)


def test_invoice_type_adaptive(spark, mk):
    half = mk.invoices([{"invoice_type": "ZA01"}, {"invoice_type": "标准发票（2B)"}])
    # exactly half are codes -> text rule: only the 2B text row stays
    assert [r[0] for r in filters.filter_invoice_type_adaptive(half).select("invoice_type").collect()] == ["标准发票（2B)"]
    most = mk.invoices([{"invoice_type": "ZA01"}, {"invoice_type": "ZB06"}, {"invoice_type": "ZC09"},
                        {"invoice_type": "标准发票（2B)"}])
    assert sorted(r[0] for r in filters.filter_invoice_type_adaptive(most).select("invoice_type").collect()) == \
        ["ZA01", "ZB06"]
    texts = ["标准发票（2B)", "标准发票(2B)", "标准发票 （ 2B", "取消标准发票（2B)", "标准退货发票", "取消标准退货发票",
             "标准发票（2C)", "期货贸易发票", None]
    kept = [r[0] for r in filters.filter_invoice_type_adaptive(mk.invoices([{"invoice_type": t} for t in texts]))
            .select("invoice_type").collect()]
    assert sorted(kept) == sorted(texts[:6])


def test_invoice_type_dms_text(spark, mk):
    texts = ["标准发票（2B)", "取消标准发票（2B)", "标准退货发票", "标准发票（2C)", None]
    kept = [r[0] for r in filters.filter_invoice_type_text(mk.invoices([{"invoice_type": t} for t in texts]))
            .select("invoice_type").collect()]
    assert sorted(kept) == ["取消标准发票（2B)", "标准发票（2B)"]


def test_channel_filter(spark, mk):
    o = mk.orders([{"channel_name": "DMS-A"}, {"channel_name": "dms-b"}, {"channel_name": "OMS"}, {"channel_name": None}])
    assert filters.channel_contains(o).count() == 2
    assert filters.channel_contains(o.drop("channel_name")).count() == 4


# --- column resolution ------------------------------------------------------

def test_resolvers():
    cols = ["x", "金额ZFN1", "实际金额", "开票数量（销售单位）", "开票数量（基本单位数量）", "物料编号", "料号"]
    assert resolve.first_exact(cols, resolve.MATERIAL_CANDIDATES) == "料号"          # priority order
    assert resolve.last_contains(cols, resolve.OMS_AMOUNT_RULES) == "实际金额"       # last match wins
    assert resolve.last_contains(cols, resolve.OMS_QTY_RULES) == "开票数量（基本单位数量）"
    assert resolve.exact_then_contains(["DMS 销售 单号X"], "DMS销售单号", resolve.DMS_ORDER_TOKENS) == "DMS 销售 单号X"
    assert resolve.positional([f"c{i}" for i in range(16)]) == "c14"
    assert resolve.positional(["a"]) is None
    with pytest.raises(resolve.MissingColumn):
        resolve.require("amount", None)


def test_duplicate_type_header_and_sniff(spark):
    df = spark.createDataFrame([("ZA01", "标准发票（2B)")], "`发票类型0` string, `发票类型1` string")
    fixed = resolve.restore_duplicate_headers(df)
    assert fixed.columns == ["发票类型", "发票类型.1"]
    assert resolve.sniff_type_column(fixed) == "发票类型.1"
    codes_only = spark.createDataFrame([("ZA01",), (None,)], "`发票类型` string")
    assert resolve.sniff_type_column(codes_only) is None
    text = spark.createDataFrame([(None,), ("标准发票（2B)",)], "`发票类型` string")
    assert resolve.sniff_type_column(text) == "发票类型"
    late = spark.createDataFrame([("ZA01",)] * 100 + [("标准发票（2B)",)] * 5, "`发票类型` string")
    assert resolve.sniff_type_column(late) == "发票类型"                # however late the text appears


def test_dms_roles_missing_raise(spark):
    df = spark.createDataFrame([("1",)], "`DMS销售单号` string")
    with pytest.raises(resolve.MissingColumn):
        resolve.resolve_invoice_columns(df)


# --- classes ----------------------------------------------------------------

def _one(mk, spec, order_amt, inv_amt, order_qty, ship_qty, inv_qty, legs=("o", "d")):
    o = mk.orders([{"sale_order_no": "DD1", "platform_order_no": "1", "channel_name": "DMS-X", "item_code": "7",
                    "pay_amount": order_amt, "item_num": order_qty}] if "o" in legs else [])
    d = mk.deliveries([{"order_no": "DD1", "external_order_no": "1", "item_code": "7",
                        "shipped_qty": ship_qty}] if "d" in legs else [])
    i = mk.invoices([{"oms_order_no": "DD1", "dms_order_no": "1", "item_code": "7", "amount": inv_amt,
                      "qty": inv_qty, "qty_sales_unit": inv_qty, "qty_base_unit": inv_qty}])
    return reconcile(o, d, i, spec).first()["category"]


@pytest.mark.parametrize("order_amt,expect", [("100.99", S.FULL_MATCH), ("101.00", S.AMOUNT_DIFFERS),
                                              ("99.00", S.AMOUNT_DIFFERS), ("100.01", S.FULL_MATCH)])
def test_oms_amount_threshold(mk, order_amt, expect):
    assert _one(mk, S.OMS, order_amt, "100.00", "5", "5", "5") == expect


@pytest.mark.parametrize("ship,expect", [("5", S.FULL_MATCH), ("5.004", S.FULL_MATCH),
                                         ("5.009", S.QTY_DIFFERS), ("5.01", S.QTY_DIFFERS)])
def test_dms_qty_threshold(mk, ship, expect):
    # DMS compares base invoice qty with shipped qty only (order qty is not
    # tested); sums are rounded to cents first, so 5.009 counts as 5.01
    assert _one(mk, S.DMS, "100", "100", "999", ship, "5") == expect


def test_oms_qty_exact_and_missing_legs(mk):
    assert _one(mk, S.OMS, "100", "100", "5", "5.01", "5") == S.QTY_DIFFERS
    assert _one(mk, S.OMS, "100", "102", "4", "5", "5") == S.BOTH_DIFFER
    assert _one(mk, S.OMS, "100", "100", "5", "5", "5", legs=("d",)) == S.NOT_TEST
    assert _one(mk, S.OMS, "100", "100", "5", "5", "5", legs=("o",)) == S.NOT_TEST
    assert _one(mk, S.DMS, "100", "100", "5", "5", "5", legs=("o",)) == S.NOT_TEST


# --- first values -----------------------------------------------------------

def test_first_non_null_versus_first_row(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("k", "c", 3)], "k string, v string, src_pos long")
    r = df.groupBy("k").agg(first_non_null("v").alias("fnn"), first_row(["v"]).alias("fr")).first()
    assert r["fnn"] == "b" and r["fr"]["v"] is None


def test_aggregate_leg_first_row_mode(spark):
    df = spark.createDataFrame([("k", None, "x", "1", 2), ("k", "a", "y", "2", 1)],
                               "k string, v string, w string, m string, src_pos long")
    out = aggregate_leg(df, {"key": F.col("k")}, {"m": "m"}, {"v": "v", "w": "w"}, first="row").first()
    assert (out["v"], out["w"], out["m"]) == ("a", "y", Decimal("3.00"))


# --- mapping ----------------------------------------------------------------

def test_mapping_cases(spark, mk):
    orders = mk.orders([
        {"sale_order_no": "DD1", "external_order_no": "E1", "item_code": "7"},
        {"sale_order_no": "DD1", "external_order_no": "E1", "item_code": "7.0"},   # repeated line
        {"sale_order_no": "DD2", "external_order_no": "E2", "item_code": "8"},
        {"sale_order_no": "DD3", "external_order_no": "E2", "item_code": "8"},     # one item on two orders
    ])
    inv = mk.invoices([
        {"oms_order_no": None, "dms_order_no": "E1", "item_code": "7", "amount": "10", "qty": "1"},
        {"oms_order_no": None, "dms_order_no": "E2", "item_code": "8", "amount": "20", "qty": "1"},
        {"oms_order_no": None, "dms_order_no": "E9", "item_code": "8", "amount": "30", "qty": "1"},  # unmapped
        {"oms_order_no": "DD5", "dms_order_no": "E1", "item_code": "7", "amount": "40", "qty": "1"},  # direct
        {"oms_order_no": None, "dms_order_no": None, "item_code": "7", "amount": "50", "qty": "1"},   # neither
    ])
    spec = S.OMS.with_(map_dms_invoices=True)
    got = {(r["order_no"], r["item_code"]): r["invoice_amount"] for r in oms_invoice_totals(inv, orders, spec).collect()}
    assert got == {("DD1", "7"): Decimal("10.00"), ("DD2", "8"): Decimal("20.00"),
                   ("DD3", "8"): Decimal("20.00"), ("DD5", "7"): Decimal("40.00")}
    fan = oms_invoice_totals(inv, orders, spec.with_(dedupe_map=False)).where("order_no = 'DD1'").first()
    assert fan["invoice_amount"] == Decimal("20.00")                                  # fan-out visible
    assert oms_invoice_totals(inv, orders, S.OMS).count() == 1                        # mapping off: direct only


# --- organisations, scenes --------------------------------------------------

def test_org_group_forms(spark):
    df = spark.createDataFrame([("1240",), ("1240.0",), ("1270",), (None,)], "o string")
    assert [r[0] for r in df.select(org_group("o")).collect()] == \
        [S.ORG_GROUP_SPLIT, S.ORG_GROUP_SPLIT, S.ORG_GROUP_REST, S.ORG_GROUP_REST]
    num = spark.createDataFrame([(1240.0,), (1250.0,)], "o double")
    assert [r[0] for r in num.select(org_group("o")).collect()] == [S.ORG_GROUP_SPLIT] * 2
    assert df.select(org_group(None)).first()[0] == S.ORG_GROUP_REST


def test_scene_precedence(spark, mk):
    rows = [{"invoice_type": "标准发票（2B)", "dms_order_no": "1"}, {"invoice_type": "标准退货发票", "dms_order_no": None},
            {"invoice_type": "期货贸易发票"}, {"invoice_type": "标准发票（2C)"}, {"invoice_type": "其它"}]
    got = [r["scene"] for r in invoice_scene(mk.invoices(rows)).orderBy("src_pos").collect()]
    assert got == [S.SCENE_TO_B_DMS, S.SCENE_TO_B_OMS, S.SCENE_FUTURES, S.SCENE_TO_C, S.SCENE_DEFAULT]


# --- empty input ------------------------------------------------------------

@pytest.mark.parametrize("spec", [S.OMS, S.DMS])
@pytest.mark.parametrize("empty", ["o", "d", "i"])
def test_empty_leg_gives_typed_result(mk, spec, empty):
    o = mk.orders([] if empty == "o" else [{"sale_order_no": "DD1", "platform_order_no": "1", "channel_name": "DMS",
                                            "item_code": "7", "pay_amount": "1", "item_num": "1"}])
    d = mk.deliveries([] if empty == "d" else [{"order_no": "DD1", "external_order_no": "1", "item_code": "7",
                                                "shipped_qty": "1"}])
    i = mk.invoices([] if empty == "i" else [{"oms_order_no": "DD1", "dms_order_no": "1", "item_code": "7",
                                              "amount": "1", "qty": "1", "qty_base_unit": "1", "qty_sales_unit": "1"}])
    r = reconcile(o, d, i, spec)
    rows = r.collect()
    assert "category" in r.columns
    assert len(rows) == (0 if empty == "i" else 1)
    if empty != "i":
        assert rows[0]["category"] == S.NOT_TEST


def test_unresolved_invoice_measures_give_empty_result(mk):
    o = mk.orders([{"sale_order_no": "DD1", "item_code": "7", "pay_amount": "1", "item_num": "1"}])
    d = mk.deliveries([{"order_no": "DD1", "item_code": "7", "shipped_qty": "1"}])
    i = mk.invoices([{"oms_order_no": "DD1", "item_code": "7", "amount": "1", "qty": "1"}]).drop("qty")
    r = reconcile(o, d, i, S.OMS)
    assert r.count() == 0 and "category" in r.columns


def test_dms_partial_carries_first_row(mk):
    from trimatch.plans.reconcile import dms_invoice_totals
    i = mk.invoices([
        {"dms_order_no": "1", "item_code": "7", "amount": "1", "qty_sales_unit": "1", "qty_base_unit": "1",
         "remark": None, "invoice_no": "A"},
        {"dms_order_no": "1", "item_code": "7", "amount": "2", "qty_sales_unit": "1", "qty_base_unit": "1",
         "remark": "later", "invoice_no": "B"},
    ])
    first_row = dms_invoice_totals(i, S.DMS_PARTIAL).first()
    first_nn = dms_invoice_totals(i, S.DMS).first()
    assert (first_row["inv_remark"], first_row["inv_invoice_no"]) == (None, "A")
    assert (first_nn["inv_remark"], first_nn["inv_invoice_no"]) == ("later", "A")
    assert first_row["invoice_amount"] == first_nn["invoice_amount"] == Decimal("3.00")
