"""Golden counts of FIXTURES.md §4 at sf0.001."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trimatch.operators.classify import invoice_scene, split_by_org
from trimatch.operators.filters import filter_invoice_type_adaptive, route_invoices
from trimatch.operators.join import map_dms_to_oms
from trimatch.operators.repair import shift_flags
from trimatch.plans import reconcile as R
from trimatch.plans import spec as S
from trimatch.plans.summary import category_summary, nottest_breakdown
from trimatch.sources import tpch_legs as L

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def legs(spark):
    return L.legs(spark, SF)


def summary_map(df):
    return {r["category"]: (r["n_rows"], r["invoice_amount"]) for r in category_summary(df).collect()}


def test_leg_rows(legs):
    assert (legs.orders.count(), legs.deliveries.count(), legs.invoices.count()) == (6000, 5412, 5540)


def test_oms_classes(legs):
    s = summary_map(R.reconcile(legs.orders, legs.deliveries, legs.invoices, S.OMS))
    assert s[S.FULL_MATCH] == (1076, Decimal("54450958.59"))
    assert s[S.AMOUNT_DIFFERS] == (180, Decimal("8485628.37"))
    assert s[S.QTY_DIFFERS] == (62, Decimal("2851093.91"))
    assert s[S.BOTH_DIFFER] == (17, Decimal("910844.30"))
    assert s[S.NOT_TEST] == (780, Decimal("39459857.96"))
    assert s[S.ALL_DATA][0] == 2115


def test_dms_classes_raw_and_normalised(legs):
    s = summary_map(R.reconcile(legs.orders, legs.deliveries, legs.invoices, S.DMS))
    assert s[S.FULL_MATCH] == (326, Decimal("15493430.46"))
    assert s[S.AMOUNT_DIFFERS] == (61, Decimal("3264483.43"))
    assert s[S.QTY_DIFFERS] == (35, Decimal("2120510.37"))
    assert s[S.BOTH_DIFFER] == (9, Decimal("367783.94"))
    assert s[S.NOT_TEST] == (367, Decimal("18164394.76"))
    n = summary_map(R.reconcile(legs.orders, legs.deliveries, legs.invoices, S.DMS.with_(normalize_codes=True)))
    assert [n[c][0] for c in (S.FULL_MATCH, S.AMOUNT_DIFFERS, S.QTY_DIFFERS, S.BOTH_DIFFER, S.NOT_TEST)] == \
        [557, 98, 41, 18, 84]


def test_nottest_breakdown(legs):
    b = {r["missing"]: r["n_rows"] for r in
         nottest_breakdown(R.reconcile(legs.orders, legs.deliveries, legs.invoices)).collect()}
    assert (b[S.MISSING_ORDER], b[S.MISSING_DELIVERY], b[S.MISSING_BOTH]) == (578, 146, 56)


def test_uninvoiced(spark):
    from trimatch.plans.queries import uninvoiced_lines
    got = {r["legs_present"]: r["c"] for r in
           uninvoiced_lines(spark, SF).groupBy("legs_present").agg(F.count("*").alias("c")).collect()}
    assert got == {"order+delivery": 2399, "delivery only": 1046, "order only": 266}


def test_scenes_and_types(legs):
    sc = {r["scene"]: r["c"] for r in invoice_scene(legs.invoices).groupBy("scene")
          .agg(F.count("*").alias("c")).collect()}
    assert (sc[S.SCENE_TO_B_OMS], sc[S.SCENE_TO_B_DMS], sc[S.SCENE_TO_C]) == (2125, 1589, 1826)
    ty = {r["invoice_type"]: r["c"] for r in legs.invoices.groupBy("invoice_type")
          .agg(F.count("*").alias("c")).collect()}
    assert (ty["标准发票（2B)"], ty["标准发票（2C)"], ty["标准退货发票"]) == (1813, 1826, 1901)


def test_mapping_fan_out_and_distinct(legs):
    inv = filter_invoice_type_adaptive(legs.invoices)
    _, to_map = route_invoices(inv)
    assert to_map.count() == 1589
    orders = R.oms_filtered_orders(legs.orders)
    raw = map_dms_to_oms(to_map, orders, dedupe=False).agg(F.count("*"), F.sum("amount")).first()
    dist = map_dms_to_oms(to_map, orders, dedupe=True).agg(F.count("*"), F.sum("amount")).first()
    assert (raw[0], raw[1]) == (1137, Decimal("56227236.91"))
    assert (dist[0], dist[1]) == (1113, Decimal("55226850.78"))


def test_shifted_file(legs):
    f = {r["src_file"]: r for r in shift_flags(L.shifted_delivery_file(legs.deliveries)).collect()}
    e, l = f["early"], f["late"]
    assert (e["n_rows"], e["digits_col2"], e["dd_col5"], e["swapped"]) == (4151, 4151, 4151, True)
    assert (l["n_rows"], l["digits_col2"], l["dd_col5"], l["swapped"]) == (1261, 0, 0, False)


def test_ledger_totals(spark):
    from trimatch.plans.queries import ledger_summary
    got = {r["item"]: r["value"] for r in ledger_summary(spark, SF).collect()}
    assert got["订单总金额"] == "301,270,840.87"
    assert got["订单总数量"] == "152,257"
    assert got["发货总数量"] == "136,654"
    assert got["发货记录数"] == "5,412"


def test_orders_in_1998(legs):
    from trimatch.operators.filters import period_filter
    assert period_filter(legs.orders, "create_time", "1998-01-01", "1999-01-01").count() == 957


def test_invoice_keys_and_orgs(legs):
    inv = filter_invoice_type_adaptive(legs.invoices)
    direct, _ = route_invoices(inv)
    keys = direct.groupBy("oms_order_no", "item_code").agg(F.countDistinct("sales_org").alias("n"))
    assert keys.count() == 2115
    assert keys.where("n > 1").count() == 9
    org = {r["sales_org"]: r["c"] for r in legs.invoices.groupBy("sales_org").agg(F.count("*").alias("c")).collect()}
    assert [org[str(o)] for o in (1240, 1250, 1260, 1270, 1280)] == [1068, 1147, 1106, 1098, 1121]


def test_org_split_uses_source_position(legs):
    r = split_by_org(R.reconcile(legs.orders, legs.deliveries, legs.invoices))
    groups = {x["org_group"]: x["c"] for x in r.groupBy("org_group").agg(F.count("*").alias("c")).collect()}
    assert sum(groups.values()) == 2115 and set(groups) == {S.ORG_GROUP_SPLIT, S.ORG_GROUP_REST}
