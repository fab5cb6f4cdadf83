import sys
import tempfile
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trimatch.session import build_session, checkpoint_dir

    s = build_session("local[4]", app="trimatch-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="trimatch-wh-")})
    checkpoint_dir(s)  # tests: a private folder, since none is configured
    yield s
    s.stop()


ORDER_SCHEMA = ("platform_order_no string, main_order_no string, sale_order_no string, "
                "external_order_no string, order_type string, order_status string, channel_name string, "
                "item_code string, create_time timestamp, update_time timestamp, "
                "pay_amount decimal(18,2), item_num decimal(18,2), src_file string, src_pos long")
DELIVERY_SCHEMA = ("business_type string, main_no string, order_no string, external_order_no string, "
                   "item_code string, item_name string, biz_time timestamp, shipped_qty decimal(18,4), "
                   "src_file string, src_pos long")
INVOICE_SCHEMA = ("oms_order_no string, dms_order_no string, item_code string, invoice_type string, "
                  "sales_org string, company_code string, invoice_no string, customer_name string, "
                  "item_name string, remark string, invoice_date timestamp, amount decimal(18,2), "
                  "qty decimal(18,2), qty_sales_unit decimal(18,2), qty_base_unit decimal(18,2), "
                  "src_file string, src_pos long")


def D(x):
    return None if x is None else Decimal(str(x))


def orders_df(spark, rows):
    """rows: dicts with any subset of the order columns."""
    cols = [c.split()[0] for c in ORDER_SCHEMA.split(", ")]
    data = []
    for i, r in enumerate(rows):
        r = {"order_type": "oem_order", "order_status": "DONE", "channel_name": "OMS-X",
             "src_file": "o", "src_pos": i, **r}
        for m in ("pay_amount", "item_num"):
            r[m] = D(r.get(m))
        data.append(tuple(r.get(c) for c in cols))
    return spark.createDataFrame(data, ORDER_SCHEMA)


def deliveries_df(spark, rows):
    cols = [c.split()[0] for c in DELIVERY_SCHEMA.split(", ")]
    data = []
    for i, r in enumerate(rows):
        r = {"src_file": "d", "src_pos": i, **r}
        r["shipped_qty"] = D(r.get("shipped_qty"))
        data.append(tuple(r.get(c) for c in cols))
    return spark.createDataFrame(data, DELIVERY_SCHEMA)


def invoices_df(spark, rows):
    cols = [c.split()[0] for c in INVOICE_SCHEMA.split(", ")]
    data = []
    for i, r in enumerate(rows):
        r = {"invoice_type": "标准发票（2B)", "src_file": "i", "src_pos": i, **r}
        for m in ("amount", "qty", "qty_sales_unit", "qty_base_unit"):
            r[m] = D(r.get(m))
        data.append(tuple(r.get(c) for c in cols))
    return spark.createDataFrame(data, INVOICE_SCHEMA)


@pytest.fixture
def mk(spark):
    class M:
        orders = staticmethod(lambda rows: orders_df(spark, rows))
        deliveries = staticmethod(lambda rows: deliveries_df(spark, rows))
        invoices = staticmethod(lambda rows: invoices_df(spark, rows))
    return M
