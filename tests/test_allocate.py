"""Allocation of DMS lines over several orders: pieces, leftovers, sums, hot keys."""

from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from trimatch.operators.allocate import allocate, running

D = Decimal


def _order(sale, qty, pos, item="7", ext="55"):
    return dict(sale_order_no=sale, external_order_no=ext, item_code=item, item_num=qty, src_pos=pos)


def _line(no, qty, amount, pos, item="7", ext="55"):
    return dict(dms_order_no=ext, item_code=item, invoice_no=no, qty=qty, amount=amount, src_pos=pos)


def test_lines_fill_orders_in_source_order(spark, mk):
    o = mk.orders([_order("DD2", 3, 5), _order("DD1", 4, 9), _order("DD2", 2, 1), _order("DD3", 0, 0), _order(None, 9, 0), _order("DD9", 5, 0, ext=None)])
    i = mk.invoices([_line("b", 4, 10, 2), _line("a", 3, "10.00", 1), _line("c", 4, -1, 3), _line("r", -2, -5, 4), _line("z", 0, 6, 5),
                     _line("n", None, 7, 6), _line("u", 1, 8, 7, item="8"), _line("m", 1, 9, 8, item=None)])
    got = {(r.invoice_no, r.oms_order_no): (r.status, r.qty, r.amount) for r in allocate(i, o).collect()}
    assert got == {("a", "DD2"): ("allocated", 3, 10), ("b", "DD2"): ("allocated", 2, 5), ("b", "DD1"): ("allocated", 2, 5),
                   ("c", "DD1"): ("allocated", 2, D("-0.50")), ("c", None): ("over", 2, D("-0.50")), ("r", "DD2"): ("allocated", -2, -5),
                   ("z", None): ("no quantity", 0, 6), ("n", None): ("no quantity", 0, 7), ("u", None): ("unmapped", 1, 8),
                   ("m", None): ("no item code", 1, 9)}


def test_cents_add_up(spark, mk):
    o = mk.orders([_order(f"DD{k}", 1, k) for k in range(3)])
    i = mk.invoices([_line("a", 3, "10.00", 1)])
    assert sorted(r.amount for r in allocate(i, o).collect()) == [D("3.33"), D("3.33"), D("3.34")]


def test_empty_sides(spark, mk):
    o, i = mk.orders([_order("DD1", 1, 1)]), mk.invoices([_line("a", 1, 1, 1)])
    assert allocate(i.limit(0), o).collect() == []
    assert [r.status for r in allocate(i, o.limit(0)).collect()] == ["unmapped"]


def test_one_key_with_all_rows_is_spread_and_equals_a_plain_sweep(spark):
    lines = spark.range(3000).select(F.lit("55").alias("dms_order_no"), F.lit("7").alias("item_code"), F.col("id").cast("string").alias("invoice_no"),
                                     F.col("id").alias("src_pos"), (F.col("id") % 5 + 1).cast("decimal(18,2)").alias("qty"),
                                     (F.col("id") % 97).cast("decimal(18,2)").alias("amount"))
    orders = spark.range(2000).select(F.lit("55").alias("external_order_no"), F.lit("7").alias("item_code"), F.col("id").cast("string").alias("sale_order_no"),
                                      F.col("id").alias("src_pos"), (F.col("id") % 7 + 1).cast("decimal(18,2)").alias("item_num"))
    want, left = defaultdict(int), [(str(k), k % 7 + 1) for k in range(2000)][::-1]
    for k in range(3000):
        q = k % 5 + 1
        while q:
            sale, r = left.pop() if left else (None, q)
            want[(str(k), sale)] += min(q, r)
            if r > q and sale is not None:
                left.append((sale, r - q))
            q -= min(q, r)
    got = allocate(lines, orders).collect()
    assert {(r.invoice_no, r.oms_order_no): int(r.qty) for r in got} == dict(want)
    assert sum(r.amount for r in got) == sum(k % 97 for k in range(3000))


def test_running_values_do_not_depend_on_ranges(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("mark"))
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            rows = running(df, ["g"], ["id"], {"s": "id"}, {"m": "mark"}).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        for r in rows:
            before = range(r.g, r.id, 3)
            assert r.s == sum(before) and r.m == max((x for x in before if x % 10 == 0), default=None)
