"""Incremental staging and the match that is kept up to date."""

import os

import pytest
from pyspark.sql import functions as F

from trimatch.plans import late_months
from trimatch.plans import reconcile as R
from trimatch.plans import spec as S
from trimatch.plans.late_months import Match
from trimatch.sources import dump
from trimatch.sources import increments
from trimatch.sources import tpch_legs as L
from trimatch.streaming.invoice_drop import match_invoice_stream

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, map(tuple, df.select(*cols).collect())))


def _dump(folder, name, rows):
    (folder / name).write_text("".join(f"VALUES ({', '.join(repr(v) for v in r)});\n" for r in rows))


def _order(n, i):
    return [f"P{n}", "M", f"S{i}", "oem_order", "DONE", "2025-01-01 00:00:00", "2025-01-01 00:00:00", "X", "c", "1.00", "1"]


@pytest.fixture
def counted(spark):
    seen = []

    def parse(path):
        seen.append(os.path.basename(path))
        return dump.parsed_lines(dump.read_lines(spark, path))
    return seen, parse


def test_one_new_file_is_the_only_one_parsed(spark, tmp_path, counted):
    seen, parse = counted
    src, base = tmp_path / "src", str(tmp_path / "base")
    src.mkdir()
    _dump(src, "2025-02.sql", [_order("feb", i) for i in range(50)])
    first = increments.stage_files(spark, "o", [str(src)], parse, base=base)
    _dump(src, "2025-01.sql", [_order("jan", i) for i in range(3)])
    seen.clear()
    second = increments.stage_files(spark, "o", [str(src)], parse, base=base)
    assert seen == ["2025-01.sql"] and (first.version, second.version) == (1, 2)
    assert [os.path.basename(f[1]) for f in second.files] == ["2025-01.sql", "2025-02.sql"]
    rows = dump.order_rows(second.read(spark))
    whole = dump.order_rows(dump.parsed_lines(dump.read_lines(spark, str(src))))
    assert _rows(rows.drop("src_pos")) == _rows(whole.drop("src_pos"))
    assert rows.orderBy("src_pos").first()["platform_order_no"] == "Pjan"     # the order of the list, not of arrival
    seen.clear()
    assert increments.stage_files(spark, "o", [str(src)], parse, base=base).version == 2 and not seen
    _dump(src, "2025-01.sql", [_order("new", i) for i in range(4)])
    third = increments.stage_files(spark, "o", [str(src)], parse, base=base)
    assert seen == ["2025-01.sql"] and dump.order_rows(third.read(spark)).count() == 54
    assert dump.order_rows(second.read(spark)).count() == 53                 # an old version stays readable


def test_a_run_cut_short_leaves_the_old_version(spark, tmp_path, counted):
    seen, parse = counted
    src, base = tmp_path / "src", str(tmp_path / "base")
    src.mkdir()
    _dump(src, "a.sql", [_order("a", 1)])
    increments.stage_files(spark, "o", [str(src)], parse, base=base)
    _dump(src, "b.sql", [_order("b", 1)])
    _dump(src, "c.sql", [_order("c", 1)])

    def fails(path):
        if path.endswith("c.sql"):
            raise OSError("lost")
        return parse(path)
    with pytest.raises(OSError):
        increments.stage_files(spark, "o", [str(src)], fails, base=base, parallel=1)
    assert increments.latest(spark, "o", base).version == 1
    assert dump.order_rows(increments.latest(spark, "o", base).read(spark)).count() == 1
    done = increments.stage_files(spark, "o", [str(src)], parse, base=base)
    assert done.version == 2 and dump.order_rows(done.read(spark)).count() == 3
    with pytest.raises(ValueError):
        increments.stage_files(spark, "none", [str(tmp_path / "nothing")], parse, base=base)


def _parts(lg, n):
    """The legs in ``n`` updates by position, each leg cut elsewhere."""
    last = lg.orders.agg(F.max("src_pos")).first()[0]
    shift = {"orders": 0.0, "deliveries": 0.15, "invoices": -0.1}
    for k in range(n):
        def cut(leg):
            lo, hi = (int((x / n + shift[leg]) * last) for x in (k, k + 1))
            df = getattr(lg, leg)
            df = df if k == 0 else df.where(F.col("src_pos") > lo)
            return df if k == n - 1 else df.where(F.col("src_pos") <= hi)
        yield [cut(leg) for leg in ("orders", "deliveries", "invoices")]


@pytest.mark.parametrize("spec", [S.OMS, S.DMS, S.DMS_PARTIAL], ids=["oms", "dms", "dms_first_row"])
def test_updates_equal_the_whole_match(spark, tmp_path, spec):
    lg = L.legs(spark, SF)
    match = Match(spark, "m", spec, base=str(tmp_path), compact_after=2)
    for k, legs in enumerate(_parts(lg, 4)):
        match.update(f"month {k}", *legs)
        if k == 1:
            half = [a.unionByName(b) for a, b in zip(*list(_parts(lg, 4))[:2], strict=True)]
            assert _rows(match.result()) == _rows(R.reconcile(*half, spec))
    assert _rows(match.result()) == _rows(R.reconcile(lg.orders, lg.deliveries, lg.invoices, spec))
    assert match._commits()[-1].totals_from > 1                              # layers were made one
    before = match._commits()
    match.update("month 3", *legs)                                           # a retry counts nothing twice
    assert match._commits() == before


def test_a_late_leg_changes_the_class_of_its_keys(spark, mk, tmp_path):
    o = mk.orders([{"sale_order_no": s, "item_code": "i", "pay_amount": 5, "item_num": 1} for s in ("A", "B")])
    i = mk.invoices([{"oms_order_no": s, "item_code": "i", "amount": 5, "qty": 1} for s in ("A", "B")] +
                    [{"oms_order_no": None, "item_code": "i", "amount": 9, "qty": 1}])
    none = mk.deliveries([])
    match = Match(spark, "m", S.OMS, base=str(tmp_path))
    with pytest.raises(ValueError):
        match.result()
    with pytest.raises(ValueError):
        match.update("1", orders=o)
    match.update("1", o, none, i)
    assert {r.order_no: r.category for r in match.result().collect()} == {"A": S.NOT_TEST, "B": S.NOT_TEST}
    match.update("2", deliveries=mk.deliveries([{"order_no": "A", "item_code": "i", "shipped_qty": 1},
                                                {"order_no": "Z", "item_code": "i", "shipped_qty": 1}]))
    assert {r.order_no: r.category for r in match.result().collect()} == {"A": S.FULL_MATCH, "B": S.NOT_TEST}
    assert [r.order_no for r in match.uninvoiced().collect()] == ["Z"]
    assert spark.read.parquet(f"{tmp_path}/stage/m/result/v=2").count() == 1  # only the late key was matched again
    with pytest.raises(ValueError):
        Match(spark, "m", S.OMS.with_(map_dms_invoices=True))


def test_a_file_that_tips_the_type_rule_matches_every_key_again(spark, mk, tmp_path):
    o, d = mk.orders([{"sale_order_no": "A", "item_code": "i", "pay_amount": 5, "item_num": 1}]), mk.deliveries([])
    texts = mk.invoices([{"oms_order_no": "A", "item_code": "i", "amount": 5, "qty": 1}])
    codes = mk.invoices([{"oms_order_no": s, "item_code": "i", "amount": 7, "qty": 1, "invoice_type": t}
                         for s, t in (("B", "ZA01"), ("C", "ZA01"), ("D", "ZZ99"))])
    match = Match(spark, "m", S.OMS, base=str(tmp_path))
    match.update("1", o, d, texts)
    assert [r.order_no for r in match.result().collect()] == ["A"]
    match.update("2", invoices=codes)
    assert sorted(r.order_no for r in match.result().collect()) == ["B", "C"]
    assert _rows(match.result()) == _rows(R.reconcile(o, d, texts.unionByName(codes), S.OMS))


def test_streamed_invoices_are_matched_as_they_land(spark, mk, tmp_path):
    o = mk.orders([{"sale_order_no": s, "item_code": "7", "pay_amount": 5, "item_num": 1} for s in ("A", "B")])
    d = mk.deliveries([{"order_no": s, "item_code": "7", "shipped_qty": 1} for s in ("A", "B")])
    match = Match(spark, "m", S.OMS, base=str(tmp_path))
    place = "struct<file_no: int, file: string, block: bigint, row: bigint>"
    match.update("legs", o, d, mk.invoices([]).withColumn("src_pos", F.lit(None).cast(place)))
    drop = tmp_path / "drop"
    drop.mkdir()
    heads = ["OMS销售单号", "物料编码", "实际金额", "开票数量（销售单位）", "开票数量（基本单位数量）", "发票类型"]
    for month, order, classes in (("2025-01", "A", {"A"}), ("2025-02", "B", {"A", "B"})):
        (drop / f"{month}.csv").write_text(",".join(heads) + f"\n{order},7,5,1,1,标准发票（2B)\n")
        schema = ", ".join(f"`{h}` string" for h in heads)
        match_invoice_stream(spark, str(drop), schema, match, checkpoint=str(tmp_path / "ck")).awaitTermination(120)
        assert {r.order_no for r in match.result().where(F.col("category") == S.FULL_MATCH).collect()} == classes


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_dealt_once(spark, mk, tmp_path):
    """Only the rows of an update are shuffled; what merges, matches and reads
    the stored totals goes by buckets."""
    def legs(*orders):
        return [mk.orders([{"sale_order_no": s, "item_code": "i", "pay_amount": 5, "item_num": 1} for s in orders]),
                mk.deliveries([{"order_no": s, "item_code": "i", "shipped_qty": 1} for s in orders]),
                mk.invoices([{"oms_order_no": s, "item_code": "i", "amount": 5, "qty": 1} for s in orders])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        match = Match(spark, "m", S.OMS, base=str(tmp_path))
        match.update("1", *legs(*"ABC"))
        match.update("2", *legs(*"BD"))
        commits = match._commits()
        changed = match._layers("changed", [commits[0].result], [2], commits[-1].buckets).select("order_no", "item_code")
        assert "Exchange" not in _plan(match.result()) and "Exchange" not in _plan(match._match(commits, changed))
        assert sorted((r.order_no, int(r.invoice_qty)) for r in match.result().collect()) == [("A", 1), ("B", 2), ("C", 1), ("D", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stored = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet") and "_0" in f]
    assert stored and all(".zstd." in f for f in stored)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("trimatch")]


@pytest.mark.parametrize("shown", [(256, 64), (1, 3)], ids=["even", "hot"])
def test_first_values_of_rows_that_hold_different_attributes(spark, mk, tmp_path, monkeypatch, shown):
    monkeypatch.setattr(late_months, "SHOWN", shown)        # (1, 3): three rows make a key hot
    at = iter(range(100))

    def order(s, item, **kw):
        return {"sale_order_no": s, "item_code": item, "pay_amount": 5, "item_num": 1, "src_pos": next(at), **kw}
    first = [order("A", "7.0", order_status=None, main_order_no=None), order("A", "7", order_status="s1", main_order_no="m"),
             order("A", "7", order_status="s2", platform_order_no="A"), order("A", "7.0", platform_order_no="P"),
             order("B", "8", channel_name=None, order_status=None), order("C", None)]
    later = [order("A", "7", main_order_no="late"), order("B", "8.0", channel_name="c", order_status="s3", platform_order_no="B"),
             order("B", "8", order_status="s4"), order("B", "8", platform_order_no="Q")]
    dlv = [{"order_no": o, "main_no": m, "item_code": "7", "shipped_qty": 1, "src_pos": n}
           for n, (o, m) in enumerate([("A", None), ("SUB", "DDA"), ("A", "x"), ("DDA", None), ("B", None)])]
    inv = [{"oms_order_no": o, "item_code": i, "amount": 5, "qty": 1, "src_pos": n, "remark": r, "item_name": w}
           for n, (o, i, r, w) in enumerate([("A", "7", None, "w"), ("A", "7.0", "r", None), ("A", "7", "q", "v"), ("B", "8", None, None), ("DDA", "7", "r", "w")])]
    legs = mk.orders(first), mk.deliveries(dlv), mk.invoices(inv)
    match = Match(spark, "m", S.OMS, base=str(tmp_path))
    match.update("1", *legs)
    match.update("2", orders=mk.orders(later))
    assert _rows(match.result()) == _rows(R.reconcile(mk.orders(first + later), *legs[1:], S.OMS))
    totals = late_months.partial_totals(legs[0], "orders", S.OMS, 1, 8)
    assert ("BroadcastHashJoin" in _plan(totals)) == (shown[0] == 1)
    # a key's own text is not kept twice
    assert totals.where("a_ord_sale_order_no IS NOT NULL").isEmpty()
    assert totals.where("a_ord_platform_order_no = order_no OR a_ord_item_code = item_code").isEmpty()


def test_an_update_cut_short_is_written_over(spark, mk, tmp_path):
    def orders(*keys):
        return mk.orders([{"sale_order_no": s, "item_code": "i", "pay_amount": 5, "item_num": 1} for s in keys])
    match = Match(spark, "m", S.OMS, base=str(tmp_path))
    match.update("1", orders("A"), mk.deliveries([]), mk.invoices([{"oms_order_no": s, "item_code": "i", "amount": 5, "qty": 1} for s in "AB"]))
    buckets = match._commits()[0].buckets
    match._put(late_months.partial_totals(orders("A", "B", "Z"), "orders", S.OMS, 2, buckets), "orders", 2, buckets)     # no commit
    want = _rows(match.result())
    assert _rows(match.totals("orders").select("order_no", "order_qty")) == ["('A', Decimal('1.00'))"] and len(want) == 2
    match.update("2", orders=orders("A"))
    assert {(r.order_no, r.order_qty) for r in match.result().collect()} == {("A", 2), ("B", None)}
    with pytest.raises(ValueError, match="older layout"):
        path = f"{tmp_path}/stage/m/commit/v=3"
        spark.createDataFrame([(3, "3", 0, 0, 1, 1, "orders", None, None, None, None)], late_months.COMMIT).write.parquet(path)
        match.result()
