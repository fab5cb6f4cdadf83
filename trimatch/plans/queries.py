"""Driver queries: one callable per query of SURVEY §7.3.

Each takes ``(spark, sf_dir)``, reads the benchmark tables under ``sf_dir``,
derives the three legs and returns a lazy DataFrame.  Output columns are
aliased to the names used by the SQL twins in :mod:`trimatch.plans.oracles`;
:func:`edge` gives measures a portable type (double) and timestamps a text
form at the very end so the two engines compare value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType, TimestampType

from trimatch.functions.codes import delivery_order_no, norm_code, safe_label
from trimatch.functions.dates import safe_timestamp
from trimatch.functions.numbers import safe_number
from trimatch.operators.aggregate import first_non_null, first_row, leg_sum, type_counts
from trimatch.operators.classify import invoice_scene, strict_not_test
from trimatch.operators.filters import (channel_contains, drop_status, filter_invoice_type_adaptive,
                                        filter_invoice_type_text, keep_types, of_category,
                                        period_filter, route_invoices)
from trimatch.operators.allocate import allocate
from trimatch.operators.join import map_dms_to_oms, uninvoiced
from trimatch.operators.date_forms import date_shapes, parse_dates
from trimatch.operators.numbering import work_path, written
from trimatch.operators.quality import null_share
from trimatch.operators.repair import repair_shift, shift_flags
from trimatch.operators.resolve import resolve_invoice_columns
from trimatch.plans import ledger
from trimatch.plans.late_months import Match
from trimatch.plans import reconcile as R
from trimatch.plans import spec as S
from trimatch.plans.accounting import leg_accounting
from trimatch.plans.report import DMS_REPORT_LABELS, OMS_REPORT_LABELS, label_columns, report_columns, report_parts
from trimatch.plans.spec import DMS, OMS
from trimatch.plans.summary import (category_summary, combine_sources, flag_counts, match_coverage,
                                    nottest_breakdown, org_split_summary)
from trimatch.sources import dump
from trimatch.sources import tpch_legs as L
from trimatch.sources.invoices import align_union

Query = Callable[[SparkSession, str], DataFrame]

DMS_NORM = DMS.with_(normalize_codes=True)
# Partial-year OMS profile: raw codes, a Jan-Sep window, strict Not test.
OMS_PARTIAL = OMS.with_(normalize_codes=False, period=("1997-01-01", "1997-10-01"))
PERIOD_1998 = ("1998-01-01", "1999-01-01")
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def edge(df: DataFrame) -> DataFrame:
    """Decimals -> double, timestamps -> ``yyyy-MM-dd HH:mm:ss`` text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, TS_TEXT)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _legs(spark, sf_dir, type_codes=False):
    return L.legs(spark, sf_dir, type_codes)


def _oms(spark, sf_dir, spec=OMS, carry=False):
    # attributes make the legs wide: then the tables are joined once for all three
    lg = L.shared_legs(spark, sf_dir) if carry else _legs(spark, sf_dir)
    return R.reconcile(lg.orders, lg.deliveries, lg.invoices, spec, carry)


# --- reconciliation results -------------------------------------------------

def oms_category_summary(spark, sf_dir):
    return edge(category_summary(_oms(spark, sf_dir)))


DETAIL_OMS = ["order_no", "item_code", "invoice_amount", "invoice_qty", "shipped_qty",
              "order_amount", "order_qty", "order_minus_shipped_qty", "order_minus_invoice_qty",
              "shipped_minus_invoice_qty", "order_minus_invoice_amount", "category",
              "ord_order_status", "ord_create_time", "dlv_order_no", "dlv_biz_time",
              "inv_sales_org", "inv_invoice_no", "inv_dms_order_no"]
DETAIL_DMS = ["order_no", "item_code", "invoice_amount", "invoice_qty_sales", "invoice_qty",
              "order_amount", "order_qty", "shipped_qty", "invoice_minus_order_amount",
              "invoice_minus_order_qty", "invoice_minus_shipped_qty", "category",
              "ord_sale_order_no", "ord_channel_name", "dlv_order_no", "inv_sales_org",
              "inv_invoice_no", "inv_src_file"]


def oms_match_detail(spark, sf_dir):
    return edge(_oms(spark, sf_dir, carry=DETAIL_OMS).select(*DETAIL_OMS))


def late_months(spark, sf_dir):
    """The OMS detail kept up to date over three updates; the legs of a key
    arrive in different ones, so keys are matched again."""
    lg = L.shared_legs(spark, sf_dir)
    match = Match(spark, f"late-{uuid.uuid4().hex[:12]}", OMS)
    last = lg.orders.agg(F.max("src_pos")).first()[0]
    cuts = {"orders": (0.3, 0.6), "deliveries": (0.2, 0.5), "invoices": (0.5, 0.8)}

    def part(leg: str, n: int) -> DataFrame:
        lo, hi = [None, *(int(c * last) for c in cuts[leg]), None][n:n + 2]
        df = getattr(lg, leg)
        df = df if lo is None else df.where(F.col("src_pos") > lo)
        return df if hi is None else df.where(F.col("src_pos") <= hi)
    for n in range(3):
        match.update(f"part {n}", *[part(leg, n) for leg in ("orders", "deliveries", "invoices")])
    return edge(match.result().select(*DETAIL_OMS))


def dms_match_detail(spark, sf_dir):
    return edge(_oms(spark, sf_dir, DMS, carry=DETAIL_DMS).select(*DETAIL_DMS))


def dms_category_summary(spark, sf_dir):
    return edge(category_summary(_oms(spark, sf_dir, DMS)))


def dms_norm_category_summary(spark, sf_dir):
    return edge(category_summary(_oms(spark, sf_dir, DMS_NORM)))


def combined_summary(spark, sf_dir):
    lg = _legs(spark, sf_dir)
    both = combine_sources({"OMS": R.reconcile(lg.orders, lg.deliveries, lg.invoices, OMS, carry=False),
                            "DMS": R.reconcile(lg.orders, lg.deliveries, lg.invoices, DMS, carry=False)})
    return edge(category_summary(both, by=("source",)))


# --- leg totals -------------------------------------------------------------

def oms_order_agg(spark, sf_dir):
    return edge(R.oms_order_totals(_legs(spark, sf_dir).orders, carry=False))


def oms_delivery_agg(spark, sf_dir):
    return edge(R.oms_delivery_totals(_legs(spark, sf_dir).deliveries, carry=False))


def oms_invoice_agg(spark, sf_dir):
    return edge(R.oms_invoice_totals(_legs(spark, sf_dir).invoices, carry=False))


def dms_order_agg(spark, sf_dir):
    return edge(R.dms_order_totals(_legs(spark, sf_dir).orders, DMS, carry=False))


def dms_delivery_agg(spark, sf_dir):
    return edge(R.dms_delivery_totals(_legs(spark, sf_dir).deliveries, DMS, carry=False))


def dms_invoice_agg(spark, sf_dir):
    return edge(R.dms_invoice_totals(_legs(spark, sf_dir).invoices, DMS, carry=False))


# --- joins, mapping, routing ------------------------------------------------

def uninvoiced_lines(spark, sf_dir):
    lg = _legs(spark, sf_dir)
    o = R.oms_order_totals(lg.orders, carry=False)
    d = R.oms_delivery_totals(lg.deliveries, carry=False)
    i = R.oms_invoice_totals(lg.invoices, carry=False).select("order_no", "item_code")
    u = uninvoiced(o, d, i)
    legs_present = (F.when(F.col("order_amount").isNotNull() & F.col("shipped_qty").isNotNull(), "order+delivery")
                    .when(F.col("shipped_qty").isNotNull(), "delivery only").otherwise("order only"))
    return edge(u.select("order_no", "item_code", "order_amount", "order_qty", "shipped_qty",
                         legs_present.alias("legs_present")))


def _mapped(spark, sf_dir, dedupe=True):
    lg = _legs(spark, sf_dir)
    inv = filter_invoice_type_adaptive(lg.invoices, "invoice_type")
    _, to_map = route_invoices(inv)
    return map_dms_to_oms(to_map, R.oms_filtered_orders(lg.orders), dedupe=dedupe)


def dms_to_oms_mapping(spark, sf_dir):
    m = _mapped(spark, sf_dir)
    return edge(m.select("dms_order_no", "item_code", "oms_order_no", "invoice_no",
                         "amount", "qty", "src_pos"))


def dms_allocation(spark, sf_dir):
    """DMS lines laid over the orders of collective DMS numbers (32 order keys
    each) and coarse items, so that most belong to several orders; every fifth
    line is a return and every seventh is invoiced twofold."""
    lg = _legs(spark, sf_dir)

    def coarse(df, number):
        return df.withColumns({number: F.floor(F.col(number).cast("long") / 32).cast("string"), "item_code": (norm_code("item_code").cast("long") % 3).cast("string")})
    _, to_map = route_invoices(filter_invoice_type_adaptive(lg.invoices, "invoice_type"))
    k = F.col("src_pos")
    factor = F.when(k % 5 == 0, -1).when(k % 7 == 0, 2).when(k % 11 == 0, 0).otherwise(1)
    to_map = coarse(to_map, "dms_order_no").withColumn("qty", (F.col("qty") * factor).cast("decimal(18,2)"))
    return edge(allocate(to_map, coarse(R.oms_filtered_orders(lg.orders), "external_order_no")))


def invoice_routing(spark, sf_dir):
    """Type-filtered invoices by route (direct / needs a map / neither) plus
    the rows the distinct map produced, in one table."""
    lg = _legs(spark, sf_dir)
    inv = filter_invoice_type_adaptive(lg.invoices, "invoice_type")
    route = (F.when(F.col("oms_order_no").isNotNull(), "direct")
             .when(F.col("dms_order_no").isNotNull(), "needs_map").otherwise("unrouted"))
    routed = inv.select(route.alias("route"), "amount")
    mapped = map_dms_to_oms(route_invoices(inv)[1], R.oms_filtered_orders(lg.orders)) \
        .select(F.lit("mapped").alias("route"), "amount")
    out = routed.unionByName(mapped).groupBy("route").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("decimal(28,2)").alias("amount"))
    return edge(out)


# --- not tested -------------------------------------------------------------

def nottest_breakdown_q(spark, sf_dir):
    return edge(nottest_breakdown(_oms(spark, sf_dir)))


def oms_nottest_rows(spark, sf_dir):
    r = of_category(_oms(spark, sf_dir), S.NOT_TEST)
    return edge(r.select("order_no", "item_code", "invoice_amount", "invoice_qty",
                         "shipped_qty", "order_amount", "order_qty"))


def oms_strict_nottest(spark, sf_dir):
    """Partial-year OMS: raw codes, Jan-Sep window, sums only, Not test when
    any joined column is NULL."""
    lg = _legs(spark, sf_dir)
    r = R.reconcile(lg.orders, lg.deliveries, lg.invoices, OMS_PARTIAL, carry=False)
    return edge(category_summary(strict_not_test(r)))


def org_split_summary_q(spark, sf_dir):
    return edge(org_split_summary(_oms(spark, sf_dir, carry={"inv_sales_org"})))


# --- invoice types and scenes ----------------------------------------------

def invoice_scene_q(spark, sf_dir):
    s = invoice_scene(_legs(spark, sf_dir).invoices)
    return edge(s.groupBy("scene").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.sum("amount").cast("decimal(28,2)").alias("amount")))


def invoice_type_counts(spark, sf_dir):
    return type_counts(_legs(spark, sf_dir).invoices, "invoice_type")


def invoice_type_label(spark, sf_dir):
    inv = _legs(spark, sf_dir).invoices.where(F.col("invoice_type").isNotNull())
    return (inv.groupBy("invoice_type").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("invoice_type", safe_label("invoice_type").alias("label"), "n_rows"))


def invoice_type_filter_oms(spark, sf_dir):
    """Adaptive filter on the text-typed and on the code-typed invoices."""
    text = filter_invoice_type_adaptive(_legs(spark, sf_dir).invoices)
    code = filter_invoice_type_adaptive(_legs(spark, sf_dir, type_codes=True).invoices)
    both = text.select(F.lit("text").alias("variant"), "invoice_type", "amount").unionByName(
        code.select(F.lit("code").alias("variant"), "invoice_type", "amount"))
    return edge(both.groupBy("variant", "invoice_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("decimal(28,2)").alias("amount")))


def invoice_type_filter_dms(spark, sf_dir):
    f = filter_invoice_type_text(_legs(spark, sf_dir).invoices)
    return edge(f.groupBy("invoice_type").agg(F.count(F.lit(1)).alias("n_rows"),
                                              F.sum("amount").cast("decimal(28,2)").alias("amount")))


# --- order filters ----------------------------------------------------------

def order_status_filter(spark, sf_dir):
    o = drop_status(_legs(spark, sf_dir).orders)
    return o.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_rows"))


def order_type_filter(spark, sf_dir):
    o = keep_types(_legs(spark, sf_dir).orders)
    return o.groupBy("order_type").agg(F.count(F.lit(1)).alias("n_rows"))


def period_filter_q(spark, sf_dir):
    lg = _legs(spark, sf_dir)
    o = period_filter(lg.orders, "create_time", *PERIOD_1998).select(
        F.lit("order").alias("leg"), F.month("create_time").cast("long").alias("month"), F.col("pay_amount").alias("amount"))
    d = period_filter(lg.deliveries, "biz_time", *PERIOD_1998).select(
        F.lit("delivery").alias("leg"), F.month("biz_time").cast("long").alias("month"), F.col("shipped_qty").alias("amount"))
    return edge(o.unionByName(d).groupBy("leg", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("decimal(28,2)").alias("total")))


def dms_order_filter(spark, sf_dir):
    o = channel_contains(_legs(spark, sf_dir).orders)
    return edge(o.groupBy("channel_name").agg(F.count(F.lit(1)).alias("n_rows"),
                                              F.sum("pay_amount").cast("decimal(28,2)").alias("amount")))


# --- scalar functions -------------------------------------------------------

def norm_code_q(spark, sf_dir):
    o = _legs(spark, sf_dir).orders
    return o.groupBy(norm_code("item_code").alias("item_code")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("item_code").endswith(".0")).alias("rows_with_suffix"))


def delivery_key(spark, sf_dir):
    d = _legs(spark, sf_dir).deliveries
    return edge(d.select(delivery_order_no("main_no", "order_no").alias("order_no"),
                         "item_code", "shipped_qty", "src_pos"))


def safe_number_q(spark, sf_dir):
    """Amounts as text in several spellings; tolerant parsing per spelling."""
    inv = _legs(spark, sf_dir).invoices
    forms = {
        "plain": F.col("amount").cast("string"),
        "padded": F.concat(F.lit("  "), F.col("amount").cast("string"), F.lit(" ")),
        "thousands": F.format_number(F.col("amount"), 2),
        "blank": F.when(F.col("src_pos") % 2 == 0, F.lit("")).otherwise(F.col("amount").cast("string")),
    }
    u = inv.select(F.explode(F.array(*[F.struct(F.lit(k).alias("form"), v.alias("t")) for k, v in forms.items()])).alias("x")) \
        .select("x.form", safe_number("x.t").alias("v"))
    return edge(u.groupBy("form").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.count_if(F.col("v").isNull()).alias("null_rows"),
                                      F.sum("v").cast("decimal(28,2)").alias("total")))


# --- repair and first values ------------------------------------------------

def shift_repair(spark, sf_dir):
    raw = L.shifted_delivery_file(_legs(spark, sf_dir).deliveries)
    flags = shift_flags(raw)
    fixed = repair_shift(raw)
    after = fixed.groupBy("src_file").agg(
        F.count_if(F.col("order_no").startswith("DD")).alias("dd_order_no_after"))
    return edge(flags.join(after, "src_file"))


def first_value_carry(spark, sf_dir):
    inv = _legs(spark, sf_dir).invoices.where(F.col("oms_order_no").isNotNull())
    g = inv.groupBy(F.col("oms_order_no").alias("order_no"), "item_code").agg(
        first_non_null("remark").alias("first_remark"),
        first_non_null("sales_org").alias("first_sales_org"),
        first_row(["remark", "invoice_no"]).alias("__r"))
    return g.select("order_no", "item_code", "first_remark", "first_sales_org",
                    F.col("__r.remark").alias("first_row_remark"),
                    F.col("__r.invoice_no").alias("first_row_invoice_no"))


# --- ingestion shapes -------------------------------------------------------

def order_layout_union(spark, sf_dir):
    early, late = L.order_extracts(_legs(spark, sf_dir).orders)
    u = align_union([early, late])
    return edge(u.groupBy("src_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("line_amount").isNotNull()).alias("line_amount_rows"),
        F.count_if(F.col("channel_name2").isNull()).alias("channel_name2_null"),
        F.sum("pay_amount").cast("decimal(28,2)").alias("pay_amount")))


def invoice_monthly_union(spark, sf_dir):
    early, late = L.monthly_invoice_extracts(_legs(spark, sf_dir).invoices)
    u = align_union([early, late])
    return edge(u.groupBy("src_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("remark").isNull()).alias("remark_null"),
        F.count_if(F.col("qty_sales_unit").isNull()).alias("qty_sales_unit_null"),
        F.sum("amount").cast("decimal(28,2)").alias("amount")))


def column_resolution(spark, sf_dir):
    raw = L.invoice_with_source_headers(_legs(spark, sf_dir).invoices)
    inv = resolve_invoice_columns(raw)
    return edge(R.dms_invoice_totals(inv, DMS, carry=False))


# --- ledgers and quality ----------------------------------------------------

def order_ledger(spark, sf_dir):
    return edge(ledger.order_ledger(_legs(spark, sf_dir).orders))


def delivery_ledger(spark, sf_dir):
    return edge(ledger.delivery_ledger(_legs(spark, sf_dir).deliveries))


def ledger_summary(spark, sf_dir):
    lg = _legs(spark, sf_dir)
    return ledger.ledger_summary(lg.orders, lg.deliveries)


def null_share_by_period(spark, sf_dir):
    early, late = L.order_extracts(_legs(spark, sf_dir).orders)
    return null_share(align_union([early, late]), "line_amount", "create_time")


def match_coverage_q(spark, sf_dir):
    return match_coverage(_oms(spark, sf_dir))


def oms_flag_counts(spark, sf_dir):
    return flag_counts(_oms(spark, sf_dir))


def dms_org_split_summary(spark, sf_dir):
    return edge(org_split_summary(_oms(spark, sf_dir, DMS, carry={"inv_sales_org"})))


def dms_match_coverage(spark, sf_dir):
    return match_coverage(_oms(spark, sf_dir, DMS))


# --- dumps: legs rendered as VALUES lines, parsed back ------------------------

def _typed(df: DataFrame, numbers=(), dates=()) -> DataFrame:
    return df.withColumns({c: safe_number(c).cast("double") for c in numbers} | {c: safe_timestamp(c) for c in dates})


def _parsed_orders(spark, sf_dir):
    return dump.stage_parse(L.order_dump(_legs(spark, sf_dir).orders), "orders")


def dump_orders(spark, sf_dir):
    return edge(_typed(dump.order_rows(_parsed_orders(spark, sf_dir)), ("line_amount", "pay_amount", "item_num"), ("create_time", "update_time")))


def dump_utf16(spark, sf_dir):
    """The order dumps as UTF-16 text; every 97th channel name holds two
    characters whose bytes look like a line end."""
    o = _legs(spark, sf_dir).orders
    trap = F.when(F.col("src_pos") % 97 == 0, F.concat("channel_name", F.lit("\u0a05\u4e00"))).otherwise(F.col("channel_name"))
    lines = L.order_dump(o.withColumn("channel_name", trap)).select(F.col("src_file").alias("f"), "line")
    folder = work_path(spark, "utf16")
    # a compressed file is read by one task: many files of bounded size
    lines.write.partitionBy("f").option("maxRecordsPerFile", 200_000).option("compression", "lz4").option("encoding", "UTF-16LE") \
        .option("quote", "").option("sep", "\u0001").csv(folder)
    read = dump.read_lines(spark, folder, "UTF-16LE").withColumn("src_file", F.regexp_extract("src_file", "f=([^/]+)", 1))
    rows = dump.order_rows(dump.stage_parse(read, "utf16"))
    return edge(_typed(rows, ("line_amount", "pay_amount", "item_num"), ("create_time", "update_time"))).drop("src_pos")


def dump_rejected(spark, sf_dir):
    return dump.rejected_rows(_parsed_orders(spark, sf_dir), "orders").groupBy("leg", "src_file", "n_values", "reason").agg(
        F.count(F.lit(1)).alias("n_rows"))


def dump_profile(spark, sf_dir):
    """Widths and shift marks of the order and the shifted delivery files."""
    lg = L.shared_legs(spark, sf_dir)
    orders = dump.file_profile(dump.stage_parse(L.order_dump(lg.orders), "orders"))
    shifted = L.shifted_delivery_file(lg.deliveries)
    return orders.unionByName(dump.file_profile(dump.stage_parse(L.values_lines(shifted, dump.DELIVERY_COLS_7), "deliveries")))


def dump_deliveries(spark, sf_dir):
    parsed = dump.stage_parse(L.delivery_dump(_legs(spark, sf_dir).deliveries), "deliveries")
    return edge(_typed(dump.delivery_rows(parsed), ("shipped_qty",), ("biz_time",)))


def dump_repair(spark, sf_dir):
    """The shifted delivery file as dump lines, parsed and repaired."""
    shifted = L.shifted_delivery_file(_legs(spark, sf_dir).deliveries)
    rows = dump.repaired_delivery_rows(dump.stage_parse(L.values_lines(shifted, dump.DELIVERY_COLS_7), "deliveries"))
    return edge(_typed(rows.drop("main_no"), ("shipped_qty",), ("biz_time",)))


def dump_with_header(spark, sf_dir):
    rows = dump.rows_with_header(spark, L.headed_dump(_legs(spark, sf_dir).orders), dump.ORDER_COLS_HEADERLESS, pad_from=11)
    return edge(_typed(rows, ("line_amount", "pay_amount", "item_num"), ("create_time", "update_time")))


def dump_ledger_totals(spark, sf_dir):
    """Ledger totals of headed dumps whose delivery columns have source names."""
    lg = L.shared_legs(spark, sf_dir)
    orders = dump.rows_with_header(spark, L.headed_dump(lg.orders), dump.ORDER_COLS_HEADERLESS, pad_from=11)
    back = {v: k for k, v in ledger.SOURCE_NAMES.items()}
    return ledger.ledger_summary(orders, lg.deliveries.withColumnsRenamed(back))


# --- rules that clean legs don't exercise -------------------------------------

def first_value_two_files(spark, sf_dir):
    """Positions restart in every file: the file listed first wins, then the
    place in it."""
    place = F.struct((F.month("invoice_date") % 2).alias("file_no"), F.col("src_pos").alias("row"))
    inv = _legs(spark, sf_dir).invoices.withColumn("src_pos", place).where(F.col("oms_order_no").isNotNull())
    return inv.groupBy(F.col("oms_order_no").alias("order_no")).agg(
        first_non_null("remark").alias("first_remark"), first_non_null("sales_org").alias("first_sales_org"),
        first_non_null("invoice_no").alias("first_invoice_no"))


def leg_accounting_q(spark, sf_dir):
    """Where every row of legs with missing keys goes (1998 only)."""
    lg = L.with_missing_keys(_legs(spark, sf_dir))
    return edge(leg_accounting(lg.orders, lg.deliveries, lg.invoices, OMS.with_(period=PERIOD_1998)))


def leg_accounting_mapped(spark, sf_dir):
    """The same with DMS numbers mapped to sale orders."""
    lg = L.with_missing_keys(_legs(spark, sf_dir))
    return edge(leg_accounting(lg.orders, lg.deliveries, lg.invoices, OMS.with_(period=PERIOD_1998, map_dms_invoices=True)))


def norm_code_double(spark, sf_dir):
    code = F.col("l_partkey").cast("double") + F.lit(10_000_000.0)
    li = L.read_table(spark, sf_dir, "lineitem").select(code.alias("code"))
    return li.groupBy(norm_code("code", li.schema["code"].dataType).alias("item_code")).agg(F.count(F.lit(1)).alias("n_rows"))


def text_dates(spark, sf_dir):
    """Order dates as text in several spellings; tolerant parsing of each."""
    forms = {"iso": "yyyy-MM-dd HH:mm:ss", "slash": "yyyy/MM/dd", "compact": "yyyyMMdd", "day_first": "dd-MM-yyyy"}
    o = _legs(spark, sf_dir).orders
    long = o.select(F.explode(F.array(*[F.struct(F.lit(k).alias("form"), F.date_format("create_time", f).alias("t"))
                                        for k, f in forms.items()])).alias("x")).select("x.form", safe_timestamp("x.t").alias("ts"))
    return edge(long.groupBy("form").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("ts").isNull()).alias("null_rows"),
                                         F.min("ts").alias("earliest"), F.max("ts").alias("latest")))


DATE_FORMS = {"iso": "yyyy-MM-dd HH:mm:ss", "dot": "yyyy.MM.dd HH:mm", "compact": "yyyyMMdd", "stamp": "yyyyMMddHHmmss", "day_first": "dd-MM-yyyy",
              "month_first": "MM/dd/yyyy HH:mm:ss", "month_only": "yyyy-MM"}


def _spelled_dates(spark, sf_dir):
    o = _legs(spark, sf_dir).orders
    return o.select(F.explode(F.array(*[F.struct(F.lit(k).alias("form"), F.date_format("create_time", f).alias("t"))
                                        for k, f in DATE_FORMS.items()])).alias("x")).select("x.form", "x.t")


def text_dates_voted(spark, sf_dir):
    """Order dates in seven spellings, each read as most of its values ask."""
    read = parse_dates(_spelled_dates(spark, sf_dir), ["t"], "form")
    return edge(read.groupBy("form").agg(F.count(F.lit(1)).alias("n_rows"), F.count("t").alias("n_read"), F.min("t").alias("earliest"),
                                         F.max("t").alias("latest"), F.sum(F.dayofyear("t")).alias("days")))


def date_shapes_q(spark, sf_dir):
    """The spellings met and what stays unread, by spelling."""
    return date_shapes(_spelled_dates(spark, sf_dir), ["t"], "form")


def first_value_folder(spark, sf_dir):
    """First values of a folder of dumps of very different size: files by
    name, then the place in the file."""
    k = F.col("src_pos")
    lines = L.values_lines(_legs(spark, sf_dir).orders, dump.ORDER_COLS_11).withColumn(
        "f", F.when(k % 97 == 0, "01").when(k % 7 == 0, "02").otherwise("03"))
    folder = work_path(spark, "months")
    # ranges of the order: a file is cut into parts, whose names keep it; a compressed one is read by one task, so parts are of bounded size
    lines.repartitionByRange("f", "src_pos").sortWithinPartitions("f", "src_pos").select("f", "line").write.partitionBy("f").option(
        "maxRecordsPerFile", 200_000).option("compression", "lz4").text(folder)
    rows = dump.order_rows(dump.stage_parse(dump.read_lines(spark, folder), "months"), 11)
    return rows.groupBy(F.col("sale_order_no").alias("order_no")).agg(
        first_non_null("order_status").alias("first_status"), first_non_null("item_code").alias("first_item"), F.count(F.lit(1)).alias("n_rows"))


def subcent_rounding(spark, sf_dir):
    """Sums of amounts with a fraction of a cent, rounded before and after."""
    o = _legs(spark, sf_dir).orders.select("order_type", (F.col("pay_amount") + F.lit("0.004").cast("decimal(4,3)")).alias("v"))
    kind = o.schema["v"].dataType
    return edge(o.groupBy("order_type").agg(leg_sum("v", True, kind).alias("rounded_lines"), leg_sum("v", False, kind).alias("rounded_sum")))


def oms_strict_carried(spark, sf_dir):
    """Strict rule with a carried attribute: its NULL alone makes Not test."""
    spec = S.OMS_PARTIAL.with_(period=("1997-01-01", "1997-10-01"))
    return edge(category_summary(_oms(spark, sf_dir, spec, carry={"inv_remark"})))


def column_resolution_oms(spark, sf_dir):
    raw = L.invoice_with_source_headers(_legs(spark, sf_dir).invoices)
    inv = resolve_invoice_columns(raw, "OMS")
    return edge(R.oms_invoice_totals(inv, carry={"inv_src_file", "inv_remark"}))


def oms_report(spark, sf_dir):
    """The full OMS detail under its printed headers."""
    return label_columns(report_columns(edge(_oms(spark, sf_dir, carry=True))), OMS_REPORT_LABELS)


def dms_report(spark, sf_dir):
    return label_columns(report_columns(edge(_oms(spark, sf_dir, DMS, carry=True))), DMS_REPORT_LABELS)


def report_parts_q(spark, sf_dir):
    """Parts of 500 rows of the OMS detail: sizes and key ranges."""
    parts = report_parts(written(_oms(spark, sf_dir, carry={"inv_sales_org"}), "match"), 500)
    key = F.concat_ws("|", "order_no", "item_code")
    return edge(parts.groupBy("org_group", "category", "part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("invoice_amount").cast("decimal(28,2)").alias("invoice_amount"),
        F.min(F.struct("order_no", "item_code", key.alias("k")))["k"].alias("first_key"),
        F.max(F.struct("order_no", "item_code", key.alias("k")))["k"].alias("last_key")))


QUERIES: dict[str, Query] = {
    "report_parts": report_parts_q,
    "dump_orders": dump_orders,
    "dump_utf16": dump_utf16,
    "dump_rejected": dump_rejected,
    "dump_profile": dump_profile,
    "dump_deliveries": dump_deliveries,
    "dump_repair": dump_repair,
    "dump_with_header": dump_with_header,
    "dump_ledger_totals": dump_ledger_totals,
    "first_value_two_files": first_value_two_files,
    "leg_accounting": leg_accounting_q,
    "leg_accounting_mapped": leg_accounting_mapped,
    "norm_code_double": norm_code_double,
    "text_dates": text_dates,
    "text_dates_voted": text_dates_voted,
    "date_shapes": date_shapes_q,
    "first_value_folder": first_value_folder,
    "subcent_rounding": subcent_rounding,
    "oms_strict_carried": oms_strict_carried,
    "column_resolution_oms": column_resolution_oms,
    "oms_report": oms_report,
    "dms_report": dms_report,
    "oms_category_summary": oms_category_summary,
    "oms_match_detail": oms_match_detail,
    "late_months": late_months,
    "dms_match_detail": dms_match_detail,
    "dms_category_summary": dms_category_summary,
    "dms_norm_category_summary": dms_norm_category_summary,
    "combined_summary": combined_summary,
    "oms_order_agg": oms_order_agg,
    "oms_delivery_agg": oms_delivery_agg,
    "oms_invoice_agg": oms_invoice_agg,
    "dms_order_agg": dms_order_agg,
    "dms_delivery_agg": dms_delivery_agg,
    "dms_invoice_agg": dms_invoice_agg,
    "uninvoiced_lines": uninvoiced_lines,
    "dms_to_oms_mapping": dms_to_oms_mapping,
    "dms_allocation": dms_allocation,
    "invoice_routing": invoice_routing,
    "nottest_breakdown": nottest_breakdown_q,
    "oms_nottest_rows": oms_nottest_rows,
    "oms_strict_nottest": oms_strict_nottest,
    "org_split_summary": org_split_summary_q,
    "invoice_scene": invoice_scene_q,
    "invoice_type_counts": invoice_type_counts,
    "invoice_type_label": invoice_type_label,
    "order_status_filter": order_status_filter,
    "order_type_filter": order_type_filter,
    "period_filter": period_filter_q,
    "dms_order_filter": dms_order_filter,
    "invoice_type_filter_oms": invoice_type_filter_oms,
    "invoice_type_filter_dms": invoice_type_filter_dms,
    "norm_code": norm_code_q,
    "delivery_key": delivery_key,
    "safe_number": safe_number_q,
    "shift_repair": shift_repair,
    "first_value_carry": first_value_carry,
    "order_layout_union": order_layout_union,
    "invoice_monthly_union": invoice_monthly_union,
    "column_resolution": column_resolution,
    "order_ledger": order_ledger,
    "delivery_ledger": delivery_ledger,
    "ledger_summary": ledger_summary,
    "null_share_by_period": null_share_by_period,
    "match_coverage": match_coverage_q,
    "oms_flag_counts": oms_flag_counts,
    "dms_org_split_summary": dms_org_split_summary,
    "dms_match_coverage": dms_match_coverage,
}

