"""End-to-end jobs: extracts in, classified reports out.

``run`` is what one run of the original scripts does, as Spark jobs: parse
the order and delivery dumps, read the monthly invoice files and resolve
their headers, repair shifted delivery files, stage the three legs, then
reconcile and write the reports (detail by organisation group and class, the
class summary, uninvoiced lines, invoice scenes).

    python -m trimatch.plans.jobs match OMS --orders o1.sql o2.sql \\
        --deliveries d1.sql d2.sql --invoices inv/2025-01.csv ... --out out/
    python -m trimatch.plans.jobs ledger --orders ... --deliveries ... --out led/
    python -m trimatch.plans.jobs split-types --invoices ... --out types/
    python -m trimatch.plans.jobs breakdown out/
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from trimatch.operators.allocate import allocate
from trimatch.operators.classify import invoice_scene
from trimatch.operators.date_forms import date_shapes, parse_dates
from trimatch.operators.filters import filter_invoice_type_adaptive, route_invoices
from trimatch.operators.join import uninvoiced
from trimatch.functions.dates import safe_timestamp
from trimatch.operators.quality import check_schema, null_share, required_roles
from trimatch.operators.resolve import positional, require, resolve_invoice_columns
from trimatch.plans import ledger
from trimatch.plans import reconcile as R
from trimatch.plans.report import (DMS_REPORT_LABELS, OMS_REPORT_LABELS, write_by_label, write_csv,
                                   write_report)
from trimatch.plans.accounting import ACCOUNTING, leg_accounting, observed_legs, set_aside
from trimatch.plans.spec import DMS, DMS_PARTIAL, OMS, OMS_PARTIAL, SourceSpec
from trimatch.plans.summary import nottest_breakdown
from trimatch.sources import dump
from trimatch.sources.files import inputs_digest
from trimatch.sources.increments import stage_files
from trimatch.sources.invoices import read_invoice_file, read_monthly_invoices
from trimatch.sources.staging import by_period, read_back, stage_many


ORDER_DATES, DELIVERY_DATES = ["create_time", "update_time"], ["biz_time"]


def load_orders(spark: SparkSession, paths: Sequence[str], charset: str = "UTF-8") -> DataFrame:
    return dump.order_rows(dump.stage_parse(dump.read_lines(spark, list(paths), charset), "orders"))


def load_deliveries(spark: SparkSession, paths: Sequence[str], charset: str = "UTF-8") -> DataFrame:
    """Deliveries with the shifted-column repair applied per file to the
    7-value rows (8-value rows carry a main order number and are not shifted)."""
    parsed = dump.stage_parse(dump.read_lines(spark, list(paths), charset), "deliveries")
    return dump.repaired_delivery_rows(parsed).drop("layout")


def rejected(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """VALUES rows of the parsed dumps that are too short for their layout."""
    return dump.rejected_rows(orders, "orders").unionByName(dump.rejected_rows(deliveries, "deliveries"))


def load_invoices(spark: SparkSession, paths: Sequence[str], profile: str, charset: str = "UTF-8",
                  skipped: list[tuple[str, str]] | None = None) -> DataFrame:
    return resolve_invoice_columns(read_monthly_invoices(spark, list(paths), charset=charset, skipped=skipped), profile)


def kept_inputs(spark: SparkSession, name: str, orders: Sequence[str], deliveries: Sequence[str], invoices: Sequence[str],
                profile: str, charset: str = "UTF-8") -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Parsed order and delivery dumps and the invoices, kept file by file
    under ``name``: a later call parses only files that are new or changed.
    The last value lists the files that this call parsed."""
    def dump_file(path: str) -> DataFrame:
        return dump.parsed_lines(dump.read_lines(spark, path, charset))
    sets = {"orders": (orders, dump_file), "deliveries": (deliveries, dump_file),
            "invoices": (invoices, lambda path: read_invoice_file(spark, path, charset=charset))}
    kept = {leg: stage_files(spark, f"{name}/{leg}", paths, parse, (leg, charset)) for leg, (paths, parse) in sets.items()}
    o, d, i = (kept[leg].read(spark) for leg in sets)
    return o, d, resolve_invoice_columns(i, profile), [f for k in kept.values() for f in k.added]


def stage_inputs(spark: SparkSession, name: str, orders: DataFrame, deliveries: DataFrame,
                 invoices: DataFrame, refresh: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stage the parsed legs once, as concurrent jobs (positions become fixed;
    later runs reuse the staged tables)."""
    s = stage_many(spark, {f"{name}/orders": lambda: by_period(orders, "create_time"),
                           f"{name}/deliveries": lambda: by_period(deliveries, "biz_time"),
                           f"{name}/invoices": lambda: invoices}, refresh=refresh)
    return s[f"{name}/orders"], s[f"{name}/deliveries"], s[f"{name}/invoices"]


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


class RunCounts(dict):
    """Rows of each class; ``accounting`` has where every input row went and
    ``observed`` whether the match itself counted them."""
    accounting: list[Row]
    observed: bool


def _read_again(spark: SparkSession, group: str) -> bool:
    """Whether tasks of a job group failed or stages ran again, so that rows
    may have been counted twice."""
    tracker = spark.sparkContext.statusTracker()
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else ():
            s = tracker.getStageInfo(stage)
            if s and (s.currentAttemptId > 0 or s.numFailedTasks > 0):
                return True
    return False


def run(spark: SparkSession, spec: SourceSpec, orders: DataFrame, deliveries: DataFrame,
        invoices: DataFrame, out: str, fmt: str = "parquet", labels: bool = False) -> RunCounts:
    """Reconcile and write every report; returns the class counts.  With
    ``labels`` the detail carries the original workbook headers.  Beside the
    reports: ``accounting`` (where every input row went) and ``set_aside``
    (rows without a usable key), and with mapping ``dms_allocation`` (each DMS
    line laid over the orders that share its DMS number and item).

    The accounting is observed by the match while it reads the legs; it is
    counted by jobs of its own only if stages of the match had to run again, or
    if Spark never read a leg because nothing could match."""
    if spec.map_dms_invoices and "external_order_no" not in orders.columns:
        raise ValueError("mapping DMS invoices needs external_order_no on the orders; these extracts don't have it")
    legs, seen = observed_legs(orders, deliveries, invoices, spec)
    result = R.reconcile(*legs, spec.with_(prefiltered=True))
    names = (OMS_REPORT_LABELS if spec.name == "OMS" else DMS_REPORT_LABELS) if labels else None
    group = f"match-{uuid.uuid4().hex[:8]}"
    spark.sparkContext.setJobGroup(group, f"{spec.name} match")
    try:
        counts = RunCounts(write_report(result, f"{out}/match", fmt=fmt, labels=names, legacy_total=spec.legacy_total) or {})
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    found = None if _read_again(spark, group) else seen.rows()
    counts.observed = found is not None
    counts.accounting = found if found is not None else leg_accounting(orders, deliveries, invoices, spec).collect()
    if spec.name == "OMS":
        o = R.oms_order_totals(orders, spec, carry=False)
        d = R.oms_delivery_totals(deliveries, spec, carry=False)
        i = R.oms_invoice_totals(invoices, orders, spec, carry=False)
        _write(uninvoiced(o, d, i), f"{out}/uninvoiced", fmt)
    if spec.map_dms_invoices:
        _, to_map = route_invoices(filter_invoice_type_adaptive(invoices, "invoice_type"))
        pieces = allocate(to_map, R.oms_filtered_orders(orders, spec), spec.normalize_codes)
        _write(pieces.drop("src_pos") if fmt == "csv" else pieces, f"{out}/dms_allocation", fmt)
    if "invoice_type" in invoices.columns and "dms_order_no" in invoices.columns:
        flat = invoices.drop("src_pos") if fmt == "csv" else invoices
        write_by_label(invoice_scene(flat), "scene", f"{out}/scenes", fmt)
    _write(spark.createDataFrame(counts.accounting, ACCOUNTING).coalesce(1), f"{out}/accounting", fmt)
    _write(set_aside(orders, deliveries, invoices, spec), f"{out}/set_aside", fmt)
    return counts


def ledgers(spark: SparkSession, order_paths: Sequence[str], delivery_paths: Sequence[str], out: str,
            charset: str = "UTF-8") -> None:
    """Order and delivery ledgers and their totals, as CSV (empty for NULL)
    with printed headers.  Column names come from each dump's own header line
    when it has one; source headers are understood."""
    ol = dump.read_lines(spark, list(order_paths), charset)
    dl = dump.read_lines(spark, list(delivery_paths), charset)
    orders = dump.rows_with_header(spark, ol, dump.ORDER_COLS_HEADERLESS, pad_from=11)
    deliveries = dump.rows_with_header(spark, dl, dump.DELIVERY_COLS_7)
    write_csv(ledger.labelled(ledger.order_ledger(orders), ledger.ORDER_LEDGER_LABELS), f"{out}/order_ledger")
    write_csv(ledger.labelled(ledger.delivery_ledger(deliveries), ledger.DELIVERY_LEDGER_LABELS), f"{out}/delivery_ledger")
    write_csv(ledger.ledger_summary(orders, deliveries).coalesce(1), f"{out}/summary")


def split_types(spark: SparkSession, invoice_paths: Sequence[str], out: str, fmt: str = "csv") -> None:
    """One output per invoice type (NULL types skipped), file-safe names; the
    type column is found by name, else it is the 15th column."""
    inv = read_monthly_invoices(spark, list(invoice_paths))
    col = next((c for c in inv.columns if "发票类型" in c), None) or positional(inv.columns)
    require("invoice_type", col)
    write_by_label(inv.drop("src_pos") if fmt == "csv" else inv, col, out, fmt)


def breakdown(spark: SparkSession, report: str, fmt: str = "parquet") -> DataFrame:
    """Missing-leg breakdown of the Not-test rows of a written match report."""
    detail = read_back(spark, f"{report}/match/detail", fmt)
    for labels in (OMS_REPORT_LABELS, DMS_REPORT_LABELS):       # a labelled report reads alike
        if labels["shipped_qty"] in detail.columns:
            detail = detail.withColumnsRenamed({v: k for k, v in labels.items()})
    if "order_qty" not in detail.columns:
        detail = detail.withColumn("order_qty", F.lit(None))
    return nottest_breakdown(detail)


def check(spark: SparkSession, orders: DataFrame, deliveries: DataFrame, invoices: DataFrame) -> DataFrame:
    """Conformance findings of staged legs: order columns and their order,
    delivery columns as a set, invoice key roles present."""
    o = check_schema(spark, orders.drop("src_file", "src_pos", "period_year"), dump.ORDER_COLS_13, "orders")
    d = check_schema(spark, deliveries.drop("src_file", "src_pos", "period_year", "main_no"),
                     dump.DELIVERY_COLS_7, "deliveries", as_set=True)
    roles = required_roles(spark, invoices.columns, {"order_no": ("oms_order_no", "dms_order_no"),
                                                     "material": ("item_code",)}, "invoices")
    return o.unionByName(d).unionByName(
        roles.select("table", F.when(F.col("present"), "ok").otherwise("missing").alias("finding"),
                     F.col("role").alias("detail")))


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="trimatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("match", help="reconcile and write the reports")
    m.add_argument("source", choices=["OMS", "DMS"])
    m.add_argument("--orders", nargs="+", required=True)
    m.add_argument("--deliveries", nargs="+", required=True)
    m.add_argument("--invoices", nargs="+", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--charset", default="UTF-8")
    m.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    m.add_argument("--period", nargs=2, metavar=("START", "END"))
    m.add_argument("--normalize-codes", choices=["on", "off"], help="override the profile default")
    m.add_argument("--map-dms", action="store_true", help="OMS: map DMS-only invoices via the orders")
    m.add_argument("--legacy-total", action="store_true", help="add the old doubled total row")
    m.add_argument("--labels", action="store_true", help="original workbook headers in the detail")
    m.add_argument("--partial", action="store_true", help="partial-year profile of the source")
    m.add_argument("--skip-unreadable", action="store_true", help="go on without invoice files that can't be read; they are listed in OUT/skipped")
    m.add_argument("--keep", metavar="NAME", help="keep the parsed files under this name; later runs with it parse only new or changed files")
    m.add_argument("--refresh", action="store_true", help="re-parse even if staged legs exist")
    lg = sub.add_parser("ledger", help="order and delivery ledgers with totals")
    lg.add_argument("--orders", nargs="+", required=True)
    lg.add_argument("--deliveries", nargs="+", required=True)
    lg.add_argument("--out", required=True)
    lg.add_argument("--charset", default="UTF-8")
    st = sub.add_parser("split-types", help="one output per invoice type")
    st.add_argument("--invoices", nargs="+", required=True)
    st.add_argument("--out", required=True)
    bd = sub.add_parser("breakdown", help="missing-leg breakdown of a written report")
    bd.add_argument("report")
    bd.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    a = ap.parse_args(argv)

    from trimatch.session import build_session
    spark = build_session(app=f"trimatch-{a.cmd}")
    if a.cmd == "ledger":
        ledgers(spark, a.orders, a.deliveries, a.out, a.charset)
        return
    if a.cmd == "split-types":
        split_types(spark, a.invoices, a.out)
        return
    if a.cmd == "breakdown":
        for r in breakdown(spark, a.report, a.format).collect():
            print(f"{r['missing']}\t{r['n_rows']}\t{r['share_pct']:.1f}%")
        return
    spec = {("OMS", False): OMS, ("OMS", True): OMS_PARTIAL, ("DMS", False): DMS, ("DMS", True): DMS_PARTIAL}[a.source, a.partial]
    if a.period:
        spec = spec.with_(period=tuple(a.period))
    if a.normalize_codes:
        spec = spec.with_(normalize_codes=a.normalize_codes == "on")
    spec = spec.with_(map_dms_invoices=a.map_dms, legacy_total=a.legacy_total)
    skipped: list[tuple[str, str]] | None = [] if a.skip_unreadable else None
    if a.keep and (a.skip_unreadable or a.refresh):
        ap.error("--keep takes neither --skip-unreadable nor --refresh")
    invoices = None if a.keep else load_invoices(spark, a.invoices, a.source, a.charset, skipped)
    digest = inputs_digest(spark, [*a.orders, *a.deliveries, *a.invoices], len(a.orders), len(a.deliveries), a.source, a.charset, skipped,
                           *(["kept"] if a.keep else []))
    name = f"job-{a.source}-{digest}"
    if a.keep:
        po, pd, invoices, added = kept_inputs(spark, f"kept-{a.keep}", a.orders, a.deliveries, a.invoices, a.source, a.charset)
        print(f"parsed\t{len(added)}")
    else:
        lines = {leg: dump.read_lines(spark, paths, a.charset) for leg, paths in (("orders", a.orders), ("deliveries", a.deliveries))}
        parsed = stage_many(spark, {f"{name}/{leg}-tokens": partial(dump.parsed_lines, x) for leg, x in lines.items()}, refresh=a.refresh)
        po, pd = parsed[f"{name}/orders-tokens"], parsed[f"{name}/deliveries-tokens"]
    orders, deliveries = dump.order_rows(po), dump.repaired_delivery_rows(pd).drop("layout")
    o, d, i = stage_inputs(spark, name, parse_dates(orders, ORDER_DATES), parse_dates(deliveries, DELIVERY_DATES), invoices, refresh=a.refresh)
    counts = run(spark, spec, o, d, i, a.out, a.format, labels=a.labels)
    _write(rejected(po, pd).withColumn("src_pos", F.to_json("src_pos")), f"{a.out}/rejected", a.format)
    _write(dump.file_profile(po).unionByName(dump.file_profile(pd)).coalesce(1), f"{a.out}/dump_profile", a.format)
    dates = date_shapes(orders, ORDER_DATES).unionByName(date_shapes(deliveries, DELIVERY_DATES))
    _write(dates.where("unread > 0").coalesce(1), f"{a.out}/unread_dates", a.format)
    if skipped:
        _write(spark.createDataFrame(skipped, "path string, reason string").coalesce(1), f"{a.out}/skipped", a.format)
        for path, reason in skipped:
            print(f"skipped\t{path}\t{reason}")
    if "line_amount" in o.columns:
        when = o.withColumn("create_time", safe_timestamp("create_time", dtype=o.schema["create_time"].dataType))
        for r in null_share(when, "line_amount", "create_time").collect():
            print(f"check\tline_amount\t{r['period']}\t{r['null_rows']} of {r['n_rows']} NULL")
    for f in check(spark, o, d, i).where(F.col("finding") != "ok").collect():
        print(f"check\t{f['table']}\t{f['finding']}\t{f['detail']}")
    for k in sorted(counts):
        print(f"{k}\t{counts[k]}")


if __name__ == "__main__":
    main()
