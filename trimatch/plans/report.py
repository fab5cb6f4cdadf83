"""Report writers (sinks).  Reports are Parquet or CSV directories laid out by
partition columns instead of one workbook per split; every write is a
distributed job and nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trimatch.functions.codes import safe_label
from trimatch.operators.classify import split_by_org
from trimatch.operators.numbering import number_rows, work_path
from trimatch.plans import spec as S
from trimatch.plans.summary import category_summary
from trimatch.sources.files import remove

# Report headers of the original workbooks.
OMS_REPORT_LABELS = {
    "order_amount": "订单金额", "order_qty": "订单数量", "shipped_qty": "发货数量",
    "invoice_amount": "开票金额", "invoice_qty": "开票数量",
    "order_minus_shipped_qty": "订单-发货数量", "order_minus_invoice_qty": "订单-开票数量",
    "shipped_minus_invoice_qty": "发货-开票数量", "order_minus_invoice_amount": "订单-发票金额",
    "ord_sale_order_no": "订单-销售订单号", "ord_platform_order_no": "订单-平台订单号",
    "ord_main_order_no": "订单-主订单号", "ord_channel_name": "订单-渠道名称",
    "ord_order_type": "订单-订单类型", "ord_order_status": "订单-订单状态",
    "ord_create_time": "订单-创建时间", "ord_update_time": "订单-更新时间",
    "ord_item_code": "订单-商品代码",
    "dlv_order_no": "发货-订单号", "dlv_main_no": "发货-主单号",
    "dlv_external_order_no": "发货-外部订单号", "dlv_biz_time": "发货-业务时间",
    "dlv_item_code": "发货-料号", "dlv_item_name": "发货-商品名称", "dlv_business_type": "发货-业务类型",
    "inv_invoice_no": "发票-SAP发票号", "inv_company_code": "发票-公司代码", "inv_remark": "发票-发票备注",
    "inv_invoice_type": "发票-发票类型", "inv_sales_org": "发票-销售组织",
    "inv_invoice_date": "发票-开票日期", "inv_customer_name": "发票-客户名称",
    "inv_item_name": "发票-物料名称", "inv_src_file": "发票-数据源文件",
    "inv_dms_order_no": "发票-DMS销售单号",
}
DMS_REPORT_LABELS = {
    "order_no": "DMS订单", "item_code": "物料编码", "invoice_amount": "SAP开票含税金额",
    "invoice_qty_sales": "SAP开票销售数量", "invoice_qty": "SAP开票基本数量",
    "order_amount": "DMS订单金额", "order_qty": "DMS订单数量", "shipped_qty": "DMS发货数量",
    "invoice_minus_order_amount": "SAP-DMS订单金额",
    "invoice_minus_order_qty": "SAP-DMS订单数量(基本单位)",
    "invoice_minus_shipped_qty": "SAP-DMS发货数量(基本单位)",
    "ord_sale_order_no": "订单-销售订单号", "ord_main_order_no": "订单-主订单号",
    "ord_channel_name": "订单-渠道名称", "ord_order_type": "订单-订单类型",
    "ord_order_status": "订单-订单状态", "ord_create_time": "订单-创建时间",
    "ord_update_time": "订单-更新时间", "ord_platform_order_no": "订单-平台订单号",
    "ord_item_code": "订单-商品代码",
    "dlv_order_no": "发货-订单号", "dlv_main_no": "发货-主单号", "dlv_biz_time": "发货-业务时间",
    "dlv_item_name": "发货-物料名称", "dlv_business_type": "发货-业务类型",
    "dlv_external_order_no": "发货-外部订单号", "dlv_item_code": "发货-料号",
    "inv_invoice_no": "发票-SAP发票号", "inv_sap_order_no": "发票-SAP订单号",
    "inv_oms_order_no": "发票-OMS订单号", "inv_company_code": "发票-公司代码",
    "inv_remark": "发票-发票备注", "inv_invoice_type": "发票-发票类型",
    "inv_sales_org": "发票-销售组织", "inv_customer_name": "发票-客户名称",
    "inv_item_name": "发票-物料名称", "inv_invoice_date": "发票-开票日期",
    "inv_src_file": "发票-数据源文件",
}


def report_columns(result: DataFrame, last: str = "inv_dms_order_no") -> DataFrame:
    """Column order of the detail report: the DMS number goes last."""
    cols = [c for c in result.columns if c != last] + ([last] if last in result.columns else [])
    return result.select(*cols)


def label_columns(result: DataFrame, labels: dict[str, str]) -> DataFrame:
    return result.withColumnsRenamed({k: v for k, v in labels.items() if k in result.columns})


def write_csv(df: DataFrame, path: str, null_value: str = "", mode: str = "overwrite",
              partition_by=()) -> None:
    w = df.write.mode(mode).option("header", True).option("nullValue", null_value)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def report_parts(result: DataFrame, max_rows: int = S.REPORT_MAX_ROWS, org_col: str = "inv_sales_org") -> DataFrame:
    """``result`` with ``org_group`` and ``part``: inside each organisation
    group and class the rows, by order number and item code, fill parts 1, 2, ...
    of exactly ``max_rows`` rows; only the last may hold fewer.

    ``result`` should be written rows: it is read twice.  Only classes of more
    than ``max_rows`` rows are sorted and numbered."""
    split = split_by_org(result, org_col)
    where = ["org_group", "category"]
    sizes = split.groupBy(*where).agg(F.count(F.lit(1)).alias("__rows")).select(
        F.col("org_group").alias("__g"), F.col("category").alias("__c"), (F.col("__rows") > max_rows).alias("__cut"))
    split = split.join(sizes, F.col("org_group").eqNullSafe(F.col("__g")) & F.col("category").eqNullSafe(F.col("__c"))).drop("__g", "__c")
    whole = split.where(~F.col("__cut")).drop("__cut").withColumn("part", F.lit(1).cast("long"))
    cut = number_rows(split.where("__cut").drop("__cut"), ["order_no", "item_code"], where, out="__no", unique=True)
    return whole.unionByName(cut.withColumn("part", F.floor(F.col("__no") / max_rows) + 1).drop("__no"))


def write_report(result: DataFrame, path: str, fmt: str = "parquet", max_rows: int = S.REPORT_MAX_ROWS,
                 org_col: str = "inv_sales_org", null_value: str = "N/A",
                 labels: dict[str, str] | None = None, legacy_total: bool = False) -> dict[str, int] | None:
    """Classified detail partitioned by ``org_group``, ``category`` and
    ``part`` (so each organisation group's Not-test rows are a partition, not a
    second pass), plus the class summary per group under ``path/summary``.  A
    part is one file of exactly ``max_rows`` rows, the last of a class of fewer.

    The match runs once: it is written as it comes, and parts and summary are
    made from that copy, which goes when the report is there.  Returns the
    rows of each class over all groups, or None for an empty result, of which
    nothing is left on disk."""
    spark = result.sparkSession
    copy = work_path(spark, "match")
    result.write.parquet(copy)
    detail = spark.read.schema(result.schema).parquet(copy)
    summary = category_summary(split_by_org(detail, org_col), by=("org_group",), legacy_total=legacy_total)
    rows = summary.collect()                     # a few rows for each organisation group
    if rows:
        parts = report_columns(report_parts(detail, max_rows, org_col))
        where = ("org_group", "category", "part")
        shown = (label_columns(parts, labels) if labels else parts).repartition(*where)
        if fmt == "csv":
            write_csv(shown, f"{path}/detail", null_value, partition_by=where)
        else:
            shown.write.mode("overwrite").partitionBy(*where).parquet(f"{path}/detail")
        out = spark.createDataFrame(rows, summary.schema).coalesce(1)
        if fmt == "csv":
            write_csv(out, f"{path}/summary")
        else:
            out.write.mode("overwrite").parquet(f"{path}/summary")
    remove(spark, copy)
    if not rows:
        remove(spark, path)
        return None
    counts: dict[str, int] = {}
    for x in rows:
        counts[x["category"]] = counts.get(x["category"], 0) + x["n_rows"]
    return counts


def write_by_label(df: DataFrame, col: str, path: str, fmt: str = "parquet") -> None:
    """One output directory per value of ``col`` (NULLs skipped), named by a
    file-safe label of the value."""
    out = df.where(F.col(col).isNotNull()).withColumn("label", safe_label(col))
    w = out.write.mode("overwrite").partitionBy("label")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
