"""Order, delivery and invoice legs derived from the benchmark tables.

The reconciliation reads three extracts.  For benchmarking and the SQL oracle
they are derived, deterministically, from ``lineitem ⋈ orders ⋈ customer``:
one line item is one order line; most lines also appear as a delivery line
and as an invoice line, with planted gaps and differences so that every class
of the reconciliation is populated.  The rule set is the one documented in
FIXTURES.md §3; the SQL twin lives in :mod:`trimatch.plans.oracles`.

Every leg keeps ``src_file`` and ``src_pos`` so "first value" aggregates are
deterministic (Spark has no row order).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.functions.numbers import MONEY
from trimatch.operators.numbering import written
from trimatch.sources.dump import DELIVERY_COLS_7, DELIVERY_COLS_8, ORDER_COLS_11, ORDER_COLS_13

# Fixed values of the derivation (FIXTURES.md §3).
DMS_SEGMENTS = ("BUILDING", "MACHINERY")
PRIORITY_TO_TYPE = (
    ("1-URGENT", "liquid_milk_order"),
    ("2-HIGH", "factory_item"),
    ("3-MEDIUM", "oem_order"),
    ("4-NOT SPECIFIED", "oem_order"),
)
OTHER_TYPE = "gift_order"
RETURNFLAG_TO_INVOICE_TYPE = (("A", "标准发票（2B)"), ("N", "标准退货发票"), ("R", "标准发票（2C)"))
RETURNFLAG_TO_TYPE_CODE = (("A", "ZA01"), ("N", "ZB02"), ("R", "ZC09"))


@dataclass(frozen=True)
class Legs:
    orders: DataFrame
    deliveries: DataFrame
    invoices: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the order and customer columns the legs use.

    ``orders ⋈ customer`` is joined first (customer is the smaller side; AQE
    broadcasts it only when its measured size is under the threshold), then
    the result meets ``lineitem`` on the order key."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # The join shuffles are left to Spark (ENSURE_REQUIREMENTS), so AQE keeps
    # its skew-join split and its broadcast-by-measured-size decisions.
    oc = o.join(c, o.o_custkey == c.c_custkey)
    b = li.join(oc, li.l_orderkey == oc.o_orderkey)
    k, p = F.col("l_orderkey"), F.col("l_partkey")
    qty = F.col("l_quantity").cast(MONEY)
    amt = F.round(F.col("l_extendedprice").cast("decimal(12,2)")
                  * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2).cast(MONEY)
    return b.select(
        k.alias("k"), p.alias("p"), F.col("l_linenumber").alias("ln"),
        F.col("l_suppkey").alias("sk"), F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"), F.col("l_shipdate").alias("sd"),
        F.col("o_orderdate").alias("od"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("pr"), F.col("c_mktsegment").alias("seg"),
        F.col("c_name").alias("cname"),
        F.lpad(k.cast("string"), 10, "0").alias("kk"),
        F.col("c_mktsegment").isin(*DMS_SEGMENTS).alias("dms"),
        qty.alias("qty"), amt.alias("amt"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        # position of the line inside its (order, part) group; unique there
        (F.col("l_linenumber").cast("long") * F.lit(10 ** 15)
         + F.col("l_suppkey") * F.lit(10 ** 5)
         + (qty * 100).cast("long")).alias("src_pos"),
    )


def _case(col: Column, pairs, default=None) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out.otherwise(default) if default is not None else out


def order_leg(base: DataFrame) -> DataFrame:
    k = F.col("k")
    status = F.when(F.col("st") == "P",
                    F.when(k % 5 == 0, "CANCEL").when(k % 5 == 1, "OBSOLETE")
                    .when(k % 5 == 2, F.lit(None)).otherwise(F.col("st"))).otherwise(F.col("st"))
    channel = (F.when(F.col("seg") == "BUILDING", "DMS-BUILDING")
               .when(F.col("seg") == "MACHINERY", "dms-machinery")
               .otherwise(F.concat(F.lit("OMS-"), F.col("seg"))))
    late = F.month("od") > 9
    return base.select(
        k.cast("string").alias("platform_order_no"),
        F.lit(None).cast("string").alias("main_order_no"),
        F.concat(F.lit("DD"), F.col("kk")).alias("sale_order_no"),
        F.when(F.col("dms"), k.cast("string")).alias("external_order_no"),
        _case(F.col("pr"), PRIORITY_TO_TYPE, OTHER_TYPE).alias("order_type"),
        status.alias("order_status"),
        F.col("od").alias("create_time"),
        F.col("sd").alias("update_time"),
        channel.alias("channel_name"),
        F.concat(F.col("p").cast("string"),
                 F.when(F.col("ln") % 2 == 0, ".0").otherwise("")).alias("item_code"),
        F.when(late, F.col("price")).alias("line_amount"),
        F.col("amt").alias("pay_amount"),
        F.col("qty").alias("item_num"),
        F.lit(None).cast("string").alias("channel_name2"),
        F.when(late, "orders_10_12.sql").otherwise("orders_01_09.sql").alias("src_file"),
        F.col("src_pos"),
    )


def delivery_leg(base: DataFrame) -> DataFrame:
    k, p = F.col("k"), F.col("p")
    even = k % 2 == 0
    dd = F.concat(F.lit("DD"), F.col("kk"))
    return base.where((k + p) % 10 != 0).select(
        F.when(F.col("rf") == "R", "RETURN").otherwise("SHIP").alias("business_type"),
        F.when(even, dd).alias("main_no"),
        F.when(even, F.concat(F.lit("SUB"), F.col("kk"))).otherwise(dd).alias("order_no"),
        F.when(F.col("dms"), k.cast("string")).alias("external_order_no"),
        F.col("sd").alias("biz_time"),
        p.cast("string").alias("item_code"),
        F.concat(F.lit("part-"), p.cast("string")).alias("item_name"),
        F.when(p % 17 == 0, F.col("qty") - 1).otherwise(F.col("qty")).cast(MONEY).alias("shipped_qty"),
        F.when(F.month("sd") > 9, "delivery_10_12.sql").otherwise("delivery_01_09.sql").alias("src_file"),
        F.col("src_pos"),
    )


def invoice_leg(base: DataFrame, type_codes: bool = False) -> DataFrame:
    k, p = F.col("k"), F.col("p")
    amount = (F.when(p % 7 == 0, F.col("amt") + F.lit(5).cast(MONEY))
              .when(p % 11 == 0, F.col("amt") + F.lit("0.50").cast(MONEY))
              .otherwise(F.col("amt"))).cast(MONEY)
    pairs = RETURNFLAG_TO_TYPE_CODE if type_codes else RETURNFLAG_TO_INVOICE_TYPE
    return base.where((k + 2 * p) % 13 != 0).select(
        F.when(~F.col("dms"), F.concat(F.lit("DD"), F.col("kk"))).alias("oms_order_no"),
        F.when(F.col("dms"), k.cast("string")).alias("dms_order_no"),
        p.cast("string").alias("item_code"),
        _case(F.col("rf"), pairs).alias("invoice_type"),
        (F.lit(1240) + F.lit(10) * (F.col("sk") % 5)).cast("string").alias("sales_org"),
        (F.lit(1000) + F.col("sk") % 3).cast("string").alias("company_code"),
        F.concat(F.lit("INV"), F.col("kk"), F.lit("-"), F.col("ln").cast("string")).alias("invoice_no"),
        F.col("cname").alias("customer_name"),
        F.concat(F.lit("part-"), p.cast("string")).alias("item_name"),
        F.when(F.col("rf") == "N", "return").alias("remark"),
        F.col("sd").alias("invoice_date"),
        amount.alias("amount"),
        F.col("qty").alias("qty"),
        F.col("qty").alias("qty_sales_unit"),
        F.col("qty").alias("qty_base_unit"),
        F.concat(F.lit("invoice_"), F.date_format("sd", "yyyy-MM")).alias("src_file"),
        F.col("src_pos"),
    )


# Staged legs registered by :func:`stage_legs`: sf_dir -> {leg name: reader}.
# The readers are plain lazy DataFrames over the staged files; keeping them
# saves re-listing the files for every query.
_STAGED: dict[str, dict[str, DataFrame]] = {}


def legs(spark: SparkSession, sf_dir: str, type_codes: bool = False) -> Legs:
    """The three legs: the staged copies when :func:`stage_legs` ran for this
    input in this process, else derived lazily from the tables."""
    staged = _STAGED.get(sf_dir)
    if staged:
        inv = staged["invoices_codes" if type_codes else "invoices"]
        return Legs(staged["orders"], staged["deliveries"], inv)
    base = base_lines(spark, sf_dir)
    return Legs(order_leg(base), delivery_leg(base), invoice_leg(base, type_codes))


def shared_legs(spark: SparkSession, sf_dir: str, type_codes: bool = False) -> Legs:
    """:func:`legs` for a query that reads several legs, or one several times:
    the tables are joined once, into a written line table."""
    if sf_dir in _STAGED:
        return legs(spark, sf_dir, type_codes)
    base = written(base_lines(spark, sf_dir), "lines", "zstd")
    return Legs(order_leg(base), delivery_leg(base), invoice_leg(base, type_codes))


def stage_legs(spark: SparkSession, sf_dir: str, refresh: bool = False) -> Legs:
    """Stage the legs as Parquet in the shared checkpoint folder, like staging
    the parsed extracts of a period: the tables are joined once into a line
    table, and each leg is written as a projection of that staged table,
    partitioned by the year of its business date (``period_year``) so date
    windows skip whole directories."""
    from trimatch.sources.staging import by_period, stage, stage_many

    root = "legs-" + "".join(ch if ch.isalnum() else "_" for ch in sf_dir.strip("/"))
    base = stage(spark, f"{root}/lines", lambda: base_lines(spark, sf_dir), refresh=refresh)
    builders = {f"{root}/orders": lambda: by_period(order_leg(base), "create_time"),
                f"{root}/deliveries": lambda: by_period(delivery_leg(base), "biz_time"),
                f"{root}/invoices": lambda: by_period(invoice_leg(base), "invoice_date"),
                f"{root}/invoices_codes": lambda: by_period(invoice_leg(base, True), "invoice_date")}
    staged = stage_many(spark, builders, refresh=refresh, partition_by=("period_year",))
    _STAGED[sf_dir] = {name.rsplit("/", 1)[1]: df for name, df in staged.items()}
    return legs(spark, sf_dir)


def unstage_legs(sf_dir: str | None = None) -> None:
    """Forget staged legs (all, or those of one input)."""
    for k in [k for k in _STAGED if sf_dir is None or k == sf_dir]:
        del _STAGED[k]


# --- variant extracts -------------------------------------------------------

def order_extracts(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two order layouts: Jan-Sep with 11 columns, Oct-Dec with 13."""
    early = orders.where(F.month("create_time") <= 9).select(*ORDER_COLS_11, "src_file", "src_pos")
    late = orders.where(F.month("create_time") > 9).select(*ORDER_COLS_13, "src_file", "src_pos")
    return early, late


def monthly_invoice_extracts(invoices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Invoice files whose headers differ: Jan-Sep lack ``qty_sales_unit``,
    Oct-Dec lack ``remark``."""
    early = invoices.where(F.month("invoice_date") <= 9).drop("qty_sales_unit")
    late = invoices.where(F.month("invoice_date") > 9).drop("remark")
    return early, late


def shifted_delivery_file(deliveries: DataFrame) -> DataFrame:
    """7-column delivery rows as two files: ``early`` (Jan-Sep) written with
    columns 2 and 5 swapped, ``late`` written correctly.  Order numbers are
    the ``DD`` form throughout."""
    d = deliveries.withColumn("order_no", F.coalesce("main_no", "order_no"))
    early = F.month("biz_time") <= 9
    return d.select(
        "business_type",
        F.when(early, F.col("item_code")).otherwise(F.col("order_no")).alias("order_no"),
        "external_order_no",
        F.col("biz_time").cast("string").alias("biz_time"),
        F.when(early, F.col("order_no")).otherwise(F.col("item_code")).alias("item_code"),
        "item_name",
        F.col("shipped_qty").cast("string").alias("shipped_qty"),
        F.when(early, "early").otherwise("late").alias("src_file"),
        "src_pos",
    )


# Source-style headers of the invoice extract, used to exercise the column
# resolver: (canonical column, header as it appears in the invoice workbook).
# The amount appears twice, as the actual and as the tax-inclusive amount.
INVOICE_SOURCE_HEADERS = (
    ("oms_order_no", "OMS销售单号"),
    ("dms_order_no", "DMS销售单号"),
    ("item_code", "物料编码"),
    ("invoice_type", "发票类型"),
    ("sales_org", "销售组织"),
    ("company_code", "公司代码"),
    ("invoice_no", "SAP发票号"),
    ("customer_name", "客户名称"),
    ("item_name", "物料名称"),
    ("remark", "发票备注"),
    ("invoice_date", "开票日期"),
    ("amount", "实际金额"),
    ("amount", "含税金额"),
    ("qty_sales_unit", "开票数量（销售单位）"),
    ("qty_base_unit", "开票数量（基本单位数量）"),
    ("src_file", "数据源文件"),
)


def invoice_with_source_headers(invoices: DataFrame) -> DataFrame:
    cols = [F.col(c).cast("string").alias(h) for c, h in INVOICE_SOURCE_HEADERS]
    return invoices.select(*cols, "src_pos")


# --- legs as dump lines -------------------------------------------------------

def _with_tokens(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """``df`` with the tokens of the given columns, each made once however many
    kinds of line hold it."""
    kinds = dict(df.dtypes)

    def token(c: str) -> Column:
        v = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kinds[c].startswith("timestamp") else F.col(c).cast("string")
        return F.coalesce(F.concat(F.lit("'"), v, F.lit("'")), F.lit("NULL"))
    return df.withColumns({f"__t_{c}": token(c) for c in cols})


def _line(cols: list[str] | tuple[str, ...]) -> Column:
    return F.concat(F.lit("VALUES ("), F.concat_ws(", ", *[F.col(f"__t_{c}") for c in cols]), F.lit(");"))


def values_lines(df: DataFrame, cols: list[str] | tuple[str, ...], names=()) -> DataFrame:
    """``(src_file, src_pos, line)``: rows as VALUES lines of the given columns."""
    return _with_tokens(df, cols).select("src_file", "src_pos", _line(cols).alias("line"), *names)


def order_dump(orders: DataFrame) -> DataFrame:
    """The two order files as lines; every late row whose position divides by
    101 lacks its last value.  One pass over the orders."""
    month, at = F.month("create_time"), F.col("src_pos")
    line = F.when(month <= 9, _line(ORDER_COLS_11)).when(at % 101 == 0, _line(ORDER_COLS_13[:12])).otherwise(_line(ORDER_COLS_13))
    rows = orders.where((month <= 9) | (month.isNotNull() & at.isNotNull()))
    return _with_tokens(rows, ORDER_COLS_13).select("src_file", "src_pos", line.alias("line"))


def delivery_dump(deliveries: DataFrame) -> DataFrame:
    """Deliveries as lines: 8 values with a main order number, else 7."""
    line = F.when(F.col("main_no").isNotNull(), _line(DELIVERY_COLS_8)).otherwise(_line(DELIVERY_COLS_7))
    return _with_tokens(deliveries, DELIVERY_COLS_8).select("src_file", "src_pos", line.alias("line"))


def headed_dump(orders: DataFrame) -> DataFrame:
    """The order files, each with its own header line: the early one names its
    11 columns, the late one has none that names columns."""
    spark, month = orders.sparkSession, F.month("create_time")
    heads = spark.createDataFrame(
        [("orders_01_09.sql", -1, f"INSERT INTO orders ({', '.join(ORDER_COLS_11)}) VALUES"),
         ("orders_10_12.sql", -1, "INSERT INTO orders VALUES")], "src_file string, src_pos long, line string")
    line = F.when(month <= 9, _line(ORDER_COLS_11)).otherwise(_line(ORDER_COLS_13[:9] + ORDER_COLS_13[10:12]))
    rows = _with_tokens(orders.where(month.isNotNull()), ORDER_COLS_13).select("src_file", "src_pos", line.alias("line"))
    return heads.unionByName(rows)


def with_missing_keys(lg: Legs) -> Legs:
    """The legs with some item codes and order numbers removed."""
    def gone(col: str, n: int) -> Column:
        return F.when(F.col("src_pos") % n != 0, F.col(col))
    return Legs(lg.orders.withColumns({"item_code": gone("item_code", 37), "sale_order_no": gone("sale_order_no", 53)}),
                lg.deliveries.withColumn("item_code", gone("item_code", 41)),
                lg.invoices.withColumns({"item_code": gone("item_code", 43), "oms_order_no": gone("oms_order_no", 59)}))
