"""Small result tables over a classified match: class summary, breakdowns,
coverage, the organisation split and the two-source view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trimatch.operators.classify import split_by_org
from trimatch.plans import spec as S

AMOUNT = "decimal(28,2)"


def category_summary(result: DataFrame, amount: str = "invoice_amount",
                     by: tuple[str, ...] = (), legacy_total: bool = False) -> DataFrame:
    """Rows and invoice amount per class plus an all-data row.

    The rows are aggregated by class first (partial aggregation map-side),
    and the grouping sets then run over those few class rows: the Expand
    behind grouping sets never sees the detail rows.

    ``legacy_total`` adds the old grand-total row that counted every row
    twice (all data + classes)."""
    by = list(by)
    per_class = (result.groupBy(*by, "category")
                 .agg(F.count(F.lit(1)).alias("n_rows"),
                      F.coalesce(F.sum(amount), F.lit(0)).cast(AMOUNT).alias("invoice_amount")))
    g = (per_class.groupingSets([by + ["category"], by], *by, "category")
         .agg(F.sum("n_rows").alias("n_rows"),
              F.sum("invoice_amount").cast(AMOUNT).alias("invoice_amount"),
              F.grouping("category").alias("__g")))
    out = g.select(*by, F.when(F.col("__g") == 1, S.ALL_DATA).otherwise(F.col("category")).alias("category"),
                   "n_rows", "invoice_amount")
    if legacy_total:
        tot = (out.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"),
                                    F.sum("invoice_amount").cast(AMOUNT).alias("invoice_amount"))
               .select(*by, F.lit(S.GRAND_TOTAL).alias("category"), "n_rows", "invoice_amount"))
        out = out.unionByName(tot)
    return out


def flag_counts(result: DataFrame) -> DataFrame:
    """One row: number of rows in each class (the console counts of the
    original), as columns."""
    names = ("n_not_test", "n_full_match", "n_amount_differs", "n_qty_differs", "n_both_differ")
    return result.agg(*[F.count_if(F.col("category") == c).alias(n) for n, c in zip(names, S.CATEGORIES)])


def nottest_breakdown(result: DataFrame) -> DataFrame:
    """Why rows are Not test: only the order leg missing, only the delivery
    leg, or both; counts and share of all Not-test rows.  One aggregate row,
    unpivoted; no window and no second pass."""
    nt = result.where(F.col("category") == S.NOT_TEST)
    no_order = F.col("order_amount").isNull() | F.col("order_qty").isNull()
    no_dlv = F.col("shipped_qty").isNull()
    one = nt.agg(F.count_if(no_order & ~no_dlv).alias("a"), F.count_if(~no_order & no_dlv).alias("b"),
                 F.count_if(no_order & no_dlv).alias("c"), F.count(F.lit(1)).alias("n"))
    long = one.select(F.expr(f"stack(3, '{S.MISSING_ORDER}', a, '{S.MISSING_DELIVERY}', b, "
                             f"'{S.MISSING_BOTH}', c) as (missing, n_rows)"), "n")
    return long.select("missing", "n_rows", F.col("n").alias("not_test_rows"),
                       F.try_divide(F.col("n_rows").cast("double") * F.lit(100.0), F.col("n").cast("double")).alias("share_pct"))


def match_coverage(result: DataFrame) -> DataFrame:
    """Invoice keys, and how many found an order and a delivery."""
    return result.agg(F.count(F.lit(1)).alias("invoice_keys"),
                      F.count_if(F.col("order_amount").isNotNull()).alias("with_order"),
                      F.count_if(F.col("shipped_qty").isNotNull()).alias("with_delivery"),
                      F.count_if(F.col("category") != S.NOT_TEST).alias("tested"))


def org_split_summary(result: DataFrame, col: str = "inv_sales_org") -> DataFrame:
    """Class summary per organisation group (1240/1250/1260 versus the rest),
    the split the reports are written by."""
    return category_summary(split_by_org(result, col), by=("org_group",))


def combine_sources(results: dict[str, DataFrame]) -> DataFrame:
    """Both profiles in one view: the classified rows of each source with a
    ``source`` column, unioned by name."""
    out = None
    for name, r in results.items():
        r = r.select(F.lit(name).alias("source"), "order_no", "item_code", "category",
                     "invoice_amount", "order_amount", "shipped_qty")
        out = r if out is None else out.unionByName(r)
    return out
