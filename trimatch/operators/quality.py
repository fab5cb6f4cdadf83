"""Data-quality checks: schema conformance, null share by period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def check_schema(spark: SparkSession, df: DataFrame, expected: Sequence[str], name: str,
                 ordered: bool = True, as_set: bool = False) -> DataFrame:
    """Findings table comparing ``df.columns`` with ``expected``: missing,
    extra, and (when ``ordered``) wrong order.  Metadata only; no Spark job."""
    got = list(df.columns)
    rows = [(name, "missing", c) for c in expected if c not in got]
    rows += [(name, "extra", c) for c in got if c not in expected]
    if not rows and ordered and not as_set and got != list(expected):
        rows.append((name, "order", ",".join(got)))
    if not rows:
        rows.append((name, "ok", str(len(got))))
    return spark.createDataFrame(rows, "table string, finding string, detail string")


def required_roles(spark: SparkSession, columns: Sequence[str], roles: dict[str, Sequence[str]],
                   name: str) -> DataFrame:
    """Whether each role has at least one candidate column present."""
    rows = [(name, role, any(c in columns for c in cands)) for role, cands in roles.items()]
    return spark.createDataFrame(rows, "table string, role string, present boolean")


def null_share(df: DataFrame, col: str, date_col: str, split_month: int = 9,
               threshold: float = 0.9) -> DataFrame:
    """Per period (months up to ``split_month`` / after it): rows, NULL rows,
    NULL share and whether that share exceeds ``threshold``."""
    period = F.when(F.month(date_col) <= split_month, "early").when(F.month(date_col) > split_month, "late")
    g = df.where(F.col(date_col).isNotNull()).groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(col).isNull()).alias("null_rows"))
    share = F.col("null_rows").cast("double") / F.col("n_rows").cast("double")
    return g.select("period", "n_rows", "null_rows", share.alias("null_share"),
                    (share > F.lit(threshold)).alias("mostly_null"))
