"""Shifted-column repair for 7-column delivery files.

Some delivery files arrive with columns 2 (order number) and 5 (item code)
exchanged.  A file is repaired as a whole when more than ``share`` of its
column-2 values are all digits and more than ``share`` of its column-5 values
start with ``DD``.  The decision is one small aggregate per file joined back;
nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = r"^[0-9]+$"
DD_PREFIX = r"^DD"


def shift_flags(df: DataFrame, col2: str = "order_no", col5: str = "item_code",
                file_col: str = "src_file", share: float = 0.5) -> DataFrame:
    """Per file: rows, column-2 values that are digits, column-5 values that
    start with ``DD``, and whether the file is swapped."""
    hit2 = F.coalesce(F.col(col2).rlike(DIGITS), F.lit(False))
    hit5 = F.coalesce(F.col(col5).rlike(DD_PREFIX), F.lit(False))
    g = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.count_if(hit2).alias("digits_col2"),
                                 F.count_if(hit5).alias("dd_col5"))
    swap = (F.col("digits_col2") > F.col("n_rows") * F.lit(share)) & (F.col("dd_col5") > F.col("n_rows") * F.lit(share))
    return g.withColumn("swapped", swap)


def repair_shift(df: DataFrame, col2: str = "order_no", col5: str = "item_code",
                 file_col: str = "src_file", share: float = 0.5) -> DataFrame:
    """Swap columns 2 and 5 in every file the flags mark.  The flag table has
    one row per input file and is broadcast: rows are never shuffled by file.  With a
    ``layout`` column only the 7-value rows count and change, in one pass over
    the rows."""
    seven = F.col("layout") == 7 if "layout" in df.columns else F.lit(True)
    flags = shift_flags(df.where(seven), col2, col5, file_col, share).select(file_col, "swapped")
    j = df.join(F.broadcast(flags), file_col, "left")
    sw = F.coalesce(F.col("swapped"), F.lit(False)) & seven
    return j.withColumns({
        col2: F.when(sw, F.col(col5)).otherwise(F.col(col2)),
        col5: F.when(sw, F.col(col2)).otherwise(F.col(col5)),
    }).drop("swapped").select(*df.columns)
