"""Row numbers in a total order, without a task that sees all rows.

The rows are dealt into ranges of the order and sorted inside each; a range
counts its rows, and prefix sums over the ranges (one row a range and group)
turn places inside a range into numbers.  Rows that the order does not tell
apart are told apart by where a written copy holds them, so a value that fills
a third of the table is cut into ranges like any other.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trimatch.session import checkpoint_dir


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs see the
    same rows in the same files, whichever executor is lost.  ``codec`` is for
    copies of whole inputs; without it the session's holds."""
    path = work_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _name(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def number_rows(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), out: str = "row_no",
                unique: bool = False, partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... by ``order`` inside each ``group``
    (all rows without one), on written rows.

    ``unique`` says that group and order tell all rows apart, which saves a
    written copy; otherwise equal rows are numbered by their place in it.
    Nulls come first in ascending order and form a group of their own; an empty
    table stays empty.  Internal names give way to clashing columns."""
    spark = df.sparkSession
    tag = "__no"
    while any(c.startswith(tag) for c in df.columns):
        tag += "_"
    cols, tie = df.columns, []
    if not unique:
        df = written(df, "rows").withColumns({f"{tag}f": F.col("_metadata.file_name"), f"{tag}i": F.col("_metadata.row_index")})
        tie = [F.col(f"{tag}f"), F.col(f"{tag}i")]
    keys = [*[F.col(g) for g in group], *[_name(c) for c in order], *tie]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select(*cols, F.monotonically_increasing_id().alias(f"{tag}id"))
    ranges = written(ranges.withColumn(f"{tag}p", F.shiftright(f"{tag}id", 33)), "ranges")
    runs = ranges.groupBy(*group, f"{tag}p").agg(F.min(f"{tag}id").alias(f"{tag}a"), F.count(F.lit(1)).alias(f"{tag}n"))
    before = F.sum(f"{tag}n").over(Window.partitionBy(*group).orderBy(f"{tag}p").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(f"{tag}p").alias(f"{tag}q"), (F.coalesce(before, F.lit(0)) - F.col(f"{tag}a")).alias(f"{tag}d"),
                       *[F.col(g).alias(f"{tag}g{i}") for i, g in enumerate(group)])
    same = F.col(f"{tag}p") == F.col(f"{tag}q")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"{tag}g{i}"))
    return ranges.join(runs, same).select(*cols, (F.col(f"{tag}id") + F.col(f"{tag}d")).alias(out))
