"""Monthly invoice extracts: read each month, tag the file, union by name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.sources.files import exists, position


def align_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def monthly_paths(spark: SparkSession, directory: str, year: int, months: Iterable[int] = range(1, 13),
                  exts: Sequence[str] = ("csv", "CSV", "parquet")) -> list[str]:
    """``<dir>/<year>-<MM>.<ext>`` for each month that exists (first ext wins),
    on any storage Spark reads."""
    out = []
    for m in months:
        names = (f"{directory.rstrip('/')}/{year}-{m:02d}.{ext}" for ext in exts)
        out += [p for p in names if exists(spark, p)][:1]
    return out


def read_invoice_file(spark: SparkSession, path: str, fmt: str | None = None, ordinal: int = 0,
                      charset: str = "UTF-8") -> DataFrame:
    """One extract, every column as text (CSV), with the source file name and
    the row's position: the file's ordinal first, then the place in it."""
    fmt = fmt or ("parquet" if path.lower().endswith(".parquet") else "csv")
    if fmt == "csv":
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", charset).csv(path))
    else:
        df = spark.read.parquet(path)
    if not df.columns:
        raise ValueError(f"{path}: no header")
    return (df.withColumn("src_file", F.col("_metadata.file_name"))
            .withColumn("src_pos", position(spark, [path]).withField("file_no", F.lit(ordinal))))


def read_monthly_invoices(spark: SparkSession, paths: Sequence[str], fmt: str | None = None,
                          charset: str = "UTF-8", skipped: list[tuple[str, str]] | None = None) -> DataFrame:
    """Union of the monthly extracts in the order given.  An unreadable one is
    an error, unless the caller gives a ``skipped`` list to note it in; having
    none at all is always an error."""
    frames = []
    for i, p in enumerate(paths):
        try:
            frames.append(read_invoice_file(spark, p, fmt, i, charset))
        except (AnalysisException, OSError, ValueError) as e:
            if skipped is None:
                raise ValueError(f"{p}: can't be read: {e}") from e
            skipped.append((p, str(e).splitlines()[0]))
    if not frames:
        raise ValueError("no invoice extract could be read")
    return align_union(frames)
