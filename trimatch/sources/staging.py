"""Staged tables: parse once, reuse.  Tables live in the shared folder named
by ``spark.checkpoint.dir`` (never a machine-local path on a cluster)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from trimatch.session import checkpoint_dir
from trimatch.sources.files import exists


def stage_path(spark: SparkSession, name: str, base: str | None = None) -> str:
    return f"{(base or checkpoint_dir(spark)).rstrip('/')}/stage/{name}"


def stage(spark: SparkSession, name: str, builder: Callable[[], DataFrame],
          base: str | None = None, partition_by: Sequence[str] = (), refresh: bool = False) -> DataFrame:
    """Read the staged table ``name`` if it was written completely, else build,
    write (Parquet, optionally partitioned, e.g. by month) and read it back.
    ``name`` must say what the table was built from (see
    :func:`trimatch.sources.files.inputs_digest`).
    The read-back cuts the lineage, so later jobs never re-parse sources."""
    path = stage_path(spark, name, base)
    if refresh or not exists(spark, f"{path}/_SUCCESS"):
        w = builder().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return spark.read.parquet(path)


def by_period(df: DataFrame, date_col: str) -> DataFrame:
    """Add the ``period_year`` partition column (year of the business date).
    Rows are rebalanced by it: each year becomes a directory of few files, and
    AQE splits a year that is too large for one task."""
    from pyspark.sql import functions as F

    from trimatch.functions.dates import safe_timestamp

    ts = safe_timestamp(date_col, dtype=df.schema[date_col].dataType)
    return df.withColumn("period_year", F.year(ts)).hint("rebalance", "period_year")


def stage_many(spark: SparkSession, builders: dict[str, Callable[[], DataFrame]],
               base: str | None = None, refresh: bool = False, parallel: int = 4,
               partition_by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Stage several tables as concurrent jobs (the scheduler shares the
    executors between them); returns name -> staged reader."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(builders)))) as pool:
        futures = {name: pool.submit(stage, spark, name, build, base, partition_by, refresh)
                   for name, build in builders.items()}
        return {name: f.result() for name, f in futures.items()}


def read_back(spark: SparkSession, path: str, fmt: str = "parquet", null_value: str = "N/A", schema=None) -> DataFrame:
    """Read a written result for later analysis; the NULL marker of CSV
    reports becomes NULL again.  Without ``schema`` CSV columns are text."""
    if fmt == "csv":
        reader = spark.read.option("header", True).option("nullValue", null_value)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    return spark.read.parquet(path)
