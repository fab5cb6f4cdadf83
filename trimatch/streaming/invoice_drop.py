"""Stage monthly invoice files as they land, incrementally.

The batch path reads the month files of a year in one go.  When extracts
arrive one month at a time, a file-source stream with ``availableNow`` picks
up only files it has not seen (tracked in the checkpoint), tags each row with
its file and place in it, and adds it to a staged Parquet table, one folder a
batch.  :func:`staged_invoices` reads that table for the reconciliation: rows
stand in the order of month, file and place in the file, however the batches
were cut; headers resolved.  Restarting after a failure resumes from the
checkpoint: a batch that was cut short is written over, nothing is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trimatch.operators.resolve import resolve_invoice_columns
from trimatch.plans.late_months import Match
from trimatch.session import checkpoint_dir


def stage_invoice_stream(spark: SparkSession, source_dir: str, schema: StructType | str,
                         staged_path: str, fmt: str = "csv", name: str = "invoice_drop",
                         checkpoint: str | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 12)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(source_dir)
    tagged = stream.withColumns({
        "src_file": F.col("_metadata.file_name"), "src_path": F.col("_metadata.file_path"), "src_block": F.col("_metadata.file_block_start"),
        "src_month": F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2})", 1)})
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def add(batch: DataFrame, number: int) -> None:
        placed = batch.withColumn("src_row", F.monotonically_increasing_id())       # a block is read by one task, in order
        placed.write.mode("overwrite").partitionBy("src_month").parquet(f"{staged_path}/src_batch={number}")

    return tagged.writeStream.foreachBatch(add).option("checkpointLocation", ckpt).trigger(availableNow=True).start()


def match_invoice_stream(spark: SparkSession, source_dir: str, schema: StructType | str, match: Match, fmt: str = "csv",
                         name: str = "invoice_match", checkpoint: str | None = None) -> StreamingQuery:
    """Add invoice files to a kept match as they land: only the keys of the new
    files are matched again.  The match must hold a first update with the
    orders and deliveries.  A batch is one update under its number, so a batch
    that is run again is counted once; "first" goes by arrival, then by path
    and place in the file."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 12)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(source_dir)
    tagged = stream.withColumns({"src_file": F.col("_metadata.file_name"), "__path": F.col("_metadata.file_path"),
                                 "__block": F.col("_metadata.file_block_start")})
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def add(batch: DataFrame, number: int) -> None:
        place = F.struct(F.lit(0).alias("file_no"), F.col("__path").alias("file"), F.col("__block").alias("block"),
                         F.monotonically_increasing_id().alias("row"))
        match.update(f"{name} {number}", invoices=resolve_invoice_columns(
            batch.withColumn("src_pos", place).drop("__path", "__block"), match.spec.name))

    return tagged.writeStream.foreachBatch(add).option("checkpointLocation", ckpt).trigger(availableNow=True).start()


def staged_invoices(spark: SparkSession, staged_path: str, profile: str = "OMS"):
    """The staged months as the invoice leg: earlier months come first."""
    df = spark.read.parquet(staged_path)
    place = F.struct(F.col("src_month").cast("string").alias("month"), F.col("src_path").alias("file"),
                     F.col("src_block").alias("block"), F.col("src_row").alias("row"))
    return resolve_invoice_columns(df.withColumn("src_pos", place).drop("src_month", "src_path", "src_block", "src_row", "src_batch"), profile)
