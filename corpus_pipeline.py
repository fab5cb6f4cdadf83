"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.llm import chosen_path, decontaminate, packing, pii, quality
from trimatch.llm.common import staged, table, work_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# All stages: other columns than COLUMNS are dropped, whatever their names; an
# empty table gives an empty one; texts are read whole, however long.


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects.

    A null text is scored as an empty one.  Repeated rows and rows without an
    id have a score each; equal texts have equal scores, so they stay or go
    together; a score of exactly the threshold stays."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).filter(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five-word shingles,
    similarity of 0.8 or more): the one of the smallest id, rows without an id
    last.

    Rows are told apart by a number written with them, so of rows that repeat
    an id, or have none, one stays as well.  Null and empty texts are in no
    group and stay."""
    rows = staged(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row_no")), "numbered")
    found = chosen_path.near_duplicates(rows, shingle=5, percent=80, id_col="row_no")
    groups = found.select(F.col("doc_id").alias("row_no"), "component_id").join(rows.select("row_no", "doc_id"), "row_no")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no"))["row_no"]
    kept = groups.groupBy("component_id").agg(first.alias("row_no"))
    dropped = groups.join(kept, "row_no", "left_anti").select("row_no")
    return rows.join(dropped, "row_no", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item.

    A null or empty text holds none and stays; every row is judged by its own
    text, so repeated rows and rows without an id stay or go by it."""
    found = decontaminate.flag_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*COLUMNS)


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal values by pseudonyms and count the characters anew.

    A null text stays null, with a null count; every row stays, and equal texts
    of repeated rows get equal pseudonyms."""
    out = pii.pseudonymize(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences.

    A null or empty text is a piece of no tokens, a long one several pieces;
    rows that repeat an id, or have none, are packed each."""
    return packing.pack(packing.with_tokens(docs))


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("pii", hide_personal),
    ("pack", pack_sequences),
]

#: The stages learn a classifier and pack by search: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
