"""Text dates in spellings found in the data.

A file writes a column in one way, but which way shows only over many values:
``03/04/2025`` is read by what the other values of its file say.  One aggregate
counts, for each file and column, the values whose first or second number
can't be a month; the file's way is chosen from the counts and every value is
parsed once.  :func:`date_shapes` lists the spellings met and what stays
unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME = r"(?:[ T]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?))?$"
YEAR_FIRST = r"^(?!0000)(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})日?" + TIME
COMPACT = r"^(?!0000)(\d{4})(\d{2})(\d{2})$"
COMPACT_TIME = r"^(?!0000)(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$"
YEAR_LAST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](?!0000)(\d{4})" + TIME


def _text(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def date_shape(text: Column) -> Column:
    """The spelling of a value: digits as 9, words as A."""
    return F.regexp_replace(F.translate(F.trim(text), "0123456789", "9" * 10), r"[A-Za-z]+", "A")


def _number(c: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(_text(c), YEAR_LAST, group), F.lit("")).cast("int")


def day_first_votes(df: DataFrame, cols: Sequence[str], by: str = "src_file") -> DataFrame:
    """Per file: for each column whether its year-last dates name the day
    first, i.e. more first than second numbers are over 12.  Without evidence
    the month is first."""
    aggs = [(F.count_if(_number(c, 1) > 12) > F.count_if(_number(c, 2) > 12)).alias(f"__df{i}") for i, c in enumerate(cols)]
    return df.groupBy(F.col(by).alias("__by")).agg(*aggs)


def read_date(text: Column, day_first: Column) -> Column:
    """Timestamp of a text, NULL where it is no date."""
    iso = (F.when(text.rlike(YEAR_FIRST), F.regexp_replace(text, YEAR_FIRST, "$1-$2-$3 $4"))
           .when(text.rlike(COMPACT), F.regexp_replace(text, COMPACT, "$1-$2-$3"))
           .when(text.rlike(COMPACT_TIME), F.regexp_replace(text, COMPACT_TIME, "$1-$2-$3 $4:$5:$6"))
           .when(text.rlike(YEAR_LAST), F.when(day_first, F.regexp_replace(text, YEAR_LAST, "$3-$2-$1 $4"))
                 .otherwise(F.regexp_replace(text, YEAR_LAST, "$3-$1-$2 $4"))))
    return F.trim(iso).try_cast("timestamp")


def parse_dates(df: DataFrame, cols: Sequence[str], by: str = "src_file") -> DataFrame:
    """``df`` with the text columns ``cols`` as timestamps, each file read in
    its own way; columns of other types stay.  Rows without a file (NULL) are
    one file."""
    kinds = dict(df.dtypes)
    cols = [c for c in cols if kinds.get(c) == "string"]
    if not cols:
        return df
    rows = df.join(day_first_votes(df, cols, by), F.col(by).eqNullSafe(F.col("__by")))
    return rows.withColumns({c: read_date(_text(c), F.col(f"__df{i}")) for i, c in enumerate(cols)}).select(df.columns)


def date_shapes(df: DataFrame, cols: Sequence[str], by: str = "src_file") -> DataFrame:
    """``(<by>, column, shape, n_rows, unread)``: spellings of every file and
    column with their rows, and those of them that are no date."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("text"), F.col(f"__df{i}").alias("day_first")) for i, c in enumerate(cols)])
    rows = df.join(day_first_votes(df, cols, by), F.col(by).eqNullSafe(F.col("__by"))).select(by, F.explode(pairs).alias("v")).where(F.col("v.text").isNotNull())
    return rows.groupBy(by, "v.column", date_shape(F.col("v.text")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(read_date(F.col("v.text"), F.col("v.day_first")).isNull()).alias("unread"))
