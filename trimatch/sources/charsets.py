"""Lines of text files in any charset, cut by Spark's own splits.

The text source cuts a file at the bytes of a line end and hands over the
bytes between; they are decoded afterwards, by built-in functions.  Bytes that
the charset does not know are dropped, the rest of their line stays.  (They
are decoded to U+FFFD first, so that a U+FFFD written in such a text goes too.)

UTF-16 and UTF-32 need more care: the bytes of a line end also occur across
two characters (U+0A05 U+4E00, little endian).  A cut is false exactly where
the bytes before it in the file do not add up to whole code units, so the
lengths of the pieces tell which ones belong together.  Sums are taken per
split and then over the splits of a file; pieces that are whole are passed
through as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trimatch.operators.numbering import written
from trimatch.sources.files import data_files, file_path, first_bytes, position

BAD = "�"
#: Byte order marks, longest first, as the charset they tell.
MARKS = ((b"\xff\xfe\x00\x00", "UTF-32LE"), (b"\x00\x00\xfe\xff", "UTF-32BE"), (b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE"))


def canonical(charset: str) -> str:
    """``UTF-16``, ``utf_16_le``, ``UTF16-LE`` ... in one spelling."""
    c = charset.upper().replace("_", "-")
    for family in ("UTF-8", "UTF-16", "UTF-32"):
        if c.startswith((family, family.replace("-", ""))):
            return family + c.removeprefix(family).removeprefix(family.replace("-", "")).replace("-", "")
    return c


def valid_utf8(line: Column) -> Column:
    """The line without the bytes that are no UTF-8."""
    return F.when(F.is_valid_utf8(line), line).otherwise(F.replace(F.make_valid_utf8(line), F.lit(BAD), F.lit("")))


def _without_lone_surrogates(data: Column, charset: str) -> Column:
    """UTF-16 bytes less the halves of a pair that stand alone (unit by unit)."""
    high, low, other = ((r"..D[89AB]", r"..D[C-F]", r"..[0-9A-CEF].|..D[0-7]") if charset.endswith("LE")
                        else (r"D[89AB]..", r"D[C-F]..", r"[0-9A-CEF]...|D[0-7].."))
    return F.unhex(F.regexp_replace(F.hex(data), rf"\G({high}{low}|{other})|\G(?:{high}|{low})", "$1"))


def decoded(df: DataFrame, col: str, charset: str) -> DataFrame:
    """``df`` with the bytes of ``col`` read in ``charset`` (any that Java
    knows), bad ones dropped.  What to do with bad bytes is fixed in the
    expression when it is analysed, so the session's settings come back at once."""
    spark, data = df.sparkSession, F.col(col).cast("binary")
    if charset in ("UTF-32LE", "UTF-32BE"):
        mark = next(m for m, c in MARKS if c == charset)
        data, charset = F.concat(F.lit(mark), data), "UTF-32"
    flags = ("spark.sql.legacy.codingErrorAction", "spark.sql.legacy.javaCharsets")
    before = {f: spark.conf.get(f, None) for f in flags}
    try:
        for f in flags:
            spark.conf.set(f, "true")
        text = F.decode(data, charset)
        if charset.startswith("UTF-16"):        # else the unit after a lone half would go too
            text = F.when(F.contains(text, F.lit(BAD)), F.decode(_without_lone_surrogates(data, charset), charset)).otherwise(text)
        out = df.withColumn(col, text)
    finally:
        for f, value in before.items():
            spark.conf.unset(f) if value is None else spark.conf.set(f, value)
    return out.withColumn(col, F.replace(F.col(col), F.lit(BAD), F.lit("")))


def _pieces(spark: SparkSession, files: Sequence[str], paths: Sequence[str], charset: str) -> DataFrame:
    raw = spark.read.option("encoding", charset).option("lineSep", "\n").text(list(files))
    return raw.select(file_path().alias("src_file"), position(spark, paths).alias("src_pos"), F.col("value").cast("binary").alias("line"))


def whole_lines(pieces: DataFrame, charset: str, unit: int) -> DataFrame:
    """Pieces put together again where a file was cut inside a code unit.

    A pass over the lengths gives the sums of the splits.  Only the pieces that
    are not whole, and those between them inside a code unit, go through a
    shuffle, by split; all others are passed through as they are read."""
    rest, row = F.length("line") % unit, F.col("src_pos.row")
    blocks = written(pieces.groupBy("src_file", F.col("src_pos.block").alias("block")).agg(
        F.max(rest).alias("r"), (F.sum(rest) % unit).alias("sum"), F.min(row).alias("lo"), F.max(row).alias("hi")), "blocks")
    if blocks.where("r > 0").isEmpty():
        return pieces
    earlier = Window.partitionBy("src_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0)) % unit)
    cut = written(pieces.where(rest > 0).select("*", F.col("src_pos.block").alias("block"), row.alias("row"), rest.alias("rest")), "pieces")
    here = Window.partitionBy("src_file", "block").orderBy("row")
    after = (F.col("before") + F.sum("rest").over(here)) % unit
    marks = cut.select("src_file", "block", "row", "rest").join(F.broadcast(blocks), ["src_file", "block"]).select(
        "src_file", "block", "row", after.alias("after"), (F.pmod(after - F.col("rest"), F.lit(unit)) == 0).alias("whole"),
        F.coalesce(F.lead("row").over(here) - 1, "hi").alias("upto"), F.lag("row").over(here).isNull().alias("first"))
    marks = written(marks, "marks")
    # rows inside a code unit that are no marks: after a mark, or before the first one of a split
    heads = marks.where("first").select("src_file", "block", (F.col("row") - 1).alias("upto"))
    starts = blocks.where("before > 0").join(heads, ["src_file", "block"], "left").select(
        "src_file", (F.col("lo") - 1).alias("row"), F.coalesce("upto", "hi").alias("upto"))
    gaps = marks.where("after > 0").select("src_file", "row", "upto").unionByName(starts).where("upto > row")
    cut = cut.join(marks.select("src_file", "row", "whole"), ["src_file", "row"]).select(
        "src_file", "src_pos", "line", "block", F.when(F.col("whole"), F.col("src_pos")).alias("head"))
    kept = pieces.where(rest == 0)
    if not gaps.isEmpty():
        inside = written(gaps.select("src_file", F.explode(F.sequence(F.col("row") + 1, F.col("upto"))).alias("row")), "inside")
        kept = kept.withColumn("row", row)
        between = kept.join(inside, ["src_file", "row"]).select(
            "src_file", "src_pos", "line", F.col("src_pos.block").alias("block"), F.lit(None).cast(cut.schema["head"].dataType).alias("head"))
        kept = kept.join(inside, ["src_file", "row"], "left_anti").select(*pieces.columns)
        cut = cut.unionByName(between)
    # a piece goes on the last one that began at a whole unit, in its split or before it
    last = cut.groupBy("src_file", "block").agg(F.max("head").alias("h"))
    last = last.select("src_file", "block", F.max("h").over(earlier).alias("carried"))
    upto = Window.partitionBy("src_file", "block").orderBy("src_pos").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("head", F.max("head").over(upto)).join(F.broadcast(last), ["src_file", "block"])
    end = F.lit("\n".encode(charset))
    joined = cut.groupBy("src_file", F.coalesce("head", "carried").alias("head")).agg(F.sort_array(F.collect_list(F.struct("src_pos", "line"))).alias("x")).select(
        "src_file", F.col("head").alias("src_pos"),
        F.aggregate(F.slice("x", 2, F.size("x")), F.element_at("x", 1)["line"], lambda a, p: F.concat(a, end, p["line"])).alias("line"))
    return kept.unionByName(joined)


def wide_lines(spark: SparkSession, paths: Sequence[str], charset: str) -> DataFrame:
    """``(src_file, src_pos, line)`` of UTF-16 or UTF-32 files.  Without an
    order of bytes in the charset's name a file's mark gives it, and little
    endian holds for files without one."""
    family, unit = charset[:6], 2 if charset.startswith("UTF-16") else 4
    kinds: dict[str, list[str]] = {}
    for file in data_files(spark, paths):
        kind = charset
        if charset == family:
            start = first_bytes(spark, file, 4)
            kind = next((c for m, c in MARKS if start.startswith(m) and c.startswith(family)), family + "LE")
        kinds.setdefault(kind, []).append(file)
    if not kinds:
        raise ValueError(f"no file under {list(paths)}")
    frames = [decoded(whole_lines(_pieces(spark, files, paths, kind), kind, unit), "line", kind) for kind, files in kinds.items()]
    lines = reduce(DataFrame.unionByName, frames)
    return lines.withColumn("line", F.regexp_replace("line", "^﻿|\r\\z", ""))


def narrow_lines(spark: SparkSession, paths: Sequence[str], charset: str) -> DataFrame:
    """The same of files whose line ends are single bytes (UTF-8, Latin-1, GBK ...)."""
    lines = spark.read.text(list(paths)).select(file_path().alias("src_file"), position(spark, paths).alias("src_pos"), F.col("value").alias("line"))
    return lines.withColumn("line", valid_utf8(F.col("line"))) if charset == "UTF-8" else decoded(lines, "line", charset)
