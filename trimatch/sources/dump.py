"""SQL ``INSERT ... VALUES`` dump ingestion as a Spark job.

A dump is text: one ``VALUES (...)`` tuple per line.  Lines are read as a
text table (split across tasks like any file), tokenised with built-in
regular-expression functions, and aligned to a column layout.  Tokenising
rule, per line:

* only lines whose stripped text starts with ``VALUES`` (any case) count;
* the body is the text between the first ``(`` and the last ``)`` after
  stripping whitespace and ``;``; an empty body yields nothing;
* the body splits on commas outside single quotes; blank tokens drop;
* unquoted ``NULL`` (any case) is NULL; one pair of outer quotes is removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.operators.numbering import written
from trimatch.operators.repair import DD_PREFIX, DIGITS
from trimatch.sources.charsets import canonical, narrow_lines, wide_lines

# A token: runs of quoted segments (an unterminated quote runs to the end), of
# characters that are neither quote nor comma nor blank, and of blanks inside it.
TOKEN = r"(?!\s)(?:'[^']*+(?:'|\z)|[^',\s]++|\s++(?!,|\z))++"
WS_EDGES = r"^\s+|\s+$"

# Column layouts of the extracts.
ORDER_COLS_11 = ("platform_order_no", "main_order_no", "sale_order_no", "order_type", "order_status",
                 "create_time", "update_time", "channel_name", "item_code", "pay_amount", "item_num")
ORDER_COLS_13 = ("platform_order_no", "main_order_no", "sale_order_no", "order_type", "order_status",
                 "create_time", "update_time", "channel_name", "item_code", "line_amount",
                 "pay_amount", "item_num", "channel_name2")
ORDER_COLS_HEADERLESS = ORDER_COLS_13[:12] + ("organization_code",)
DELIVERY_COLS_7 = ("business_type", "order_no", "external_order_no", "biz_time", "item_code",
                   "item_name", "shipped_qty")
DELIVERY_COLS_8 = ("business_type", "main_no", "order_no", "external_order_no", "biz_time",
                   "item_code", "item_name", "shipped_qty")


def read_lines(spark: SparkSession, path: str | Sequence[str], charset: str = "UTF-8") -> DataFrame:
    """``(src_file, src_pos, line)`` for every line of the dump files, in any
    charset, split across tasks; bytes that the charset does not know are
    dropped (:mod:`trimatch.sources.charsets`).

    ``src_file`` is the full path; ``src_pos`` orders rows by the given list of
    paths, then by place in the file (:mod:`trimatch.sources.files`)."""
    paths = [path] if isinstance(path, str) else list(path)
    name = canonical(charset)
    return wide_lines(spark, paths, name) if name.startswith(("UTF-16", "UTF-32")) else narrow_lines(spark, paths, name)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, WS_EDGES, "")


# VALUES in any case, then everything from the first bracket to the last one,
# without the blanks at its end; nothing if that is all blank.
VALUES_LINE = r"(?is)^\s*VALUES[^(]*\((.*\S)\s*\)[^)]*\z"


def raw_tokens(line: Column) -> Column:
    """Array of tokens of a VALUES line as they stand, quotes included (NULL
    when the line is not one)."""
    body = F.nullif(F.regexp_extract(line, VALUES_LINE, 1), F.lit(""))
    return F.regexp_extract_all(body, F.lit(TOKEN), 0)


def token_value(t: Column) -> Column:
    """What a token says: NULL in any case is none, one pair of outer quotes goes."""
    null = (F.length(t) == 4) & (F.upper(t) == "NULL")
    inner = F.substring(t, 2, F.greatest(F.length(t) - 2, F.lit(0)))
    return F.when(~null, F.when(t.startswith("'") & t.endswith("'"), inner).otherwise(t))


def tokens(line: Column) -> Column:
    """Array of values of a VALUES line (NULL when the line is not one)."""
    return F.transform(raw_tokens(line), token_value)


def parse_dump(lines: DataFrame) -> DataFrame:
    """``(src_file, src_pos, vals)`` for every VALUES line.  The explode (of
    one array or none) keeps the tokeniser in one place: the optimizer would
    copy a plain expression into every column read from it."""
    found = F.filter(F.array(tokens(F.col("line"))), lambda v: v.isNotNull())
    return lines.select("src_file", "src_pos", F.explode(found).alias("vals"))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``(src_file, src_pos, vals, n_values, head)`` of every line: the values
    of a VALUES line and their number, else the column list of an INSERT INTO
    line.  The explode (of one array) keeps the tokeniser in one place."""
    cut = lines.select("src_file", "src_pos", "line", F.explode(F.array(raw_tokens(F.col("line")))).alias("raw"))
    return cut.select("src_file", "src_pos", F.transform("raw", token_value).alias("vals"), F.size("raw").alias("n_values"),
                      F.when(F.col("raw").isNull(), _header(F.col("line"))).alias("head"))


def stage_parse(lines: DataFrame, name: str = "dump") -> DataFrame:
    """:func:`parsed_lines`, written: lines are tokenised once, and layouts,
    headers, the shift of a file, short rows and the rows themselves all read
    this copy."""
    return written(parsed_lines(lines), f"{name}-values", "zstd")


def _staged(rows: DataFrame) -> bool:
    return "n_values" in rows.columns


def _count(rows: DataFrame) -> Column:
    return F.col("n_values") if _staged(rows) else F.size("vals")


def _values_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("vals").isNotNull()) if _staged(rows) else rows


def file_profile(parsed: DataFrame) -> DataFrame:
    """One row a file: ``n_rows``, rows by width (``late`` 13 or more values,
    ``early`` 11 or 12, ``eight`` 8 or more, ``seven``, ``short`` fewer), and of
    the 7-value rows those with digits in column 2 and a ``DD`` number in column
    5.  Partial counts merge, so a file may be split over any tasks."""
    rows = _values_rows(parsed)
    n, seven = _count(rows), _count(rows) == 7
    return rows.groupBy("src_file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(n >= 13).alias("late"), F.count_if((n >= 11) & (n < 13)).alias("early"),
        F.count_if(n >= 8).alias("eight"), F.count_if(seven).alias("seven"), F.count_if(n < 7).alias("short"),
        F.count_if(seven & F.get("vals", 1).rlike(DIGITS)).alias("digits_col2"),
        F.count_if(seven & F.get("vals", 4).rlike(DD_PREFIX)).alias("dd_col5"))


def file_layouts(parsed: DataFrame) -> DataFrame:
    """Per file, its order layout: 13 when at least as many rows have 13 or
    more values as have 11 or 12, else 11."""
    return file_profile(parsed).select("src_file", F.when(F.col("late") >= F.col("early"), 13).otherwise(11).alias("layout"))


def shifted_files(parsed: DataFrame, share: float = 0.5) -> DataFrame:
    """Per file, whether columns 2 and 5 of its 7-value rows changed places."""
    need = F.col("seven") * F.lit(share)
    return file_profile(parsed).select("src_file", ((F.col("digits_col2") > need) & (F.col("dd_col5") > need)).alias("swapped"))


def with_layout(parsed: DataFrame, layout: int | None = None) -> DataFrame:
    """Rows with their file's layout: given, or found by :func:`file_layouts`."""
    rows = _values_rows(parsed)
    if layout is not None:
        return rows.withColumn("layout", F.lit(layout))
    return rows.join(F.broadcast(file_layouts(parsed)), "src_file")     # one row a file: no shuffle by file


def order_rows(parsed: DataFrame, layout: int | None = None) -> DataFrame:
    """Orders in the 13-column shape, by each file's layout.  An 11-column file
    gets NULL ``line_amount`` and ``channel_name2``; long rows are cut; short
    rows are left to :func:`rejected_rows`."""
    late = F.col("layout") == 13
    cols = []
    for i, name in enumerate(ORDER_COLS_13):
        at = F.when(late, i)                    # NULL, and so is the value, where an early file lacks the column
        if name in ORDER_COLS_11:
            at = at.otherwise(ORDER_COLS_11.index(name))
        cols.append(F.get("vals", at).alias(name))
    return with_layout(parsed, layout).where(_count(parsed) >= F.col("layout")).select(*cols, "src_file", "src_pos")


def rejected_rows(parsed: DataFrame, leg: str) -> DataFrame:
    """``(leg, src_file, src_pos, n_values, reason)`` of the VALUES rows that
    are too short for their layout."""
    need = F.col("layout") if leg == "orders" else F.lit(7)
    rows = with_layout(parsed) if leg == "orders" else _values_rows(parsed)
    n = _count(parsed)
    return rows.where(n < need).select(
        F.lit(leg).alias("leg"), "src_file", "src_pos", n.alias("n_values"),
        F.format_string("fewer than %d values", need.cast("int")).alias("reason"))


def delivery_rows(parsed: DataFrame) -> DataFrame:
    """Deliveries: 8 or more values -> 8-column layout (with ``main_no``),
    exactly 7 -> 7-column layout, fewer -> dropped.  Decided per row, so a
    file mixing both layouts is read correctly."""
    eight = _count(parsed) >= 8
    cols = []
    for i, name in enumerate(DELIVERY_COLS_8):
        at = F.when(eight, i)
        if name in DELIVERY_COLS_7:
            at = at.otherwise(DELIVERY_COLS_7.index(name))
        cols.append(F.get("vals", at).alias(name))
    return _values_rows(parsed).where(_count(parsed) >= 7).select(
        *cols, F.when(eight, 8).otherwise(7).alias("layout"), "src_file", "src_pos")


def repaired_delivery_rows(parsed: DataFrame, share: float = 0.5) -> DataFrame:
    """:func:`delivery_rows` of a staged parse, columns 2 and 5 of 7-value rows
    put right in every file that :func:`shifted_files` marks."""
    rows = delivery_rows(parsed)
    swap = F.col("swapped") & (F.col("layout") == 7)
    return rows.join(F.broadcast(shifted_files(parsed, share)), "src_file").withColumns({
        "order_no": F.when(swap, F.col("item_code")).otherwise(F.col("order_no")),
        "item_code": F.when(swap, F.col("order_no")).otherwise(F.col("item_code"))}).select(rows.columns)


def _header(line: Column) -> Column:
    """Column list of an ``INSERT INTO t (a, b, ...)`` line, else NULL."""
    start, end = F.instr(line, "("), F.instr(line, ")")
    inner = F.substring(line, start + 1, end - start - 1)
    ok = F.upper(line).contains("INSERT INTO") & (start > 1) & (end > start)
    return F.when(ok, F.transform(F.split(inner, ","), lambda c: _strip(c)))


def header_columns(lines: DataFrame) -> DataFrame:
    """Per file, the column list of an ``INSERT INTO t (a, b, ...)`` first
    line; NULL when the first line is not such a header."""
    head = F.col("head") if _staged(lines) else _header(F.col("line"))
    first = lines.select("src_file", "src_pos", F.struct(head.alias("columns")).alias("h")).groupBy("src_file").agg(F.min_by("h", "src_pos").alias("h"))
    return first.select("src_file", "h.columns")


def rows_with_header(spark: SparkSession, lines: DataFrame, default: Sequence[str],
                     pad_from: int | None = None) -> DataFrame:
    """Rows named by each file's own header line (else ``default``), in one
    pass however many headers there are; columns that a file lacks are NULL.

    The names of all headers are collected (metadata, a few lists).  Each file
    then meets two short arrays by a join: the place of every name among its
    values, and the place in a row of exactly ``pad_from`` values.  With
    ``pad_from`` (11, orders), a row shorter than its header is kept from that
    many values on: exactly ``pad_from`` values lack the tenth and the last
    column, others lack what is missing at the end.

    ``lines`` are lines or a staged parse of them (:func:`stage_parse`)."""
    parsed = lines if _staged(lines) else stage_parse(lines)
    heads = header_columns(parsed).select("src_file", F.coalesce("columns", F.array(*[F.lit(c) for c in default])).alias("columns"))
    found = [tuple(r["columns"]) for r in heads.select("columns").distinct().orderBy("columns").collect()]
    names = list(dict.fromkeys(n for columns in found for n in columns)) or list(default)

    def places(short: bool) -> Column:
        """Per header, the place of every name (-1: none)."""
        out = F.lit(None).cast("array<int>")
        for columns in found:
            at = {c: i for i, c in reversed(list(enumerate(columns)))}
            if short and len(columns) > pad_from:
                at = {c: i if i < 9 else i - 1 for c, i in at.items() if i != 9 and i <= pad_from}
            out = F.when(F.col("columns") == F.array(*map(F.lit, columns)), F.array(*[F.lit(at.get(n, -1)) for n in names])).otherwise(out)
        return out

    width = F.size("columns")
    need = width if pad_from is None else F.when(width > pad_from, pad_from).otherwise(width)
    heads = heads.select("src_file", need.alias("__need"), places(False).alias("__at"),
                         (places(True) if pad_from is not None else F.lit(None).cast("array<int>")).alias("__short"))
    rows = _values_rows(parsed).join(F.broadcast(heads), "src_file").where(F.col("n_values") >= F.col("__need"))
    at = F.col("__at") if pad_from is None else F.when(F.col("n_values") == pad_from, F.col("__short")).otherwise(F.col("__at"))
    place = rows.withColumn("__at", at)
    return place.select(*[F.get("vals", F.get("__at", i)).alias(n) for i, n in enumerate(names)],
                        "src_file", "src_pos")
