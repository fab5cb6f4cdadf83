"""Allocation of DMS invoice lines over the orders they may belong to.

Where a DMS number and item stand on several sale orders, the cross-reference
alone can't say which order an invoice line is for.  Here the lines of a key
are laid end to end in source order, the orders' quantities beside them (by
first position), and each line goes to the orders it lies next to, in pieces.
What reaches beyond the ordered quantity is reported, never lost: quantities
and amounts of the pieces add up to the lines.

Both sides become points on one scale, and a piece is what lies between two
neighbouring points.  Totals and "last seen" values run over sorted ranges, so
a key that holds a large part of all rows is spread over many tasks, and no
join pairs the lines of a key with its orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trimatch.functions.codes import norm_code
from trimatch.functions.numbers import safe_number
from trimatch.operators.numbering import written

UNITS = 1_000_000        # quantities are counted in millionths, amounts in cents, both exact


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, str] = {}, lasts: Mapping[str, str] = {}) -> DataFrame:
    """``df`` with, for each row, the sum (``sums``: name -> column) and the
    last value that is not null (``lasts``) over the rows before it in its
    group; group columns hold no nulls.  Rows that ``order`` does not tell apart
    come in any order.

    Rows are dealt into sorted ranges and written; a range and group give one
    row of totals, whose own running values go back to the rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order).withColumn("__id", F.monotonically_increasing_id())
    ranges = written(ranges.withColumn("__range", F.shiftright("__id", 33)), "running")

    def earlier(w):
        return w.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy(*group, "__range").agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(f"__sum_{o}") for o, c in sums.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__id"))).alias(f"__last_{o}") for o, c in lasts.items()])
    over = earlier(Window.partitionBy(*group).orderBy("__range"))
    totals = totals.select(*group, "__range", *[F.coalesce(F.sum(f"__sum_{o}").over(over), F.lit(0)).alias(f"__sum_{o}") for o in sums],
                           *[F.last(f"__last_{o}", ignorenulls=True).over(over).alias(f"__last_{o}") for o in lasts])
    here = earlier(Window.partitionBy(*group, "__range").orderBy("__id"))
    inside = ranges.withColumns({f"__in_{o}": F.coalesce(F.sum(c).over(here), F.lit(0)) for o, c in sums.items()}
                                | {f"__in_{o}": F.last(c, ignorenulls=True).over(here) for o, c in lasts.items()})
    return inside.join(totals, [*group, "__range"]).select(
        *df.columns, *[(F.col(f"__in_{o}") + F.col(f"__sum_{o}")).alias(o) for o in sums],
        *[F.coalesce(f"__in_{o}", f"__last_{o}").alias(o) for o in lasts])


def _units(col: str, df: DataFrame, scale: int) -> Column:
    return F.round(safe_number(col, dtype=df.schema[col].dataType) * scale).cast("long")


def allocate(to_map: DataFrame, orders: DataFrame, normalize: bool = True) -> DataFrame:
    """Pieces of the invoice rows ``to_map`` (those with a DMS number only):
    ``dms_order_no, item_code, invoice_no, src_pos, oms_order_no, status, qty,
    amount``.

    ``status`` is ``allocated``; ``over`` (beyond what the orders hold),
    ``unmapped`` (no order has the key), ``no quantity`` (nothing to lay out),
    ``no DMS number`` or ``no item code``, all without an order number.  Returns
    (negative quantities) are laid out by themselves, against the same orders.
    Rows of one place follow by invoice number, quantity and amount.  A line's
    cents are shared by cumulated quantity, so they add up.  Orders without a
    positive quantity take nothing; empty inputs give empty results."""
    def item(df: DataFrame) -> Column:
        return norm_code("item_code", df.schema["item_code"].dataType) if normalize else F.col("item_code")
    key = ["ext", "item", "sign"]
    invoice_no = F.col("invoice_no") if "invoice_no" in to_map.columns else F.lit(None).cast("string")
    lines = to_map.select(F.col("dms_order_no").alias("ext"), item(to_map).alias("item"), "item_code", invoice_no.alias("invoice_no"), "src_pos",
                          _units("qty", to_map, UNITS).alias("q"), _units("amount", to_map, 100).alias("cents"))
    lines = lines.withColumn("sign", F.signum(F.coalesce("q", F.lit(0))).cast("int")).withColumn("q", F.abs(F.coalesce("q", F.lit(0))))
    laid = F.col("ext").isNotNull() & F.col("item").isNotNull() & (F.col("sign") != 0)
    aside = lines.where(~laid)
    lines = running(lines.where(laid), key, ["src_pos", "invoice_no", "q", "cents", "item_code"], {"lo": "q"})

    ordered = orders.where(F.col("external_order_no").isNotNull() & F.col("sale_order_no").isNotNull()).select(
        F.col("external_order_no").alias("ext"), item(orders).alias("item"), F.col("sale_order_no").alias("sale"),
        F.col("src_pos").alias("pos"), _units("item_num", orders, UNITS).alias("r")).where(F.col("item").isNotNull())
    ordered = ordered.groupBy("ext", "item", "sale").agg(F.sum("r").alias("r"), F.min("pos").alias("pos")).where("r > 0")
    ordered = running(ordered, ["ext", "item"], ["pos", "sale"], {"lo": "r"})
    ordered = ordered.withColumn("sign", F.explode(F.array(F.lit(1), F.lit(-1))))

    line = F.struct("item_code", "invoice_no", "src_pos", "q", "cents", "lo")
    held = F.struct("sale")
    no_line, no_order = F.lit(None).cast(lines.select(line.alias("x")).schema["x"].dataType), F.lit(None).cast("struct<sale:string>")

    def points(df: DataFrame, at: Column, kind: int, order: Column, invoice: Column, open_line: Column) -> DataFrame:
        return df.select(*key, at.alias("at"), F.lit(kind).alias("kind"), order.alias("order"), invoice.alias("line"), open_line.alias("open"))
    begin, none = F.lit(True), F.lit(None).cast("boolean")
    ends_o = ordered.groupBy(*key).agg(F.max(F.col("lo") + F.col("r")).alias("end"))
    ends_l = lines.groupBy(*key).agg(F.max(F.col("lo") + F.col("q")).alias("end"))
    marks = (points(ordered, F.col("lo"), 1, held, no_line, none)
             .unionByName(points(ends_o, F.col("end"), 0, F.struct(F.lit(None).cast("string").alias("sale")), no_line, none))
             .unionByName(points(lines, F.col("lo"), 3, no_order, line, begin))
             .unionByName(points(ends_l, F.col("end"), 2, no_order, no_line, F.lit(False))))
    marks = running(marks, key, ["at", "kind"], lasts={"from": "at", "on": "order", "of": "line", "going": "open"})
    cut = marks.where(F.col("going") & (F.col("at") > F.col("from")))

    def share(upto: Column) -> Column:
        part = (F.col("of.cents").cast("decimal(19,0)") * (upto - F.col("of.lo")).cast("decimal(19,0)"))
        return F.call_function("div", part, F.col("of.q").cast("decimal(19,0)"))
    status = F.when(F.col("on").isNull(), "unmapped").when(F.col("on.sale").isNull(), "over").otherwise("allocated")
    pieces = cut.select(F.col("ext").alias("dms_order_no"), "of.item_code", "of.invoice_no", "of.src_pos", F.col("on.sale").alias("oms_order_no"),
                        status.alias("status"), (F.col("sign") * (F.col("at") - F.col("from"))).alias("q"), (share(F.col("at")) - share(F.col("from"))).alias("cents"))
    rest = aside.select(F.col("ext").alias("dms_order_no"), "item_code", "invoice_no", "src_pos", F.lit(None).cast("string").alias("oms_order_no"),
                        F.when(F.col("ext").isNull(), "no DMS number").when(F.col("item").isNull(), "no item code").otherwise("no quantity").alias("status"), (F.col("sign") * F.col("q")).alias("q"), "cents")
    return pieces.unionByName(rest).select(
        "dms_order_no", "item_code", "invoice_no", "src_pos", "oms_order_no", "status",
        (F.col("q").cast("decimal(38,6)") / UNITS).cast("decimal(28,6)").alias("qty"), (F.col("cents").cast("decimal(30,2)") / 100).cast("decimal(28,2)").alias("amount"))
