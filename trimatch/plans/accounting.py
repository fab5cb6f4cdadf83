"""Where every input row goes: used, filtered (and why), or set aside.

``outcomes`` labels each row of a leg by the first rule that takes it out of
the match; ``leg_accounting`` counts the labels, so rows in = used + filtered +
set aside for each leg; ``set_aside`` gives the rows without a usable key, with
their money, for follow-up.

``observed_legs`` takes the same counts while another job reads the legs: the
labelled rows pass an ``observe`` and go on, without those that are filtered,
to the match.  No job of its own counts them.
"""

from __future__ import annotations

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from trimatch.functions.codes import delivery_order_no, norm_code
from trimatch.functions.dates import in_period, safe_timestamp
from trimatch.functions.numbers import safe_number, unparsed
from trimatch.operators.filters import keep_invoice_type_adaptive, keep_invoice_type_text
from trimatch.operators.join import dms_order_map
from trimatch.plans.reconcile import oms_filtered_orders
from trimatch.plans.spec import OMS, SourceSpec

USED, FILTERED, SET_ASIDE = "used", "filtered", "set aside"


def _label(df: DataFrame, rules: list[tuple[Column, str, str]]) -> DataFrame:
    """The first rule whose condition holds gives (outcome, reason)."""
    pair = None
    for cond, outcome, reason in rules:
        value = F.struct(F.lit(outcome).alias("outcome"), F.lit(reason).alias("reason"))
        cond = F.coalesce(cond, F.lit(False))
        pair = F.when(cond, value) if pair is None else pair.when(cond, value)
    end = F.struct(F.lit(USED).alias("outcome"), F.lit("").alias("reason"))
    return df.withColumn("__fate", pair.otherwise(end) if pair is not None else end).select("*", "__fate.outcome", "__fate.reason").drop("__fate")


def _dates(df: DataFrame, col: str, spec: SourceSpec) -> list[tuple[Column, str, str]]:
    if not spec.period:
        return []
    ts = safe_timestamp(col, dtype=df.schema[col].dataType)
    return [(ts.isNull(), FILTERED, "no date"), (~in_period(ts, *spec.period), FILTERED, "outside period")]


def _key(*cols: Column) -> list[tuple[Column, str, str]]:
    order_no, item = cols
    return [(order_no.isNull(), SET_ASIDE, "no order number"), (item.isNull(), SET_ASIDE, "no item code")]


def _with_sales(invoices: DataFrame, orders: DataFrame, spec: SourceSpec) -> DataFrame:
    """Invoices with ``__sales``: the sale orders that the cross-reference gives
    to a row with a DMS number only (null for other rows and without any)."""
    m = dms_order_map(oms_filtered_orders(orders, spec), spec.normalize_codes, spec.dedupe_map)
    m = m.where(F.col("__sale").isNotNull()).groupBy("__ext", "__item").agg(F.collect_list("__sale").alias("__sales"))
    item = norm_code("item_code", invoices.schema["item_code"].dataType) if spec.normalize_codes else F.col("item_code")
    alone = F.col("oms_order_no").isNull() & F.col("dms_order_no").isNotNull()
    mapped = invoices.where(alone).join(m, (F.col("dms_order_no") == F.col("__ext")) & (item == F.col("__item")), "left").drop("__ext", "__item")
    return invoices.where(~alone).withColumn("__sales", F.lit(None).cast("array<string>")).unionByName(mapped)


def _rules(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
           spec: SourceSpec) -> dict[str, tuple[DataFrame, Column, list[tuple[Column, str, str]]]]:
    """Per leg: its rows, their order number, and the rules that end a row's
    way, in the order they apply."""
    item = F.col("item_code")
    if spec.name == "DMS":
        o_key, d_key, i_key = F.col("platform_order_no"), F.col("external_order_no"), F.col("dms_order_no")
        o = [(~F.upper("channel_name").contains("DMS") | F.col("channel_name").isNull(), FILTERED, "channel")]
        d = [(d_key.isNull(), FILTERED, "no external number")]
        i = [(~keep_invoice_type_text(invoices), FILTERED, "invoice type"), (i_key.isNull(), FILTERED, "no DMS number")]
    else:
        o_key, i_key = F.col("sale_order_no"), F.col("oms_order_no")
        d_key = delivery_order_no("main_no" if "main_no" in deliveries.columns else None, "order_no")
        o = [(F.col("order_status").isin(*spec.excluded_statuses), FILTERED, "status"),
             (~F.coalesce(F.col("order_type").isin(*spec.kept_order_types), F.lit(False)), FILTERED, "order type"),
             *_dates(orders, "create_time", spec)]
        d = _dates(deliveries, "biz_time", spec)
        i = [(~keep_invoice_type_adaptive(invoices), FILTERED, "invoice type")]
        if "dms_order_no" in invoices.columns:
            alone = i_key.isNull() & F.col("dms_order_no").isNotNull()
            if spec.map_dms_invoices and "external_order_no" in orders.columns:
                invoices = _with_sales(invoices, orders, spec)
                n = F.size(F.coalesce("__sales", F.array().cast("array<string>")))
                i += [(alone & item.isNull(), SET_ASIDE, "no item code"), (alone & (n == 0), FILTERED, "unmapped"),
                      (alone & (n == 1), USED, "mapped"), (alone, USED, "mapped to several orders")]
            else:
                i.append((alone, FILTERED, "needs map"))
    return {"orders": (orders, o_key, o + _key(o_key, item)), "deliveries": (deliveries, d_key, d + _key(d_key, item)),
            "invoices": (invoices, i_key, i + _key(i_key, item))}


def outcomes(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
             spec: SourceSpec = OMS) -> dict[str, DataFrame]:
    """Each leg with ``order_key``, ``outcome`` and ``reason``."""
    return {name: _label(df, rules).withColumn("order_key", key)
            for name, (df, key, rules) in _rules(orders, deliveries, invoices, spec).items()}


_MEASURE = {"orders": "pay_amount", "deliveries": "shipped_qty", "invoices": "amount"}


def _measured(leg: str, df: DataFrame) -> tuple[Column, Column]:
    """The leg's measure as a number, and whether its text is none."""
    m = _MEASURE[leg]
    if m not in df.columns:
        return F.lit(None).cast("decimal(38,6)"), F.lit(False)
    kind = df.schema[m].dataType
    return safe_number(m, kind), unparsed(m, kind)


def leg_accounting(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame, spec: SourceSpec = OMS) -> DataFrame:
    """(leg, outcome, reason, n_rows, measure, unparsed): row counts of each
    fate with the leg's measure summed, and its non-blank values that are no
    numbers."""
    frames = []
    for leg, df in outcomes(orders, deliveries, invoices, spec).items():
        v, bad = _measured(leg, df)
        frames.append(df.groupBy("outcome", "reason").agg(
            F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.round(F.sum(v), 2), F.lit(0)).cast("decimal(28,2)").alias("measure"),
            F.count_if(bad).alias("unparsed")).select(F.lit(leg).alias("leg"), "*"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _read(seen: Observation, box: list[dict]) -> None:
    try:
        box.append(seen.get)                    # waits for the end of the job
    except Py4JJavaError:                       # the job left it empty
        pass


class ObservedCounts:
    """The accounting that a job leaves behind when it reads observed legs."""

    def __init__(self) -> None:
        self.legs: dict[str, tuple[Observation, list[tuple[str, str]]]] = {}

    def add(self, leg: str, df: DataFrame, fates: list[tuple[str, str]]) -> DataFrame:
        v, bad = _measured(leg, df)
        metrics = []
        for k, (outcome, reason) in enumerate(fates):
            here = (F.col("outcome") == outcome) & (F.col("reason") == reason)
            metrics += [F.count_if(here).alias(f"n{k}"), F.count_if(here & bad).alias(f"u{k}"),
                        F.coalesce(F.round(F.sum(F.when(here, v)), 2), F.lit(0)).cast("decimal(28,2)").alias(f"m{k}")]
        seen = Observation(f"accounting-{leg}-{uuid.uuid4().hex[:8]}")
        self.legs[leg] = (seen, fates)
        return df.observe(seen, *metrics)

    def rows(self, wait: float = 20.0) -> list[Row] | None:
        """Rows of :func:`leg_accounting`, or None if a leg was never read (the
        optimizer drops legs that can't change an empty result)."""
        out = []
        for leg, (seen, fates) in self.legs.items():
            box: list[dict] = []
            reader = threading.Thread(target=_read, args=(seen, box), daemon=True)
            reader.start()
            reader.join(wait)
            if not box or not box[0]:
                return None
            out += [Row(leg=leg, outcome=o, reason=r, n_rows=box[0][f"n{k}"], measure=box[0][f"m{k}"], unparsed=box[0][f"u{k}"])
                    for k, (o, r) in enumerate(fates) if box[0][f"n{k}"]]
        return out


#: Schema of :func:`leg_accounting`.
ACCOUNTING = "leg string, outcome string, reason string, n_rows long, measure decimal(28,2), unparsed long"


def observed_legs(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame,
                  spec: SourceSpec = OMS) -> tuple[list[DataFrame], ObservedCounts]:
    """The three legs without the rows that are filtered, DMS-only invoices
    mapped, for a reconciliation with ``spec.prefiltered``; the job that reads
    them fills the counts."""
    counts, legs = ObservedCounts(), []
    for leg, (df, _, rules) in _rules(orders, deliveries, invoices, spec).items():
        fates = list(dict.fromkeys([(o, r) for _, o, r in rules] + [(USED, "")]))
        kept = counts.add(leg, _label(df, rules), fates).where(F.col("outcome") != FILTERED).drop("outcome", "reason")
        if "__sales" in kept.columns:
            sales = F.coalesce("__sales", F.array("oms_order_no"))
            kept = kept.withColumn("oms_order_no", F.explode(sales)).drop("__sales")
        legs.append(kept)
    return legs, counts


def set_aside(orders: DataFrame, deliveries: DataFrame, invoices: DataFrame, spec: SourceSpec = OMS) -> DataFrame:
    """The rows that can't be matched for want of a key."""
    frames = []
    for leg, df in outcomes(orders, deliveries, invoices, spec).items():
        m = F.col(_MEASURE[leg]).cast("string") if _MEASURE[leg] in df.columns else F.lit(None).cast("string")
        src = F.col("src_file") if "src_file" in df.columns else F.lit(None).cast("string")
        frames.append(df.where(F.col("outcome") == SET_ASIDE).select(
            F.lit(leg).alias("leg"), "reason", F.col("order_key").cast("string").alias("order_no"),
            F.col("item_code").cast("string").alias("item_code"), m.alias("measure"), src.alias("src_file")))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
