"""The match kept up to date as files arrive: late orders, deliveries and
invoices change only the keys that they hold.

Each update aggregates the new rows alone, to leg totals that still merge
(sums before their last rounding, the earliest attributes with their position),
and stores them as a delta.  The sums of the delta's keys are then merged over
all deltas, matched and classified, and stored as newer rows of the result;
:meth:`Match.result` takes the newest row of each key and adds the attributes,
merged over the deltas when they are read.  After ``compact_after`` updates the
deltas and the result are written as one again, so a read never meets more than
that many layers.

Rows move once, when a delta is made: deltas, changed keys and result rows are
written in buckets of the key, as many as there were shuffle partitions at the
first update, and what reads them merges and joins bucket by bucket.

The result equals :func:`trimatch.plans.reconcile.reconcile` over all rows so
far, updates standing in the order of their arrival.  The OMS invoice-type
rule depends on the share of codes among *all* invoices, so invoice totals are
kept apart by the rule that keeps them; when a new file tips the share, every
key is matched again from the stored totals, and no row is read twice.

An update counts once its commit is written; one that is cut short leaves the
state before it and may be run again.  A batch id that is committed already is
passed over, so a retry never counts rows twice.  One writer at a time.  NULL
key parts are set aside, as in the match.  ``map_dms_invoices`` is refused: a
late order can map any earlier invoice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from trimatch.functions.codes import delivery_order_no
from trimatch.functions.numbers import safe_number
from trimatch.operators.aggregate import SUM_TYPE
from trimatch.operators.classify import classify_dms, classify_oms, dms_variances, oms_variances, strict_not_test
from trimatch.operators.filters import channel_contains, code_hit, has_value, invoice_type_keep_text, keep_invoice_type_text
from trimatch.operators.join import KEYS, three_way_match, uninvoiced
from trimatch.plans import reconcile as R
from trimatch.plans import spec as S
from trimatch.plans.spec import SourceSpec
from trimatch.sources.files import qualified
from trimatch.sources.increments import committed
from trimatch.sources.staging import stage_path

LEGS = ("orders", "deliveries", "invoices")
COMMIT = ("version int, batch string, code_rows long, type_rows long, totals_from int, result_from int, "
          "orders string, deliveries string, invoices string, result string, buckets int")
RULES = ["by_code", "by_text"]
ATTRIBUTES = ("ord_", "dlv_", "inv_")
CARRY = {"OMS": dict(zip(LEGS, (R.ORDER_CARRY_OMS, R.DELIVERY_CARRY_OMS, R.INVOICE_CARRY_OMS), strict=True)),
         "DMS": dict(zip(LEGS, (R.ORDER_CARRY_DMS, R.DELIVERY_CARRY_DMS, R.INVOICE_CARRY_DMS), strict=True))}
# One row in so many is looked at for keys with many rows; so many of them make one.
SHOWN = (256, 64)
# The key that a column's text mostly is.
KEY_OF = dict.fromkeys(("sale_order_no", "platform_order_no", "order_no", "main_no", "external_order_no", "oms_order_no"), "order_no") | {"item_code": "item_code"}


@dataclass(frozen=True)
class Leg:
    """What a leg's totals are made of."""
    rows: DataFrame
    order_no: Column
    sums: dict[str, str]
    carry: dict[str, str]
    first: str = "non_null"


def _orders(df: DataFrame, spec: SourceSpec) -> Leg:
    sums = {"order_amount": "pay_amount", "order_qty": "item_num"}
    if spec.name == "DMS":
        rows = R._timestamps(channel_contains(df), "create_time", "update_time")
        return Leg(rows, F.col("platform_order_no"), sums, R.ORDER_CARRY_DMS)
    return Leg(R.oms_filtered_orders(df, spec), F.col("sale_order_no"), sums, R.ORDER_CARRY_OMS)


def _deliveries(df: DataFrame, spec: SourceSpec) -> Leg:
    sums = {"shipped_qty": "shipped_qty"}
    if spec.name == "DMS":
        rows = R._timestamps(has_value(df, "external_order_no"), "biz_time")
        return Leg(rows, F.col("external_order_no"), sums, R.DELIVERY_CARRY_DMS)
    main = "main_no" if "main_no" in df.columns else None
    return Leg(R.oms_filtered_deliveries(df, spec), delivery_order_no(main, "order_no"), sums, R.DELIVERY_CARRY_OMS)


def _invoices(df: DataFrame, spec: SourceSpec) -> Leg:
    """Invoice rows that some rule keeps, with the rules that do."""
    typed = "invoice_type" in df.columns
    if spec.name == "DMS":
        rows = has_value(df.where(keep_invoice_type_text(df, "invoice_type")), "dms_order_no")
        rows = rows.withColumns({r: F.lit(True) for r in RULES})
        return Leg(rows, F.col("dms_order_no"), {"invoice_amount": "amount", "invoice_qty_sales": "qty_sales_unit", "invoice_qty": "qty_base_unit"},
                   R.INVOICE_CARRY_DMS, spec.invoice_first)
    by_code = F.col("invoice_type").isin(*S.KEPT_INVOICE_CODES) if typed else F.lit(True)
    by_text = invoice_type_keep_text("invoice_type") if typed else F.lit(True)
    rows = df.where(F.col("oms_order_no").isNotNull()).withColumns(
        {"by_code": F.coalesce(by_code, F.lit(False)), "by_text": F.coalesce(by_text, F.lit(False))}).where("by_code OR by_text")
    return Leg(rows, F.col("oms_order_no"), {"invoice_amount": "amount", "invoice_qty": "qty"}, R.INVOICE_CARRY_OMS)


PLANS = {"orders": _orders, "deliveries": _deliveries, "invoices": _invoices}


def partial_totals(df: DataFrame, leg: str, spec: SourceSpec, version: int, buckets: int) -> DataFrame:
    """Totals of new rows that can be merged: rounded lines as whole cents,
    others as decimals; the attributes of the earliest row with its position,
    which starts with the version.  One row a key (and rule); where each
    attribute is to be the first that is not NULL, one row a key, rule and set
    of attributes that are ``held``: among rows that hold the same ones, the
    earliest row has the earliest value of each.  There, the text of a column
    that the key is made of is left out where it equals the key.

    Rows are dealt by the key alone, as the buckets are, and then aggregated:
    few keys have several.  Those that show up often among a few of the rows
    are aggregated where they are read, before they are dealt."""
    plan = PLANS[leg](df, spec)
    missing = [m for m in plan.sums.values() if m not in plan.rows.columns]
    if missing:
        raise ValueError(f"{leg}: no column {', '.join(missing)}")
    types = {f.name: f.dataType for f in plan.rows.schema.fields}
    carry = {out: col for out, col in plan.carry.items() if col in types}
    measure = {}
    for out, col in plan.sums.items():
        v = safe_number(col, types[col])
        measure[out] = (F.round(v, 2) * 100).cast("long") if spec.round_before_sum else v
    by = list(RULES) if leg == "invoices" else []
    key = {"order_no": plan.order_no, "item_code": R._item(spec, plan.rows)}
    values = {out: F.col(col) for out, col in carry.items()}
    held = []
    if plan.first == "non_null":
        held = [reduce(add, [F.when(values[out].isNotNull(), bit).otherwise(0) for out, bit in _bits(plan.carry).items() if out in carry], F.lit(0)).alias("held")]
        by.append("held")
        values |= {out: F.nullif(values[out], key[KEY_OF[col]]) for out, col in carry.items() if col in KEY_OF and types[col] == StringType()}
    keyed = plan.rows.select(*[c.alias(name) for name, c in key.items()], *(RULES if leg == "invoices" else []), *held,
                             *[v.alias(f"m_{out}") for out, v in measure.items()], *[v.alias(f"a_{out}") for out, v in values.items()],
                             F.col("src_pos").alias("pos"))
    keyed = keyed.where(F.col("order_no").isNotNull() & F.col("item_code").isNotNull())
    few = keyed.where(F.pmod(F.xxhash64("pos"), F.lit(SHOWN[0])) == 0)
    hot = few.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SHOWN[1]).select(*KEYS)
    found = hot.collect()       # at most one key in 16,384 rows
    if not found:
        out = merged_totals(keyed.repartition(buckets, *KEYS), by)
    else:
        hot = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))
        rest = merged_totals(keyed.join(hot, KEYS, "left_anti").repartition(buckets, *KEYS), by)
        out = rest.unionByName(merged_totals(keyed.join(hot, KEYS, "left_semi"), by))
    return out.withColumn("pos", F.struct(F.lit(version).alias("version"), F.col("pos").alias("at")))


def _bits(carry: Sequence[str]) -> dict[str, int]:
    """The bit of ``held`` that says that an attribute is not NULL."""
    return {out: 1 << n for n, out in enumerate(carry)}


def merged_totals(deltas: DataFrame, by: Sequence[str]) -> DataFrame:
    """Deltas as one, still mergeable."""
    types = dict(deltas.dtypes)
    measures = [c for c in types if c.startswith("m_")]
    sums = [F.sum(c) for c in measures]     # of decimals as wide as they get, so that layers have one type
    sums = [(v.cast(f"decimal(38,{types[c].rstrip(')').split(',')[1]})") if types[c].startswith("decimal") else v).alias(c)
            for c, v in zip(measures, sums, strict=True)]
    first = F.min(F.struct("pos", *[c for c in types if c.startswith("a_")])).alias("row")
    return deltas.groupBy(*KEYS, *by).agg(*sums, first).select(*KEYS, *by, *measures, "row.*")


def leg_totals(deltas: DataFrame, leg: str, spec: SourceSpec) -> DataFrame:
    """What :func:`trimatch.operators.aggregate.aggregate_leg` gives."""
    types = {f.name: f.dataType for f in deltas.schema.fields}
    sums = [c for c in types if c.startswith("m_")]
    carry = [c for c in types if c.startswith("a_")]
    columns = CARRY[spec.name][leg]

    def total(c: str) -> Column:
        v = F.col(c).cast("decimal(28,0)") * F.lit(Decimal("0.01")) if spec.round_before_sum else F.round(F.col(c), 2)
        return F.coalesce(v, F.lit(0)).cast(SUM_TYPE).alias(c[2:])

    def earliest(c: str) -> Column:
        there, value, key = F.col(c).isNotNull(), F.col(c), KEY_OF.get(columns[c[2:]])
        if key and types[c] == StringType():
            there, value = F.col("held").bitwiseAND(_bits(columns)[c[2:]]) != 0, F.coalesce(c, key)
        return F.min(F.when(there, F.struct("pos", value.alias("value")))).alias(c)
    if "held" in types:
        first, values = [earliest(c) for c in carry], [F.col(f"{c}.value").alias(c[2:]) for c in carry]
    else:
        first, values = [F.min(F.struct("pos", *carry)).alias("row")], [F.col(f"row.{c}").alias(c[2:]) for c in carry]
    merged = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in sums], *first)
    return merged.select(*KEYS, *[total(c) for c in sums], *values)


class Match:
    """The stored match of one profile, in the shared folder."""

    def __init__(self, spark: SparkSession, name: str, spec: SourceSpec, base: str | None = None, compact_after: int = 8):
        if spec.map_dms_invoices:
            raise ValueError("a late order can map any earlier invoice: run the whole match with map_dms_invoices")
        self.spark, self.spec, self.compact_after = spark, spec, compact_after
        self.root = stage_path(spark, name, base)

    def _commits(self) -> list:
        versions = committed(self.spark, f"{self.root}/commit")
        paths = [f"{self.root}/commit/v={v}" for v in versions]
        commits = sorted(self.spark.read.schema(COMMIT).parquet(*paths).collect()) if paths else []
        if any(c.buckets is None for c in commits):
            raise ValueError(f"{self.root} was kept in an older layout, without buckets: match its files anew")
        return commits

    def _put(self, df: DataFrame, kind: str, version: int, buckets: int) -> str:
        """Write rows in buckets of the key; returns their columns."""
        name = f"trimatch_{uuid.uuid4().hex}"
        try:
            df.write.mode("overwrite").option("path", qualified(self.spark, f"{self.root}/{kind}/v={version}")).option(
                "compression", "zstd").bucketBy(buckets, *KEYS).saveAsTable(name, format="parquet")
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")      # the name alone: the files lie outside the warehouse
        return df.schema.json()

    def _layers(self, kind: str, columns: Sequence[str], versions: Sequence[int], buckets: int) -> DataFrame:
        """Rows that :meth:`_put` wrote for the given versions, with their
        version ``v``, as one scan by buckets; columns that a version lacks are
        NULL.  Only a table can say that files are buckets, so the folder gets a
        name for as long as it takes to read it.  (A union of scans would not
        do: Spark counts it as dealt by the key, also where it runs it as it
        comes.)"""
        types = {f.name: f.dataType.simpleString() for c in columns for f in StructType.fromJson(json.loads(c))}
        name, conf = f"trimatch_{uuid.uuid4().hex}", "spark.sql.hive.manageFilesourcePartitions"
        at = qualified(self.spark, f"{self.root}/{kind}").replace("\\", "\\\\").replace("'", "\\'")
        before = self.spark.conf.get(conf)
        self.spark.conf.set(conf, "false")          # the folder says which versions there are, and is listed now
        try:
            self.spark.sql(f"CREATE TABLE {name} ({', '.join(f'`{c}` {t}' for c, t in types.items())}, v INT) USING parquet "
                           f"PARTITIONED BY (v) CLUSTERED BY ({', '.join(KEYS)}) INTO {buckets} BUCKETS LOCATION '{at}'")
            return self.spark.table(name).where(F.col("v").isin(*versions))
        finally:
            self.spark.conf.set(conf, before)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _deltas(self, leg: str, commits: list) -> DataFrame | None:
        """The leg's stored totals."""
        live = [c for c in commits if c.version >= commits[-1].totals_from and c[leg]]
        return self._layers(leg, [c[leg] for c in live], [c.version for c in live], live[0].buckets) if live else None

    def _totals(self, leg: str, commits: list, keys: DataFrame | None = None) -> DataFrame:
        deltas = self._deltas(leg, commits)
        if deltas is None:
            raise ValueError(f"no {leg} yet")
        if leg == "invoices":
            last = commits[-1]
            by_code = bool(last.type_rows) and 2 * last.code_rows > last.type_rows
            deltas = deltas.where("by_code" if by_code else "by_text")
        if keys is not None:
            deltas = deltas.join(keys, KEYS, "left_semi")
        return leg_totals(deltas, leg, self.spec)

    def totals(self, leg: str) -> DataFrame:
        """Totals of a leg over all updates, attributes included."""
        return self._totals(leg, self._commits())

    def uninvoiced(self) -> DataFrame:
        """Order and delivery keys without an invoice so far."""
        keep = {"orders": ["order_amount", "order_qty"], "deliveries": ["shipped_qty"], "invoices": []}
        o, d, i = (self.totals(leg).select(*KEYS, *keep[leg]) for leg in LEGS)
        return uninvoiced(o, d, i)

    def _match(self, commits: list, keys: DataFrame | None) -> DataFrame:
        """Sums, variances and class; attributes are left to :meth:`result`."""
        o, d, i = (self._totals(leg, commits, keys) for leg in LEGS)
        if self.spec.name == "DMS":
            out = classify_dms(dms_variances(three_way_match(i, o, d)), self.spec.amount_tol, self.spec.qty_tol)
        else:
            out = classify_oms(oms_variances(three_way_match(i, d, o)), self.spec.amount_tol, self.spec.qty_tol)
            out = strict_not_test(out) if self.spec.strict else out
        return out.drop(*(c for c in out.columns if c.startswith(ATTRIBUTES)))

    def update(self, batch: str, orders: DataFrame | None = None, deliveries: DataFrame | None = None,
               invoices: DataFrame | None = None) -> int:
        """Add the rows of new files; returns the version that holds them.  The
        first update needs all three legs (a leg without rows may be empty).  A
        leg's columns and ``src_pos`` have one type in all updates; a column may
        be missing."""
        commits = self._commits()
        done = [c.version for c in commits if c.batch == batch]
        if done:
            return done[0]
        given = {leg: df for leg, df in zip(LEGS, (orders, deliveries, invoices), strict=True) if df is not None}
        if not commits and len(given) < len(LEGS):
            raise ValueError("the first update needs orders, deliveries and invoices")
        last = commits[-1] if commits else None
        version = last.version + 1 if last else 1
        codes, typed = (last.code_rows, last.type_rows) if last else (0, 0)
        if self.spec.name == "OMS" and invoices is not None and "invoice_type" in invoices.columns:
            n = invoices.agg(F.count_if(code_hit("invoice_type")).alias("codes"), F.count(F.lit(1)).alias("n")).first()
            codes, typed = codes + n.codes, typed + n.n
        tipped = bool(last) and (2 * codes > typed) != (2 * last.code_rows > last.type_rows)
        compact = bool(last) and version - last.totals_from >= self.compact_after
        buckets = last.buckets if last else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        names = dict.fromkeys(LEGS)
        for leg, df in given.items():
            names[leg] = self._put(partial_totals(df, leg, self.spec, version, buckets), leg, version, buckets)

        def commit(totals_from: int, result_from: int, result: str | None = None):
            row = (version, batch, codes, typed, totals_from, result_from, *[names[leg] for leg in LEGS], result, buckets)
            return self.spark.createDataFrame([row], COMMIT)
        whole = not last or tipped or compact
        here = [*commits, commit(last.totals_from if last else version, version if whole else last.result_from).first()]
        changed = None
        if not whole:
            keys = [self._layers(leg, [names[leg]], [version], buckets).select(*KEYS) for leg in given]
            columns = self._put(reduce(DataFrame.union, keys), "changed", version, buckets)
            changed = self._layers("changed", [columns], [version], buckets).drop("v")
        result = self._put(self._match(here, changed), "result", version, buckets)
        totals_from = here[-1].totals_from
        if compact:
            # all layers into a folder of its own, then in place of this version's delta
            for leg in LEGS:
                deltas = self._deltas(leg, here)
                one = merged_totals(deltas, [c for c in deltas.columns if c in (*RULES, "held")])
                columns = self._put(one, f"{leg}-compact", version, buckets)
                names[leg] = self._put(self._layers(f"{leg}-compact", [columns], [version], buckets).drop("v"), leg, version, buckets)
            totals_from = version
        commit(totals_from, here[-1].result_from, result).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commit/v={version}")
        return version

    def result(self) -> DataFrame:
        """The classified match over all updates: of each key the newest row,
        with the attributes that the totals hold."""
        commits = self._commits()
        if not commits:
            raise ValueError("no update yet")
        base, buckets = commits[-1].result_from, commits[-1].buckets
        live = [c for c in commits if c.version >= base]
        rows = self._layers("result", [c.result for c in live], [c.version for c in live], buckets)
        if len(live) > 1:
            keys = StructType([f for f in StructType.fromJson(json.loads(live[0].result)) if f.name in KEYS]).json()
            newest = self._layers("changed", [keys], [c.version for c in live[1:]], buckets).groupBy(*KEYS).agg(F.max("v").alias("__newest"))
            rows = rows.join(newest, KEYS, "left").where(F.col("v") == F.coalesce("__newest", F.lit(base))).drop("__newest")
        rows, names = rows.drop("v"), list(KEYS)
        for leg in ("invoices", "orders", "deliveries") if self.spec.name == "DMS" else ("invoices", "deliveries", "orders"):
            totals = self._totals(leg, commits)
            names += totals.columns[len(KEYS):]
            rows = rows.join(totals.select(*KEYS, *(c for c in totals.columns if c.startswith(ATTRIBUTES))), KEYS, "left")
        return rows.select(*names, *(c for c in rows.columns if c not in names))
