"""Aggregations: leg totals with carried attributes, counts, shares."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from trimatch.functions.numbers import NUMBER, safe_number

SUM_TYPE = "decimal(28,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_non_null(col: Column | str, pos: Column | str = "src_pos") -> Column:
    """Value of the earliest row (by ``pos``) among rows where it is not NULL.
    Deterministic replacement for "first": Spark rows carry no order."""
    c = _c(col)
    return F.min_by(c, F.when(c.isNotNull(), _c(pos)))


def first_row(cols: list[str], pos: Column | str = "src_pos") -> Column:
    """Whole earliest row (NULLs kept) as a struct."""
    return F.min_by(F.struct(*[F.col(c) for c in cols]), _c(pos))


def leg_sum(col: Column | str, round_before_sum: bool, dtype: DataType | None = None) -> Column:
    """Sum of a measure parsed tolerantly.  An all-NULL group sums to 0 (so a
    present leg with unparseable values is still tested).

    Rounded to cents per line before summing (then summed exactly as whole
    cents in a ``long``: fast, and an overflow fails the job under ANSI mode
    instead of wrapping), or summed as decimals and rounded once after."""
    v = safe_number(col, dtype)
    if round_before_sum:
        cents = F.sum((F.round(v, 2) * 100).cast("long"))
        s = cents.cast("decimal(28,0)") * F.lit(Decimal("0.01"))
    else:
        s = F.round(F.sum(v), 2)
    return F.coalesce(s, F.lit(0)).cast(SUM_TYPE)


def aggregate_leg(df: DataFrame, keys: Mapping[str, Column], sums: Mapping[str, Column | str],
                  carry: Mapping[str, str] | None = None, round_before_sum: bool = True,
                  pos: str = "src_pos", first: str = "non_null") -> DataFrame:
    """One row per key with summed measures and carried attributes.

    Rows with a NULL key part are set aside (never matched); partial
    aggregation runs map-side before the shuffle on the keys."""
    carry = {k: v for k, v in (carry or {}).items() if v in df.columns}
    keyed = df.select(*[e.alias(n) for n, e in keys.items()],
                      *[_c(e).alias(f"__m_{n}") for n, e in sums.items()],
                      *[F.col(src).alias(f"__a_{out}") for out, src in carry.items()],
                      F.col(pos).alias("__pos"))
    keyed = keyed.where(_all_not_null(list(keys)))
    types = {f.name: f.dataType for f in keyed.schema.fields}
    aggs = [leg_sum(f"__m_{n}", round_before_sum, types[f"__m_{n}"]).alias(n) for n in sums]
    if first == "row" and carry:
        row = first_row([f"__a_{o}" for o in carry], "__pos").alias("__row")
        out = keyed.groupBy(*keys).agg(*aggs, row)
        return out.select(*keys, *sums, *[F.col(f"__row.__a_{o}").alias(o) for o in carry])
    aggs += [first_non_null(f"__a_{o}", "__pos").alias(o) for o in carry]
    return keyed.groupBy(*keys).agg(*aggs)


def _all_not_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def type_counts(df: DataFrame, col: str, out: str = "invoice_type") -> DataFrame:
    """Frequency table of a column, NULLs excluded, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(out))
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), out))


__all__ = ["NUMBER", "aggregate_leg", "first_non_null", "first_row", "leg_sum", "type_counts"]
