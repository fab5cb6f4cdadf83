"""Shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their ids, sizes and checksums
(:func:`trimatch.operators.numbering.number_rows`: ranges, counts and prefix
sums).  A keyed permutation of 0..n-1 gives each number its place; place p is
slot p // shards of shard p % shards, so shards differ by one row at most and
slots have no gaps.  Both ways are computable from n, the key and the number of
shards alone: :func:`place_of` and :func:`row_at`.

The permutation is a Feistel network over pairs (left, right) with
left < a, right < b and a * b the smallest such product of about square sides
that holds n; a value of n or more is sent through again until it is below n
(cycle walking).  Fewer than a of the a * b pairs are outside, so nearly all
rows take one pass.  All of it is SQL functions.

Edge cases: a null or empty text has size 1 and checksum 0; null ids come
first; repeated rows get a number each; equal tables give equal shards however
they are partitioned (rows that differ in no ordering column may swap);
an empty table gives no rows; other columns are carried if asked for and may
have any names but those of the results.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.operators.numbering import number_rows

from .common import table

SHARDS = 16
KEY = 20240613
ROUNDS = 6
#: Passes of the cycle walk.  A walk meets each outside value once at most, so
#: below 4096 rows (fewer than 64 outside) it always ends; above, a walk of 64
#: passes has a chance under 64 ** -64 a row, and is an error, not a lost row.
WALK = 64


def _sides(n: int) -> tuple[int, int]:
    a = isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _mask(value: Column, key: int, step: Column, side: Column) -> Column:
    """Keyed number below ``side``."""
    return F.pmod(F.xxhash64(F.lit(key).cast("long"), step.cast("long"), value.cast("long")), side)


def _network(x: Column, n: int, key: int, rounds: int, back: bool) -> Column:
    """One pass over pairs: each round adds (or takes away) a keyed function of
    one half to the other and swaps them; the sides swap with the halves."""
    if rounds % 2:
        raise ValueError("an even number of rounds")
    a, b = _sides(n)
    pair = F.struct(F.call_function("div", x, F.lit(b).cast("long")).alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
    steps = list(range(rounds))

    def side(step: Column) -> Column:       # of the left half in this round
        return F.when(step % 2 == 0, F.lit(a).cast("long")).otherwise(F.lit(b).cast("long"))

    def forth(p: Column, step: Column) -> Column:
        return F.struct(p["r"].alias("l"), F.pmod(p["l"] + _mask(p["r"], key, step, side(step)), side(step)).alias("r"))

    def undo(p: Column, step: Column) -> Column:
        return F.struct(F.pmod(p["r"] - _mask(p["l"], key, step, side(step)), side(step)).alias("l"), p["l"].alias("r"))

    order = F.array(*[F.lit(s) for s in (reversed(steps) if back else steps)])
    done = F.aggregate(order, pair, undo if back else forth)
    return F.aggregate(F.array(done), F.lit(0).cast("long"), lambda _, p: p["l"] * F.lit(b).cast("long") + p["r"])


def permuted(x: Column, n: int, key: int = KEY, rounds: int = ROUNDS, back: bool = False) -> Column:
    """The place of row ``x`` (0 to n-1) under the permutation of ``key``; with
    ``back`` the row of place ``x``."""
    def again(v: Column, _: Column) -> Column:
        return F.when((v >= 0) & (v < n), v).otherwise(_network(v, n, key, rounds, back))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), _network(x.cast("long"), n, key, rounds, back), again)
    return F.aggregate(F.array(end), F.lit(0).cast("long"), lambda _, v: F.when(v < n, v).otherwise(
        F.raise_error(F.lit("a cycle walk did not end")).cast("long")))


def place_of(row_no: Column, n: int, shards: int = SHARDS, key: int = KEY) -> Column:
    """Shard and slot of a row number, as a struct."""
    return F.aggregate(F.array(permuted(row_no, n, key)), F.struct(F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")),
                       lambda _, p: F.struct(F.pmod(p, F.lit(shards)).cast("int").alias("shard"),
                                             F.call_function("div", p, F.lit(shards).cast("long")).alias("slot")))


def row_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, key: int = KEY) -> Column:
    """Row number that a shard holds in a slot."""
    return permuted(slot.cast("long") * shards + shard, n, key, back=True)


def shard_rows(docs: DataFrame, shards: int = SHARDS, key: int = KEY, id_col: str = "doc_id", text_col: str = "text",
               carry: Sequence[str] = ()) -> DataFrame:
    """(id, size, text_crc32, row_no, shard, slot) of every row, and the
    columns of ``carry``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = docs.select(id_col, (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), *[c for c in carry if c != id_col])
    rows = number_rows(digest, [id_col, "size", "text_crc32"])
    n = rows.count()
    return rows.withColumn("place", place_of(F.col("row_no"), n, shards, key)).select(
        id_col, "size", "text_crc32", "row_no", "place.shard", "place.slot", *[c for c in carry if c != id_col])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: int = KEY, file_rows: int = 1 << 20, **names: str) -> DataFrame:
    """Write all columns of ``docs`` by shard, rows in slot order, in files of
    ``file_rows`` slots (folders ``shard=.../file=...``), and read them back."""
    carry = [c for c in docs.columns if c not in ("size", "text_crc32", "row_no", "shard", "slot")]
    out = shard_rows(docs, shards, key, carry=carry, **names).withColumn("file", F.floor(F.col("slot") / file_rows).cast("long"))
    (out.repartition("shard", "file").sortWithinPartitions("shard", "file", "slot")
     .write.partitionBy("shard", "file").parquet(path))
    return docs.sparkSession.read.parquet(path)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
