"""Conflict-constrained best-fit packing.

Documents become pieces of at most ``capacity`` tokens.  Full pieces fill a
sequence alone; the others are packed, longest first, into bins kept in order
of free room.  Each bin carries a bitmap of the sources and one of the
duplicate clusters it holds.  For a piece the search starts at the tightest
bin with room and goes on to its successors until one has neither the
piece's source nor its cluster; if none has, a new bin opens.

Packing runs in cells of about ``cell_rows`` documents, chosen by a hash of
the id, so a source or a cluster that holds a third of all rows is spread
evenly and memory is bounded.  The cell count follows from a row count.

Edge cases: null or empty text has no tokens and becomes a piece of length 0
(it is placed like any other); null source or cluster never conflicts; a
null doc_id is packed and reported as null; repeated rows are packed each
(their equal cluster keeps them apart); an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CAPACITY = 2048
CELL_ROWS = 1024
_SCHEMA = "bin_id long, slot int, doc_id long, piece int, token_start long, n_tokens long, source string, cluster long, bin_tokens long"


def best_fit(pieces: list[tuple], capacity: int) -> list[list[int]]:
    """Bins as lists of piece numbers; a piece is (length, source, cluster).

    ``pieces`` are placed in the given order."""
    number: dict = {}

    def bit(kind: str, value) -> int:
        return 0 if value is None else 1 << number.setdefault((kind, value), len(number))

    common = {k for k, n in Counter(p[2] for p in pieces).items() if n > 1}  # others can't conflict
    free: list[tuple[int, int]] = []           # (room, bin) in order
    bins, sources, clusters = [], [], []
    for k, (size, source, cluster) in enumerate(pieces):
        s, c = bit("s", source), bit("c", cluster if cluster in common else None)
        at = bisect_left(free, (size, -1))
        while at < len(free) and (sources[free[at][1]] & s or clusters[free[at][1]] & c):
            at += 1
        if at < len(free):
            room, b = free.pop(at)
        else:
            room, b = capacity, len(bins)
            bins.append([])
            sources.append(0)
            clusters.append(0)
        bins[b].append(k)
        sources[b] |= s
        clusters[b] |= c
        insort(free, (room - size, b))
    return bins


def _pack_cell(rows: list[tuple], cell: int, capacity: int) -> list[tuple]:
    """rows: (doc_id, n_tokens, source, cluster)."""
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or "", r[3] or 0))
    pieces = [(doc, k, k * capacity, min(capacity, n - k * capacity), source, cluster)
              for doc, n, source, cluster in rows for k in range(max(1, -(-n // capacity)))]
    full = [p for p in pieces if p[3] == capacity]
    rest = sorted((p for p in pieces if p[3] < capacity), key=lambda p: -p[3])  # stable: ties stay by id
    bins = [[p] for p in full] + [[rest[i] for i in b] for b in best_fit([(p[3], p[4], p[5]) for p in rest], capacity)]
    out = []
    for b, members in enumerate(bins):
        total = sum(p[3] for p in members)
        out += [((cell << 32) + b, slot, *p, total) for slot, p in enumerate(members)]
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, cell_rows: int = CELL_ROWS, id_col: str = "doc_id",
         tokens: str = "n_tokens", source: str = "source", cluster: str = "cluster") -> DataFrame:
    """One row per piece: its bin, slot, document, piece number, first token,
    length, and the bin's total.  ``docs`` has the four named columns."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(tokens).cast("long"), F.lit(0)).alias("n_tokens"),
                       F.col(source).cast("string").alias("source"), F.col(cluster).cast("long").alias("cluster"))
    cells = max(1, -(-rows.count() // cell_rows))
    cell = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("cluster"))), F.lit(cells)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for c, *row in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if c != now and held:
                    yield _batch(_pack_cell(held, now, capacity))
                    held = []
                now = c
                held.append(tuple(row))
        if held:
            yield _batch(_pack_cell(held, now, capacity))

    return (rows.select(cell.alias("cell"), "*").repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(run, _SCHEMA))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def with_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens (words parted by ASCII white space) and cluster
    (equal for texts that are equal up to case and white space)."""
    text = F.trim(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[ \t-\r]+", " "))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("t"))
    return plain.select(
        "doc_id", "source",
        F.when(F.col("t") == "", 0).otherwise(F.length("t") - F.length(F.replace("t", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_tokens"),
        F.when(F.col("t") != "", F.xxhash64(F.lower("t"))).alias("cluster"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack the whole documents table into sequences of 2048 words."""
    return pack(with_tokens(table(spark, sf_dir, "documents")))
