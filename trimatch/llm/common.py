"""Shared helpers: table reads, the shared work folder, Arrow text blocks and
vectorised word hashing.

Words are split on bytes, so only ASCII separators matter.  All hashes are
fixed functions of the bytes: the same on every executor and every retry.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.session import checkpoint_dir

BLOCK_BYTES = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here,
    so a lost executor costs a reread and no recomputation."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_places(df: DataFrame, *cols: str, as_read: bool = False) -> DataFrame:
    """``cols`` with ``row_f`` and ``row_i``, which tell all rows apart whatever
    they hold: the file (hashed) and the row's index in it.  ``as_read`` says
    that ``df`` is a Parquet table as it was read; else a written copy has them."""
    df = df if as_read else staged(df.select(*cols), "rows")
    return df.select(*cols, F.xxhash64("_metadata.file_path").alias("row_f"), F.col("_metadata.row_index").alias("row_i"))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def remove_id(col: str = "doc_id"):
    """``crc32`` of the id written as text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


# --- Arrow text blocks -----------------------------------------------------

def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string array (null reads as empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()) if arr.null_count == 0 else arr.cast(pa.large_string()).fill_null("")
    _, off, data = arr.buffers()
    offs = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    lo, hi = int(offs[0]), int(offs[-1])
    buf = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    return buf, offs - lo


def text_blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
                max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into blocks of about ``max_bytes`` of text (one longer
    document makes a block of its own): (rows, bytes, offsets)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        buf, offs = text_buffer(batch.column(text))
        at = 0
        while at < n:
            to = int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), n)
            yield batch.slice(at, to - at), buf[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
            at = to


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# --- words -------------------------------------------------------------------

def byte_set(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo:hi + 1] = True
    return out


#: Bytes that part words: space and \t \n \v \f \r.
BLANK = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes that part alphanumeric words (all ASCII but digits and lower-case letters).
NOT_WORD = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

def lower(buf: np.ndarray) -> np.ndarray:
    """Lower-case A-Z only."""
    capital = (buf - np.uint8(65)) < np.uint8(26)
    return buf + (capital.view(np.uint8) << np.uint8(5))


def words(buf: np.ndarray, offs: np.ndarray, sep: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each document
    (n_docs + 1 entries)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = np.take(~sep, buf)
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    begin[cut] = inside[1:-1][cut]          # a document's end parts words too
    end[cut - 1] = inside[1:-1][cut - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs, "left")


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base = _U(base)
        self.inverse = _U(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))

            def run(step):
                out = np.full(size, step, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            self.up, self.down = run(self.base), run(self.inverse)
        return self.up[:n], self.down[:n]


_BYTES, _GRAMS, _GRAMS2 = _Powers(0x9E3779B97F4A7C15), _Powers(0xC2B2AE3D27D4EB4F), _Powers(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one prefix sum over the block."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _BYTES.get(len(buf) + 1)
    pre = np.zeros(len(buf) + 1, np.uint64)
    each = buf.astype(np.uint64)
    each += _U(1)
    each *= up[:-1]
    np.cumsum(each, out=pre[1:])
    return mix((pre[ends] - pre[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _BASE)


def grams(h: np.ndarray, k: int, second: bool = False) -> np.ndarray:
    """64-bit hash of every k consecutive entries of ``h``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = (_GRAMS2 if second else _GRAMS).get(len(h) + 1)
    pre = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:-1], out=pre[1:])
    return mix((pre[k:] - pre[:-k]) * down[:n])


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Word positions at which k words of one document begin, given the first
    word of each document."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    if not n.sum():
        return np.zeros(0, np.int64)
    begin = np.cumsum(n) - n
    return np.arange(n.sum()) - np.repeat(begin, n) + np.repeat(first[:-1], n)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
