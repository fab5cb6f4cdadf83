"""Importance resampling towards a target by hashed n-gram gains.

Both corpora are counted by feature bucket: a feature is a run of ``orders``
consecutive words joined by one space, its bucket the crc32 of its bytes modulo
``buckets``.  A bucket's gain is the log ratio of its smoothed shares in target
and source, a document's weight the floored mean of the gains over its
features.  A Gumbel number keyed by seed and id is added, and the documents of
highest sum are drawn: a sample without replacement in proportion to
exp(weight / 1000), the same on every run.

A block of texts interns its features in an open-addressed table of NumPy
arrays: the xxhash64 of a feature gives its first slot, linear probing goes on
until the slot is free or its feature has the same hash and the same bytes.
Bucket and count live in the slot, so crc32 runs once for each different
feature of a block, and the slots of all occurrences gather the gains.  Tasks
send at most ``buckets`` counts each; the driver holds ``buckets`` gains.

Ranks come from a distributed numbering of the eligible rows
(:func:`trimatch.operators.numbering.number_rows`); nothing is collected.

Edge cases: a null or empty text has no features and weight 0; a null id is
drawn with the key of an empty id text; ties go to the smaller id (null first),
repeated rows compete on their own and take ranks next to each other; an empty
source gives no rows, an empty target leaves all smoothed target shares equal;
other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trimatch.operators.numbering import number_rows, written

from .common import NOT_WORD, gram_starts, lower, table, text_blocks, words

BUCKETS = 10_000
ORDERS = (1,)
SEED = 2024
MIN_WORDS = 20
PERCENT = 10


class Features:
    """The features of a block: spans of one byte buffer in which single
    spaces part words, and the document each is from."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, orders=ORDERS) -> None:
        buf = lower(buf)
        starts, ends, first = words(buf, offs, NOT_WORD)
        size = ends - starts
        at = np.cumsum(size + 1) - size - 1          # where each word begins once single spaces part them
        self.text = np.full(int(size.sum()) + len(size), 32, np.uint8)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        self.text[np.repeat(at, size) + inside] = buf[np.repeat(starts, size) + inside]
        self.n_words = np.diff(first)
        begin, end, doc = [], [], []
        for k in orders:
            w = gram_starts(first, k)
            begin.append(at[w])
            end.append(at[w + k - 1] + size[w + k - 1])
            doc.append(np.repeat(np.arange(len(first) - 1), np.maximum(self.n_words - k + 1, 0)))
        self.begin, self.end = np.concatenate(begin), np.concatenate(end)
        self.doc = np.concatenate(doc)
        self.per_doc = np.bincount(self.doc, minlength=len(first) - 1)

    def hashes(self) -> np.ndarray:
        raw, digest = self.text.tobytes(), xxhash.xxh64_intdigest
        return np.fromiter((digest(raw[a:b]) for a, b in zip(self.begin.tolist(), self.end.tolist())), np.uint64, len(self.begin))

    def same(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether pairs of features have equal bytes."""
        size = self.end[one] - self.begin[one]
        out = size == self.end[two] - self.begin[two]
        todo = np.flatnonzero(out & (one != two))
        n = size[todo]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        equal = self.text[np.repeat(self.begin[one[todo]], n) + inside] == self.text[np.repeat(self.begin[two[todo]], n) + inside]
        if len(todo):
            out[todo] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        return out


class Interned:
    """Open-addressed table of a block's features.

    ``owner`` holds a slot's feature (-1: free), ``bucket`` and ``count`` its
    bucket and occurrences, ``slot`` the slot of every occurrence."""

    def __init__(self, features: Features, buckets: int = BUCKETS, hashes: np.ndarray | None = None) -> None:
        keys = features.hashes() if hashes is None else hashes
        n = len(keys)
        size = 1 << max(int(2 * n - 1).bit_length(), 1)      # half full at most
        mask = np.uint64(size - 1)
        self.owner = np.full(size, -1, np.int64)
        self.slot = np.zeros(n, np.int64)
        at, todo = (keys & mask).astype(np.int64), np.arange(n)
        while len(todo):
            here = at[todo]
            free = self.owner[here] < 0
            self.owner[here[free]] = todo[free]              # one of those that meet on a free slot gets it
            owner = self.owner[here]
            mine = keys[owner] == keys[todo]
            mine[mine] = features.same(todo[mine], owner[mine])
            self.slot[todo[mine]] = here[mine]
            todo = todo[~mine]
            at[todo] = (at[todo] + 1) & (size - 1)
        used = np.flatnonzero(self.owner >= 0)
        raw = features.text.tobytes()
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = [zlib.crc32(raw[a:b]) % buckets for a, b in
                             zip(features.begin[self.owner[used]].tolist(), features.end[self.owner[used]].tolist())]
        self.count = np.bincount(self.slot, minlength=size)

    def bucket_counts(self, buckets: int) -> np.ndarray:
        used = self.owner >= 0
        return np.bincount(self.bucket[used], weights=self.count[used], minlength=buckets).astype(np.int64)


def bucket_counts(docs: DataFrame, orders=ORDERS, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """(bucket, n): occurrences of features by bucket over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, buf, offs in text_blocks(batches, text_col):
            total += Interned(Features(buf, offs, orders), buckets).bucket_counts(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return docs.select(text_col).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():                   # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket."""
    b = len(source)
    all_s, all_t = float(source.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, orders=ORDERS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    buckets = len(gain)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(id_col, text_col, F.conv(F.substring(key, 1, 8), 16, 10).cast("long").alias("h" if id_col != "h" else "h_"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches, text_col):
            f = Features(buf, offs, orders)
            table_ = Interned(f, buckets)
            got = gain[table_.bucket[table_.slot]]
            total = np.zeros(len(f.per_doc), np.int64)
            np.add.at(total, f.doc, got)
            weight = np.where(f.per_doc > 0, total // np.maximum(f.per_doc, 1), 0)
            gumbel = np.array([math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in rows.column(2).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *[pa.array(x, pa.int64()) for x in (f.n_words, f.per_doc, weight, weight + gumbel)]],
                [id_col, "n_words", "n_features", "weight", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(score, f"`{id_col}` {kind}, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, orders=ORDERS,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row; ``rank``
    (from 1) is null where the row is not among the ``percent`` % drawn."""
    gain = gains(_vector(bucket_counts(docs, orders, buckets, text_col), buckets),
                 _vector(bucket_counts(target, orders, buckets, target_text), buckets))
    rows = written(scored(docs, gain, orders, seed, id_col, text_col), "resample-scores")
    able = F.col("n_words") >= min_words
    drawn = rows.filter(able).count() * percent // 100
    ranked = number_rows(rows.filter(able), [F.desc("score"), id_col], out="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    return ranked.unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document towards the benchmark."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
