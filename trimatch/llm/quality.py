"""Quality classifier: supervised subword embeddings.

Features of a text are its words, the character 3- to 5-grams of its words
(with their boundaries), and a mark for every word that repeats the one 1 to
8 words before; all hashed into ``BUCKETS`` rows.  Each row is a
learned vector; a document is the mean of its features' vectors; a softmax
over the two labels sits on top.  Vectors and softmax weights are trained
together by stochastic gradient descent in numpy, on at most ``train_rows``
labelled documents (the ones with the smallest hash of their id, so the
choice depends on neither order nor partitioning).  Scoring covers every
text and needs no shuffle: with two labels the score depends on each bucket
only through one number, (E @ (w1 - w0)), a table of a fixed 1 MB that goes
to the tasks.

Edge cases: null or empty text has no features and gets the score of the
bias; a null doc_id is scored and never trained on; a null label is not
trained on; with labels of one kind only, or none, the score is the share of
label 1 (0.5 without labels); repeated rows get equal scores; an empty table
gives no rows; labels, lang, source and doc_id are never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, mix, remove_id, table, text_blocks, text_buffer, word_hashes, words

BITS = 18
BUCKETS = 1 << BITS
DIM = 8
LAGS = range(1, 9)
TRAIN_ROWS = 4000
THRESHOLD = 0.7
_U = np.uint64


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document number of every feature of a block.  Character
    n-grams are over code points."""
    starts, ends, first = words(buf, offs)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    whole = word_hashes(buf, starts, ends)
    # code points: bytes that don't continue one; each takes the hash of its bytes
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    if not len(lead) or lead[0]:
        lead = np.concatenate([[0], lead])
    point = np.append(lead, len(buf))
    length = np.diff(point)
    code = buf[lead].astype(np.uint64)
    for k in (1, 2, 3):
        more = length > k
        code[more] = (code[more] << _U(8)) | buf[lead[more] + k]
    # every word is framed by one boundary mark on each side
    a, b = np.searchsorted(lead, starts), np.searchsorted(lead, ends)
    size = b - a + 2
    at = np.cumsum(size) - size
    chars = np.zeros(int(size.sum()), np.uint64)
    within = np.ones(len(chars), bool)
    within[at] = within[at + size - 1] = False
    take = np.repeat(a - at - 1, size) + np.arange(len(chars))
    chars[within] = code[take[within]] + _U(1)
    owner = np.repeat(np.arange(len(starts)), size)
    stop = np.repeat(at + size, size)
    doc_of_word = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(first))
    out, docs = [(whole >> _U(64 - BITS)).astype(np.int32)], [doc_of_word]
    for lag in LAGS:                    # a word that the text said ``lag`` words ago
        same = np.flatnonzero((whole[lag:] == whole[:-lag]) & (doc_of_word[lag:] == doc_of_word[:-lag]))
        out.append(np.full(len(same), lag, np.int32))
        docs.append(doc_of_word[same])
    h = chars * _U(0x9E3779B97F4A7C15)
    idx = np.arange(len(chars))
    doc_of_char = doc_of_word[owner]
    for n in range(2, 6):
        h = h[:-1] * _U(0x100000001B3) + chars[n - 1:] * _U(0xD6E8FEB86659FD93) if len(h) > 1 else h[:0]
        if n >= 3 and len(h):
            ok = idx[:len(h)] + n <= stop[:len(h)]
            out.append((mix(h[ok] + _U(n)) >> _U(64 - BITS)).astype(np.int32))
            docs.append(doc_of_char[:len(h)][ok])
    return np.concatenate(out), np.concatenate(docs)


def train(texts: list[str | None], labels: list[int], dim: int = DIM, epochs: int = 6, rate: float = 0.5,
          seed: int = 7) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent; returns (one number per bucket, bias)."""
    y = np.asarray(labels, np.int64)
    share = float(y.mean()) if len(y) else 0.5
    if len(set(labels)) < 2:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    emb = (rng.random((BUCKETS, dim), np.float32) - 0.5) / dim
    out = (rng.random((2, dim), np.float32) - 0.5)
    bias = np.log(np.array([1 - share, share], np.float32))
    docs = []
    for t in texts:
        buf, offs = text_buffer(pa.array([t], pa.string()))
        got, n = np.unique(features(buf, offs)[0], return_counts=True)
        docs.append((got, (n / max(1, n.sum())).astype(np.float32)))
    steps = epochs * len(docs)
    for step in range(steps):
        if step % len(docs) == 0:
            order = rng.permutation(len(docs))
        k = order[step % len(docs)]
        idx, w = docs[k]
        lr = rate * (1 - step / steps)
        hidden = w @ emb[idx]
        z = out @ hidden + bias
        p = np.exp(z - z.max())
        err = p / p.sum()
        err[y[k]] -= 1
        grad = err @ out
        out -= lr * err[:, None] * hidden
        bias -= 0.1 * lr * err
        # a feature's step is scaled by its share, times the number of features:
        # the mean would otherwise hide single features of long texts
        emb[idx] -= (lr * min(len(idx), 200)) * w[:, None] * grad
    return (emb @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, float]:
    """Train on at most ``train_rows`` labelled documents outside the held-out fold."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
        .filter("doc_id is not null and label in (0, 1)").filter(remove_id() % 4 != 2) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id")          # at most train_rows rows of two numbers
    got = sorted(((r.doc_id, r.text or "", r.label) for r in rows.toLocalIterator()))
    return train([t for _, t, _ in got], [y for _, _, y in got])


def scores(idx: np.ndarray, doc: np.ndarray, n_docs: int, weights: np.ndarray, bias: float) -> np.ndarray:
    n = np.bincount(doc, minlength=n_docs)
    mean = np.bincount(doc, weights[idx], minlength=n_docs) / np.maximum(n, 1)
    return 1 / (1 + np.exp(-(mean + bias)))


def _score(weights: np.ndarray, bias: float, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches, text_col, max_bytes=1 << 17):
            score = scores(*features(buf, offs), rows.num_rows, weights, bias)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(score, pa.float64())],
                                             names=[*rows.schema.names, "score"])
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (which replaces a column of that name)."""
    rows = docs.drop("score")
    schema = rows.select("*", F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(_score(*model, text_col), schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; learn from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", (remove_id() % 4 == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
