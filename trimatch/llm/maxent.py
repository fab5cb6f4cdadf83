"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | context) = P(class | context) * P(word | class, context).  Both
factors are softmaxes whose logits sum one weight row for each hashed context
feature: two n-gram features (previous word, previous two) and two skip
features (the word before the previous, and the one before that).  The first
goes over ``CLASSES`` classes.  The second goes down a tree of the class's
words, a softmax over at most ``BRANCHES`` branches at each node, whose weight
rows are hashed from the feature and the node; a branch starts from its share
of the node's training tokens.  The trees are Huffman trees, so that a token
takes few steps.  The words beyond the ``KNOWN`` most frequent share one leaf
of their class, inside which a word has its relative frequency.  A share of
each class (its share of words seen once) is kept for unknown words, so the
probabilities of all known words and "unknown" sum to one.

Classes: the end, the most frequent words (one class each), and the other
words by their ending.

Training: rounds of distributed gradient updates of both factors.  Every task
runs minibatch gradient steps over its own share of the training tokens; the row-wise
changes are averaged over tasks, weighted by how often each touched the row,
in two levels.  Model size depends on parameters alone.

Counts of the most frequent words (``KNOWN`` at most) go to the tasks as a
sorted table.  All rarer words are resolved exactly by a join on the word's
64-bit hash: the scoring pass emits, for each document and rare word, what
the word adds if it is known and if it is not.

Edge cases: null or empty text is the end token alone; a null doc_id trains
(it has no remainder), is not held out and keeps its null id; rows that share
a doc_id are scored as one document (their sums); an empty table gives no
rows; without training rows every token is unknown; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower, mix, remove_id, row_places, staged, table, text_blocks, word_hashes, words

SINGLES = 23
ENDINGS = 40
CLASSES = 1 + SINGLES + ENDINGS
FEATURES = 4
ROWS = 1 << 12                  # weight rows of each feature, for classes
BRANCHES = 16                   # of a node of a class's word tree
WORD_FEATURES = (0, 2)          # the previous word and the one before it
WORD_ROWS = FEATURES * ROWS * CLASSES // BRANCHES // len(WORD_FEATURES)
KNOWN = 1 << 18
ROUNDS = 2
MINIBATCH = 8192
SLICE = 1024                    # tokens in one softmax: stays in the processor's cache
TRAINER_TOKENS = 8_000_000
LONG_RUN = 32
SHARES = CLASSES // BRANCHES
CHUNK = 256                     # weight rows in one record of the exchange
BLOCK = 1 << 20
_U = np.uint64
END_HASH = _U(0x5BD1E9955BD1E995)
START_HASH = _U(0x1B873593CC9E2D51)
#: Ending class by a word's last byte and the one before it.
_ENDING = ((np.arange(256)[:, None] * 131 + np.arange(256)) * 2654435761 >> 7).reshape(-1) % ENDINGS


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with each document's end token, the ending class of each
    (-1: end), the document of each, and each document's first token."""
    buf = lower(buf)
    starts, ends, first = words(buf, offs)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n + 1)
    last = np.cumsum(n + 1) - 1
    h = np.empty(len(doc), np.uint64)
    ending = np.full(len(doc), -1, np.int64)
    is_word = np.ones(len(doc), bool)
    is_word[last] = False
    h[last] = END_HASH
    h[is_word] = word_hashes(buf, starts, ends)
    if len(starts):
        two = np.where(ends - starts > 1, np.take(buf, ends - 2, mode="clip"), 0)
        ending[is_word] = np.take(_ENDING, np.take(buf, ends - 1).astype(np.int64) << 8 | two)
    return h, ending, doc, np.concatenate([[0], last + 1])


def context_keys(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hash of each feature at each token: (FEATURES, n)."""
    back = []
    for lag in (1, 2, 3):
        b = np.full(len(h), START_HASH)
        if len(h) > lag:
            b[lag:] = np.where(doc[lag:] == doc[:-lag], h[:-lag], START_HASH)
        back.append(b)
    p1, p2, p3 = back
    return np.stack([mix(k) for k in (p1, p1 * _U(0x9E3779B97F4A7C15) + p2, p2 + _U(1), p3 + _U(2))])


def _rows(keys: np.ndarray, size: int) -> np.ndarray:
    shift = _U(64 - (size.bit_length() - 1))
    rows = (keys >> shift).view(np.int64)
    rows += np.arange(len(keys))[:, None] * size
    return rows


def class_rows(keys: np.ndarray) -> np.ndarray:
    """Class weight row of each feature."""
    return _rows(keys, ROWS)


def word_rows(keys: np.ndarray, token: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Word weight row of each feature for tokens at nodes."""
    at = np.stack([np.take(keys[f], token) for f in WORD_FEATURES])
    at += node.astype(np.uint64) * _U(0xD6E8FEB86659FD93)
    at *= _U(0x9E3779B97F4A7C15)
    return _rows(at, WORD_ROWS)


def context(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Class weight row of each feature at each token: (FEATURES, n)."""
    return class_rows(context_keys(h, doc))


@dataclass
class Vocabulary:
    """The bounded part of the counts, and sums over all of them."""
    known: np.ndarray       # hashes of the most frequent words, sorted
    count: np.ndarray
    single: np.ndarray      # class of a known word that has one of its own, else 0
    total: int              # training tokens
    distinct: int
    mass: np.ndarray        # training tokens of each class
    once: np.ndarray        # words seen once in each class
    rest: np.ndarray        # training tokens of each class that are no known word
    up: np.ndarray          # node above each known word, each class's rest and each node, else -1
    branch: np.ndarray      # branch of that node
    node_bias: np.ndarray   # log share of each branch: (nodes, BRANCHES)

    @property
    def norm(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position among the known words (clipped), and whether it is there."""
        if not len(self.known):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        shift, first = self._first
        last = len(self.known) - 1
        at = first[(h >> shift).astype(np.int64)]
        below = np.flatnonzero((self.known[at] < h) & (at < last))
        while len(below):
            at[below] += 1
            a = at[below]
            below = below[(self.known[a] < h[below]) & (a < last)]
        return at, self.known[at] == h

    @cached_property
    def _first(self) -> tuple[np.uint64, np.ndarray]:
        """First known word (clipped) at or above each value of the top bits."""
        bits = len(self.known).bit_length()
        shift = _U(64 - bits)
        n = np.bincount((self.known >> shift).astype(np.int64), minlength=1 << bits)
        return shift, np.minimum(np.cumsum(n) - n, len(self.known) - 1).astype(np.int32)

    def classes(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, there = self.look(h)
        cls = np.where(ending < 0, 0, 1 + SINGLES + ending)
        own = self.single[at] if len(self.single) else np.zeros(len(h), np.int8)
        cls = np.where(there & (own > 0), own, cls)
        return cls, at, there

    def without_words(self) -> Vocabulary:
        """What the classes need: only words of a class of their own are known."""
        own = self.single > 0
        return replace(self, known=self.known[own], count=self.count[own], single=self.single[own], up=self.up[:0],
                       branch=self.branch[:0], node_bias=self.node_bias[:0])

    def leaves(self, cls: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, at, len(self.known) + cls)

    def steps(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All steps from leaves up to their class: token, node and branch taken."""
        token, found = np.arange(len(leaf)), []
        while len(leaf):
            node = np.take(self.up, leaf)
            on = np.flatnonzero(node >= 0)
            token, node, leaf = np.take(token, on), np.take(node, on), np.take(leaf, on)
            found.append((token, node, np.take(self.branch, leaf)))
            leaf = node + (len(self.known) + CLASSES)
        none = np.zeros(0, np.int64)
        token, node, taken = map(np.concatenate, zip(*found)) if found else (none, none, none)
        return token, node, taken

    @property
    def unknown(self) -> np.ndarray:
        share = (self.once + 0.5) / (self.mass + 1)
        share[:1 + SINGLES] = 0
        return np.minimum(share, 0.99)

    @property
    def bias(self) -> np.ndarray:
        return np.log((self.mass + 0.5) / (self.mass.sum() + 0.5 * CLASSES)).astype(np.float32)


_ONES = np.ones(CLASSES, np.float32)
# 2**f for f within +-0.5, to 1e-4
_CUBIC = tuple(map(np.float32, (0.05583828, 0.24263948, 0.69313673, 0.99992456)))
_LOG2E, _WHOLE = np.float32(np.log2(np.e)), np.float32(3 << 22)


def _exp(z: np.ndarray, part: np.ndarray) -> None:
    """exp(z) in place to 2e-4, for z within +-80: 2**whole by the bits of
    the float, 2**fraction by a cubic.  ``part`` is overwritten."""
    z *= _LOG2E
    np.add(z, _WHOLE, out=part)                 # its low bits: the whole part
    whole = part.view(np.int32) << 23
    part -= _WHOLE
    z -= part
    np.multiply(z, _CUBIC[0], out=part)
    for c in _CUBIC[1:3]:
        part += c
        part *= z
    np.add(part, _CUBIC[3], out=z)
    bits = z.view(np.int32)
    bits += whole


def softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, out: np.ndarray | None = None,
            part: np.ndarray | None = None) -> np.ndarray:
    """Class (or branch) probabilities for each column of ``rows``; logits are
    held within +-80, where their exponentials and the sum stay in range."""
    z = np.take(weights, rows[0], axis=0, out=out, mode="clip")
    part = np.empty_like(z) if part is None else part
    for r in rows[1:]:
        z += np.take(weights, r, axis=0, out=part, mode="clip")
    z += bias
    np.clip(z, -80, 80, out=z)
    _exp(z, part)
    z *= (1 / (z @ _ONES[:z.shape[1]]))[:, None]
    return z


def products(factors: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the exponentials of fixed weights and bias, as products
    and their sums; weights are held within +-16 (``exponentials``)."""
    z = np.take(factors, rows[0], axis=0, mode="clip")
    part = np.empty_like(z)
    for r in rows[1:]:
        z *= np.take(factors, r, axis=0, out=part, mode="clip")
    z *= bias
    return z, z @ _ONES[:z.shape[1]]


def exponentials(weights: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(weights, -16, 16))


def two_tables(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Views of the class and the word weights."""
    return weights[:FEATURES * ROWS], weights[FEATURES * ROWS:].reshape(-1, BRANCHES)


# --- counts ------------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        h = np.concatenate([x[0] for x in held])
        e = np.concatenate([x[1] for x in held])
        n = np.concatenate([x[2] for x in held])
        held.clear()
        got, at, inv = np.unique(h, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)), pa.array(e[at].astype(np.int32)),
                                           pa.array(np.bincount(inv, n).astype(np.int64))], names=["wh", "ending", "n"])

    for _, buf, offs in text_blocks(batches, max_bytes=BLOCK):
        h, ending, _, _ = tokens(buf, offs)
        got, at, n = np.unique(h, return_index=True, return_counts=True)
        held.append((got, ending[at], n))
        size += len(got)
        if size > 1_500_000:
            yield flush()
            size = 0
    if held:
        yield flush()


def count_words(train: DataFrame) -> DataFrame:
    """wh, ending, c: every training token's count."""
    return train.select("text").mapInArrow(_count, "wh long, ending int, n long") \
        .groupBy("wh").agg(F.first("ending").alias("ending"), F.sum("n").alias("c"))


def word_trees(cls: np.ndarray, count: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``up``, ``branch`` and ``node_bias`` of the Huffman trees, of BRANCHES
    branches a node, over each class's known words and its rest."""
    known, shares = len(cls), []
    up, branch = [-1] * (known + CLASSES), [0] * (known + CLASSES)
    order = np.argsort(cls, kind="stable")
    ends = np.cumsum(np.bincount(cls, minlength=CLASSES))
    for k in range(CLASSES):
        mine = order[ends[k - 1] if k else 0:ends[k]]
        heap = list(zip(count[mine].tolist(), mine.tolist()))
        if rest[k] > 0:
            heap.append((int(rest[k]), known + k))
        heapify(heap)
        take = (len(heap) - 2) % (BRANCHES - 1) + 2     # so that all other nodes are full
        while len(heap) > 1:
            below = [heappop(heap) for _ in range(take)]
            for b, (_, x) in enumerate(below):
                up[x], branch[x] = len(shares), b
            shares.append([n for n, _ in below] + [0] * (BRANCHES - take))
            heappush(heap, (sum(shares[-1]), len(up)))
            up.append(-1)
            branch.append(0)
            take = BRANCHES
    n = np.array(shares, np.float64).reshape(-1, BRANCHES)
    bias = np.full(n.shape, -1e30)
    np.log(n / n.sum(axis=1, keepdims=True), out=bias, where=n > 0)
    return np.array(up, np.int32), np.array(branch, np.int8), bias.astype(np.float32)


def vocabulary(counts: DataFrame, known: int = KNOWN) -> Vocabulary:
    by_ending = counts.groupBy("ending").agg(
        F.sum("c").alias("c"), F.count("*").alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()
    # the frequent words by a threshold from a histogram of counts (of bounded
    # size: exact below 4096, sixteen steps to a doubling above), not by a sort
    step = F.least("c", F.lit(4096)) + F.floor(16 * F.log2(F.greatest("c", F.lit(4096)) / 4096))
    room, cut = known, 1 << 40
    for b in sorted(counts.groupBy(step.alias("b")).count().collect(), key=lambda b: -b.b):
        room -= b["count"]
        if room < 0:
            break
        cut = b.b
    top = counts.filter(step >= cut).select("wh", "ending", "c").toArrow()
    wh = top.column("wh").to_numpy().astype(np.int64).view(np.uint64)
    c, ending = top.column("c").to_numpy().astype(np.int64), top.column("ending").to_numpy()
    order = np.lexsort((wh, -c))
    wh, c, ending = wh[order], c[order], ending[order]
    mass, once = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_ending:
        k = 0 if r.ending < 0 else 1 + SINGLES + r.ending
        mass[k], once[k] = r.c, r.once
    single = np.zeros(len(wh), np.int8)
    chosen = [i for i in range(min(len(wh), SINGLES + 1)) if ending[i] >= 0][:SINGLES]
    for k, i in enumerate(chosen, 1):
        single[i] = k
        mass[k] = c[i]
        mass[1 + SINGLES + ending[i]] -= c[i]
        once[1 + SINGLES + ending[i]] -= c[i] == 1
    order = np.argsort(wh)
    wh, c, single, ending = wh[order], c[order], single[order], ending[order].astype(np.int64)
    cls = np.where(single > 0, single, np.where(ending < 0, 0, 1 + SINGLES + ending))
    rest = mass - np.bincount(cls, c, CLASSES)
    return Vocabulary(wh, c, single, sum(r.c for r in by_ending), sum(r.v for r in by_ending), mass, once,
                      rest, *word_trees(cls, c, rest))


# --- training ----------------------------------------------------------------

class Room:
    """Arrays that are used again for every minibatch."""

    def __init__(self, width: int) -> None:
        self.width, self.held = width, {}
        self.some = SLICE * CLASSES // width        # rows that stay in the processor's cache

    def get(self, name: str, n: int) -> np.ndarray:
        if name not in self.held or len(self.held[name]) < n:
            self.held[name] = np.empty((n + n // 4, self.width), np.float32)
        return self.held[name][:n]


def _sum_runs(rows: np.ndarray, order: np.ndarray, begin: np.ndarray, count: np.ndarray, room: Room) -> np.ndarray:
    """Sum of the rows of each run of ``order``: all runs at once, one more
    row a step; what a run has beyond ``LONG_RUN`` by itself.  Runs are in
    falling order of ``count`` (in any order above ``LONG_RUN``)."""
    out = np.take(rows, order[begin], axis=0, mode="clip", out=room.get("sum", len(begin)))
    part = room.get("part", len(begin))
    more = np.cumsum(np.bincount(np.minimum(count, LONG_RUN), minlength=LONG_RUN + 1)[::-1])[::-1]
    for step, m in enumerate(more[2:].tolist(), 1):     # m: runs of more than ``step`` rows
        if not m:
            break
        out[:m] += np.take(rows, order[begin[:m] + step], axis=0, out=part[:m], mode="clip")
    for k in np.flatnonzero(count[:more[LONG_RUN]] > LONG_RUN).tolist():
        beyond = np.take(rows, order[begin[k] + LONG_RUN:begin[k] + count[k]], axis=0, mode="clip")
        out[k] += np.ones(len(beyond), np.float32) @ beyond
    return out


def descend(weights: np.ndarray, visits: np.ndarray, bias: np.ndarray, rows: np.ndarray, y: np.ndarray, rate: float,
            room: Room) -> None:
    """One gradient step on a minibatch; ``weights`` change in place.
    ``bias``: one for all, or one for each column of ``rows``."""
    width = weights.shape[1]
    err = room.get("err", len(y))
    for k in range(0, len(y), room.some):
        s = slice(k, k + room.some)
        softmax(weights, bias if bias.ndim == 1 else bias[s], rows[:, s], err[s], room.get("part", len(y[s])))
    err.reshape(-1)[np.arange(0, err.size, width) + y] -= 1
    whole = weights.view(f"V{weights.itemsize * width}")[:, 0]     # a row as one value: set faster
    f = rows.reshape(-1).astype(np.uint16)         # at most 65536 rows
    order = np.argsort(f, kind="stable")
    f = np.take(f, order)
    order = np.take(np.tile(np.arange(len(y)), len(rows)), order)
    begin = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
    cnt = np.diff(np.append(begin, len(f)))
    longest = np.argsort((LONG_RUN - np.minimum(cnt, LONG_RUN)).astype(np.uint8), kind="stable")
    begin, cnt = begin[longest], cnt[longest]
    u = f[begin].astype(np.int64)
    g = _sum_runs(err, order, begin, cnt, room)
    seen = visits[u] + cnt
    visits[u] = seen
    g *= (rate / np.sqrt(cnt * (1 + seen / 64.0))).astype(np.float32)[:, None]
    new = np.take(weights, u, axis=0, mode="clip", out=room.get("part", len(u)))
    new -= g
    whole[u] = new.view(whole.dtype)[:, 0]


def train_block(weights: np.ndarray, visits: tuple[np.ndarray, np.ndarray], vocab: Vocabulary, keys: np.ndarray,
                cls: np.ndarray, leaf: np.ndarray | None, rate: float, rooms: tuple[Room, Room]) -> None:
    """Minibatch gradient steps over one block, for classes and (with
    ``leaf``) words."""
    by_class, by_word = two_tables(weights)
    for at in range(0, len(cls), MINIBATCH):
        k = keys[:, at:at + MINIBATCH]
        descend(by_class, visits[0], vocab.bias, class_rows(k), cls[at:at + MINIBATCH], rate, rooms[0])
        if leaf is None:
            continue
        token, node, taken = vocab.steps(leaf[at:at + MINIBATCH])
        if len(token):
            descend(by_word, visits[1], np.take(vocab.node_bias, node, axis=0), word_rows(k, token, node), taken, rate, rooms[1])


def _train(vocab: Vocabulary, weights: np.ndarray, rate: float, fan: int, with_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        mine = weights.copy()
        visits = tuple(np.zeros(len(t)) for t in two_tables(mine))
        rooms = (Room(CLASSES), Room(BRANCHES))
        for _, buf, offs in text_blocks(batches, max_bytes=BLOCK):
            h, ending, doc, _ = tokens(buf, offs)
            cls, at, there = vocab.classes(h, ending)
            leaf = vocab.leaves(cls, at, there) if with_words else None
            train_block(mine, visits, vocab, context_keys(h, doc), cls, leaf, rate, rooms)
        # visits of BRANCHES weights each
        seen = np.concatenate([np.repeat(visits[0], SHARES), visits[1]]).reshape(-1, SHARES)
        group = TaskContext.get().partitionId() % fan
        for k in range(0, len(mine), CHUNK):
            n = seen[k:k + CHUNK]
            if n.any():
                change = (mine[k:k + CHUNK] - weights[k:k + CHUNK]) * np.repeat(n, BRANCHES, axis=1)
                yield _sum_row(k, group, np.concatenate([change, n], axis=1))
    return run


def _sum_row(chunk: int, group: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([group], pa.int32()),
                                       pa.array([values.astype("<f4").tobytes()], pa.binary())], names=["chunk", "grp", "v"])


def _add_up(part: pa.Table) -> pa.Table:
    total = np.zeros((CHUNK, CLASSES + SHARES))
    for v in part.column("v").to_pylist():
        total += np.frombuffer(v, "<f4").reshape(CHUNK, CLASSES + SHARES)
    return pa.Table.from_batches([_sum_row(part.column("chunk")[0].as_py(), 0, total)])


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, rate: float = 0.3) -> np.ndarray:
    """Weights after ``rounds`` passes over all training tokens: the class
    rows, then the word rows, ``SHARES`` of them in one (``two_tables``).  The
    word rows learn in the first round, which brings nearly all they gain."""
    spark = docs.sparkSession
    weights = np.zeros((2 * FEATURES * ROWS, CLASSES), np.float32)
    text = docs.select("text")
    n = text.rdd.getNumPartitions()
    trainers = max(1, min(n, max(spark.sparkContext.defaultParallelism, vocab.total // TRAINER_TOKENS)))
    fan = max(1, int(trainers ** 0.5))
    kind = "chunk int, grp int, v binary"
    for k in range(rounds):
        known = vocab if k == 0 else vocab.without_words()
        sums = text.coalesce(trainers).mapInArrow(_train(known, weights, rate / (k + 1), fan, k == 0), kind) \
            .groupBy("chunk", "grp").applyInArrow(_add_up, kind) \
            .groupBy("chunk").applyInArrow(_add_up, kind)
        weights = weights.copy()
        for r in sums.toLocalIterator():            # 2 * FEATURES * ROWS / CHUNK records of a fixed size
            v = np.frombuffer(r.v, "<f4").reshape(CHUNK, CLASSES + SHARES)
            weights[r.chunk:r.chunk + CHUNK] += v[:, :CLASSES] / np.repeat(np.maximum(v[:, CLASSES:], 1), BRANCHES, axis=1)
    return weights


# --- scoring -----------------------------------------------------------------

_PIECE = "row_f long, row_i long, doc_id long, wh long, cls int, n long, known long, base double, a double, u double"


def _score(vocab: Vocabulary, weights: np.ndarray):
    bias, unknown = np.exp(vocab.bias), vocab.unknown
    keep, share = np.log10(1 - unknown), unknown.astype(np.float32)
    log_rest = np.log10(np.maximum(vocab.rest, 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_of = np.log10((vocab.count + 0.5) / vocab.norm)
        by_class, by_word = map(exponentials, two_tables(weights))
        node_bias = np.exp(vocab.node_bias)
        for rows, buf, offs in text_blocks(batches, max_bytes=BLOCK):
            h, ending, doc, _ = tokens(buf, offs)
            cls, at, there = vocab.classes(h, ending)
            keys, leaf = context_keys(h, doc), vocab.leaves(cls, at, there)
            a, u = np.empty(len(h)), np.empty(len(h))
            for i in range(0, len(h), 2 * SLICE):
                s = slice(i, i + 2 * SLICE)
                p, total = products(by_class, bias, class_rows(keys[:, s]))
                own = p[np.arange(len(p)), cls[s]] / total
                u[s] = p @ share / total
                token, node, taken = vocab.steps(leaf[s])
                p, total = products(by_word, np.take(node_bias, node, axis=0), word_rows(keys[:, s], token, node))
                p = p[np.arange(len(p)), taken] / total
                a[s] = np.log10(np.maximum(own, 1e-30)) + np.bincount(token, np.log10(np.maximum(p, 1e-30)), len(own))
            a += keep[cls]
            a -= np.where(there, 0, log_rest[cls])
            n = len(offs) - 1
            # documents: all that the known words add
            k, kd = at[there], doc[there]
            own = pa.RecordBatch.from_arrays([
                rows.column("row_f"), rows.column("row_i"), rows.column("doc_id"), pa.array(mix(np.arange(n).astype(np.uint64) + h[:1]).view(np.int64) if n else []),
                pa.array(np.full(n, -1, np.int32)), pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.bincount(kd, minlength=n)), pa.array(np.bincount(kd, base_of[k] if len(k) else None, n).astype(float)),
                pa.array(np.bincount(kd, a[there] if len(k) else None, n).astype(float)),
                pa.array(np.zeros(n))], names=[f.split()[0] for f in _PIECE.split(", ")])
            yield own
            # rare words: one row for each document and word
            rare = np.flatnonzero(~there)
            if len(rare):
                rare = rare[np.lexsort((h[rare], doc[rare]))]
                rh, rd = h[rare], doc[rare]
                begin = np.flatnonzero(np.concatenate([[True], (rh[1:] != rh[:-1]) | (rd[1:] != rd[:-1])]))
                m = np.diff(np.append(begin, len(rare)))
                zero = pa.array(np.zeros(len(begin)))
                place = pa.array(rd[begin])
                yield pa.RecordBatch.from_arrays([
                    rows.column("row_f").take(place), rows.column("row_i").take(place), pa.nulls(len(begin), pa.int64()), pa.array(rh[begin].view(np.int64)),
                    pa.array(cls[rare][begin].astype(np.int32)), pa.array(m), pa.array(np.zeros(len(begin), np.int64)), zero,
                    pa.array(np.add.reduceat(a[rare], begin)), pa.array(np.add.reduceat(np.log10(np.maximum(u[rare], 1e-30)), begin))], names=own.schema.names)
    return run


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, weights: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (both log10) of every row
    of ``docs``, which are told apart by ``row_f`` and ``row_i``."""
    pieces = docs.mapInArrow(_score(vocab, weights), _PIECE)
    rare = counts.select(F.col("wh").alias("w"), "c")
    found = pieces.join(rare, (pieces.wh == rare.w) & (pieces.cls >= 0), "left")
    own, known = F.col("cls") < 0, F.col("c").isNotNull()
    n, c = F.col("n"), F.coalesce("c", F.lit(0))
    base = F.when(own, F.col("base")).otherwise(n * F.log10((c + 0.5) / F.lit(vocab.norm)))
    model = F.when(own, F.col("a")).when(known, F.col("a") + n * F.log10("c")).otherwise(F.col("u"))
    return found.groupBy("row_f", "row_i").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum(F.when(own, n).otherwise(0)).alias("n_tokens"),
        F.sum(F.when(own, F.col("known")).when(known, n).otherwise(0)).alias("n_known"),
        F.sum(base).alias("base_score"), F.sum(model).alias("score"))


def model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_read: bool = False) -> DataFrame:
    """Learn from the rows outside the held-out fold and score all rows, also
    those that repeat an id or have none.  ``as_read``: ``docs`` is a Parquet
    table as it was read, and needs no written copy."""
    rows = row_places(docs, id_col, text_col, as_read=as_read).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), "row_f", "row_i")
    held = F.coalesce(remove_id() % 5 == 1, F.lit(False))
    learn = rows.filter(~held).select("doc_id", "text")
    counts = staged(count_words(learn), "lm-counts")
    vocab = vocabulary(counts)
    weights = train(learn, vocab)
    return score(rows, counts, vocab, weights).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(vocab.total).cast("long").alias("train_tokens"),
        "base_score", "score")


def op6_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the whole documents table."""
    return model_scores(table(spark, sf_dir, "documents"), as_read=True)
