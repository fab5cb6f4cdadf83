"""Near duplicates by a chosen-path set similarity join.

A document is the set of its distinct word shingles, 64-bit hashed.  Equal
sets are one class and only its smallest id goes on.  ``TOKENS`` minwise
tokens stand for a set; in each of ``TREES`` independent trees a set starts
at the root and, at every node, follows the minwise tokens that the node
selects (one, or two with probability 1/threshold - 1, so that a pair at the
threshold keeps one common path on average).  Sets on the same path share a
node.  Nodes of at most ``NODE`` sets are compared exhaustively on the full
sets; larger ones branch further, in rounds.  Several trees bring recall up: a
pair at 0.85 shares a node of depth 4 with probability 0.64 in one tree,
0.9993 in eight, 0.9997 in ten.  Deeper nodes and lower thresholds need more
trees for that (``trees_for``), and the sets of a node that branches further
start in so many more: 15 in all at depth 7, 95 at depth 22.

Nodes with the same members are compared once.  A node gives only the links
that tie its verified components together, so a group of thousands of near
copies gives thousands of links, and components follow by alternating
large-star and small-star steps on tables.

Before a node over ``NODE`` branches, it is tied: cut into cells, each of
which is compared together with the node's most central set (the one whose
shingles are the most common in the node), so that the copies of one text fall
into one component.  If that leaves at most ``NODE`` other sets, the node ends
here: it is cut into blocks, and every pair of blocks is compared but for those
whose sets are all in one component, which grows with the node and not with its
square.  Other nodes branch, so near copies don't multiply paths.  A node that
still exceeds ``NODE`` after ``ROUNDS`` rounds ends in the same way: no pair is
left out.

Edge cases: null and empty texts have an empty set and no links; a text of
fewer words than a shingle is one shingle; a null doc_id is reported and
linked with nothing (component null, kept); rows that repeat a doc_id are
each reported; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_starts, grams, lower, mix, row_slices, staged, table, text_blocks, text_buffer, union_all, word_hashes, words

TOKENS = 128
TREES = 8
RECALL = 0.9997
DEPTH = 4
DEEPER = 3
ROUNDS = 6
PATHS = 500_000     # held by a task at a time
NODE = 1024
_U = np.uint64
_MULT = mix(np.arange(1, TOKENS + 1).astype(np.uint64)) | _U(1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document of a block, sorted, and the bounds."""
    buf = lower(buf)
    starts, ends, first = words(buf, offs)
    h, n = word_hashes(buf, starts, ends), np.diff(first)
    at = gram_starts(first, k)
    values, docs = [grams(h, k)[at] if len(at) else h[:0]], [np.repeat(np.arange(len(n)), np.maximum(n - k + 1, 0))]
    for short in range(1, k):           # whole texts of fewer words
        d = np.flatnonzero(n == short)
        if len(d):
            values.append(mix(grams(h, short)[first[d]] + _U(short)))
            docs.append(d)
    v, d = np.concatenate(values), np.concatenate(docs)
    order = np.lexsort((v, d))
    v, d = v[order], d[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return v[keep], np.searchsorted(d[keep], np.arange(len(n) + 1))


def minwise(v: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(documents, TOKENS) 32-bit minwise tokens; zeros for empty sets."""
    out = np.zeros((len(bounds) - 1, TOKENS), np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        at = bounds[some]
        for i in range(TOKENS):
            out[some, i] = (np.minimum.reduceat(v * _MULT[i], at) >> _U(32)).astype(np.uint32)
    return out


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches, max_bytes=1 << 19):
            v, bounds = shingle_sets(buf, offs, k)
            n = np.diff(bounds)
            empty = n == 0
            one = np.concatenate([[0], np.cumsum(v, dtype=np.uint64)])
            two = np.concatenate([[0], np.cumsum(mix(v ^ _U(0x9E3779B97F4A7C15)), dtype=np.uint64)])
            keys = [pa.array((x[bounds[1:]] - x[bounds[:-1]]).astype(np.uint64).view(np.int64), mask=empty) for x in (one.astype(np.uint64), two.astype(np.uint64))]
            sig = minwise(v, bounds)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n), *keys,
                                              pa.array([s.tobytes() for s in sig], pa.binary())],
                                             names=["doc_id", "n_shingles", "k1", "k2", "sig"])
    return run


def grow(paths: np.ndarray, sets: np.ndarray, sig: np.ndarray, second: float, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Follow the selected tokens ``levels`` further: new paths and their sets."""
    cut = _U(int(second * (1 << 32)))
    for level in range(levels):
        pick = mix(paths + _U(level + 1))
        also = (mix(pick) >> _U(32)) < cut
        one = (pick >> _U(20)) % _U(TOKENS)
        other = (one + _U(1) + (pick >> _U(40)) % _U(TOKENS - 1)) % _U(TOKENS)
        p = np.concatenate([paths, paths[also]])
        s = np.concatenate([sets, sets[also]])
        coord = np.concatenate([one, other[also]])
        paths = mix(p * _U(0xD6E8FEB86659FD93) + sig[s, coord.astype(np.int64)] + (coord << _U(32)))
        sets = s
    return paths, sets


def shared(percent: int, depth: int, trees: int) -> float:
    """Probability that a pair at the threshold shares a node of ``depth`` in
    one of the trees.  Its common paths are a branching process: each goes on
    by one token, or two.  All trees draw on the same tokens, of which the pair
    agrees in more or fewer by chance."""
    same = np.arange(TOKENS + 1) / TOKENS
    second, lost = min(1.0, 100 / percent - 1), np.zeros(TOKENS + 1)
    for _ in range(depth):
        on = 1 - same + same * lost
        lost = on * (1 - second + second * on)
    p = percent / 100
    chance = np.array([comb(TOKENS, m) * p ** m * (1 - p) ** (TOKENS - m) for m in range(TOKENS + 1)])
    return 1 - float(chance @ lost ** trees)


def trees_for(percent: int, depth: int) -> int:
    """Trees that nodes of ``depth`` need for ``RECALL`` at the threshold."""
    trees = 1
    while shared(percent, depth, trees) < RECALL:
        trees += 1
    return trees


def _paths(second: float, levels: int, trees: int, first: int = 0):
    """Paths ``levels`` further; without a path, from the roots of the trees
    after ``first`` up to ``trees``."""
    size = int(PATHS / (1 + second) ** levels / max(1, trees - first)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_slices(batches, size):
            n = b.num_rows
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(n, TOKENS)
            if "path" in b.schema.names:
                paths, sets = b.column("path").to_numpy().view(np.uint64), np.arange(n)
            else:
                paths = np.repeat(mix(np.arange(first + 1, trees + 1).astype(np.uint64)), n)
                sets = np.tile(np.arange(n), trees - first)
            paths, sets = grow(paths, sets, sig, second, levels)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), b.column("doc_id").take(pa.array(sets))],
                                             names=["path", "doc_id"])
    return run


# --- exhaustive comparison of a node ------------------------------------------

def _similar(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def node_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(id, smallest id of its verified component) for all but the smallest."""
    n = len(ids)
    label = np.arange(n)
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    if n > 12:      # bitmaps over the tokens that two sets share
        flat = np.concatenate(sets)
        _, inv, cnt = np.unique(flat, return_inverse=True, return_counts=True)
        common = cnt > 1
        number = np.cumsum(common) - 1
        row = np.repeat(np.arange(n), size)
        keep = common[inv]
        width = int(common.sum())
        bits = np.zeros((n, (width + 64) // 64), np.uint64)
        col = number[inv[keep]]
        np.bitwise_or.at(bits, (row[keep], col >> 6), _U(1) << (col & 63).astype(np.uint64))
    for pos, i in enumerate(order):
        rest = order[pos + 1:]
        rest = rest[(100 * size[i] >= percent * size[rest]) & (label[rest] != label[i])]
        if not len(rest):
            continue
        if n > 12:
            inter = np.concatenate([np.bitwise_count(bits[i] & bits[rest[k:k + 256]]).sum(axis=1, dtype=np.int64)
                                    for k in range(0, len(rest), 256)])
        else:
            inter = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in rest])
        for j in rest[_similar(inter, size[i], size[rest], percent)]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
    out = []
    for c in np.unique(label):
        members = ids[label == c]
        low = int(members.min())
        out += [(int(m), low) for m in members if m != low]
    return out


def _node_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, list[int], list[np.ndarray]]]:
    """(node, ids, shingle sets) of nodes that come one after the other."""
    unpack = zstandard.ZstdDecompressor()
    now, ids, texts = None, [], []

    def sets() -> list[np.ndarray]:
        buf, offs = text_buffer(pa.array([unpack.decompress(t) for t in texts], pa.binary()).cast(pa.string()))
        v, bounds = shingle_sets(buf, offs, k)
        return [v[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    for b in batches:
        for node, doc_id, z in zip(*(b.column(c).to_pylist() for c in ("node", "doc_id", "z")), strict=True):
            if node != now and now is not None:
                if len(ids) > 1:
                    yield now, ids, sets()
                ids, texts = [], []
            now = node
            ids.append(doc_id)
            texts.append(z)
    if len(ids) > 1:
        yield now, ids, sets()


def _compare(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, sets in _node_sets(batches, k):
            found = node_links(np.array(ids), sets, percent)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def _central(k: int):
    """Per node its most central set: the highest mean count of its shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, ids, sets in _node_sets(batches, k):
            size = np.array([len(s) for s in sets])
            _, inv, cnt = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            mean = np.add.reduceat(cnt[inv], np.cumsum(size) - size) / size / len(ids)
            best = max(range(len(ids)), key=lambda i: (mean[i], size[i], -ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([ids[best]], pa.int64()), pa.array([float(mean[best])])],
                                             names=["node", "doc_id", "mean"])
    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for b in row_slices(batches):
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(
            [pack.compress((t.as_py() or "").encode()) for t in b.column("text")], pa.binary())], names=["doc_id", "z"])


# --- components ---------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of every linked id, by large-star and small-star
    steps until nothing changes."""
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        big = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(low, "a")
        edges = staged(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .unionByName(low.select("a", F.col("m").alias("b")))
                       .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("component"))
        state = new


def block_pairs(rest: DataFrame, tied: DataFrame, node: int) -> DataFrame:
    """(node, doc_id) for the members (path, doc_id) of oversized nodes: one
    small node for each pair of blocks with sets that ``tied`` does not tie.
    A component of half a node or more has blocks of its own, the others share
    blocks."""
    half = max(1, node // 2)
    of = rest.join(tied, "doc_id", "left").select("path", "doc_id", F.coalesce("component", "doc_id").alias("c"))
    size = staged(of.groupBy("path", "c").agg(F.count("*").alias("m")), "sizes")
    pool = size.filter(F.col("m") < half).groupBy("path").agg(F.sum("m").alias("p"))
    spot = F.when(F.col("m") >= half, F.xxhash64("c", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("m") / half)))) \
        .otherwise(F.pmod(F.xxhash64("c"), F.ceil(F.col("p") / half)))
    block = staged(of.join(size, ["path", "c"]).join(pool, "path", "left").select(
        "path", "doc_id", F.when(F.col("m") >= half, F.col("c")).alias("own"), spot.alias("block")), "blocks")
    one = block.select("path", "own", "block").distinct()
    two = one.select("path", F.col("own").alias("own2"), F.col("block").alias("block2"))
    pairs = one.join(two, "path").filter((F.col("block") <= F.col("block2")) & ~F.coalesce(F.col("own") == F.col("own2"), F.lit(False)))
    named = pairs.select("path", F.xxhash64("path", "block", "block2").alias("node"), F.explode(F.array("block", "block2")).alias("block"))
    return block.join(named.distinct(), ["path", "block"]).select("node", "doc_id")


# --- join -----------------------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, trees: int = TREES, node: int = NODE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    second = 100 / percent - 1
    trees = max(trees, trees_for(percent, DEPTH))
    signed = staged(rows.mapInArrow(_sign(shingle), "doc_id long, n_shingles long, k1 long, k2 long, sig binary"), "signatures")
    classes = signed.filter("k1 is not null and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"))
    kind = "path long, doc_id long"
    paths = staged(classes.select("doc_id", "sig").mapInArrow(_paths(second, DEPTH, trees), kind), "paths")

    def nodes(p: DataFrame) -> DataFrame:
        return p.groupBy("path").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("x")).filter("n > 1")

    text = rows.filter("doc_id is not null").mapInArrow(_squeeze, "doc_id long, z binary")

    def dealt(members: DataFrame) -> DataFrame:
        """The texts of (node, doc_id), one node after the other."""
        wanted = members.groupBy("doc_id").agg(F.collect_set("node").alias("nodes"))    # a few nodes per tree and set
        return (text.join(wanted, "doc_id").select(F.explode("nodes").alias("node"), "doc_id", "z")
                .repartition("node").sortWithinPartitions("node", "doc_id"))

    def compared(members: DataFrame) -> DataFrame:
        return dealt(members).mapInArrow(_compare(shingle, percent), "a long, b long")

    def tied(rest: DataFrame) -> DataFrame:
        """Links inside the cells of oversized nodes (path, doc_id, n) and to
        their most central sets."""
        cells = F.ceil(F.col("n") / node).cast("int")
        cell = staged(rest.select("path", "doc_id", cells.alias("cells"), F.xxhash64("path", F.pmod(F.xxhash64("doc_id"), cells).cast("int")).alias("node")), "cells")
        hub = dealt(cell.select("node", "doc_id")).mapInArrow(_central(shingle), "node long, doc_id long, mean double")
        place = cell.select("path", "cells", "node").distinct()
        hub = hub.join(place, "node").groupBy("path").agg(F.max_by("doc_id", F.struct("mean", -F.col("doc_id"))).alias("doc_id"))
        lead = place.select("path", "node").join(hub, "path")
        return compared(cell.select("node", "doc_id").unionByName(lead.select("node", "doc_id")).distinct())

    small, links, over = [], [], []
    one_sig = classes.select("doc_id", "sig")
    for level in range(ROUNDS + 1):
        size = staged(nodes(paths.distinct()), "nodes")
        few = size.filter(F.col("n") <= node).groupBy("n", "x").agg(F.min("path").alias("path"))
        small.append(paths.distinct().join(few.select("path"), "path").withColumnRenamed("path", "node"))
        large = size.filter(F.col("n") > node)
        if large.isEmpty():
            break
        # of nodes with equal members one is tied, and all branch
        once = large.groupBy("n", "x").agg(F.min("path").alias("path"))
        rest = staged(paths.distinct().join(once, "path").select("path", "doc_id", "n"), "rest")
        links.append(staged(tied(rest), "ties"))
        of = rest.join(components(links[-1]), "doc_id", "left").groupBy("path", "n", F.coalesce("component", "doc_id").alias("c")).agg(F.count("*").alias("m"))
        most = of.groupBy("path", "n").agg(F.max("m").alias("m"))
        ends = most if level == ROUNDS else most.filter(F.col("n") - F.col("m") <= node)
        ends = staged(ends.select("path"), "ends")
        over.append(rest.join(ends, "path").select("path", "doc_id"))
        open_ = large.join(once.join(ends, "path").select("n", "x"), ["n", "x"], "left_anti").select("path")
        grown = staged(paths.distinct().join(open_, "path"), "grown")
        if grown.isEmpty():
            break
        # the other nodes grow on, and their sets in more trees, as the depth
        # asks for; the signature of each member comes along
        depth, first = DEPTH + DEEPER * (level + 1), trees
        trees = max(trees, trees_for(percent, depth))
        longer = grown.join(one_sig, "doc_id").mapInArrow(_paths(second, DEEPER, trees), kind)
        if trees > first:
            longer = longer.unionByName(grown.select("doc_id").distinct().join(one_sig, "doc_id")
                                        .mapInArrow(_paths(second, depth, trees, first), kind))
        paths = staged(longer, "paths")
    found = components(union_all([compared(union_all(small)), *links]))
    if over:
        more = compared(block_pairs(union_all(over), found, node))
        found = components(found.select(F.col("doc_id").alias("a"), F.col("component").alias("b")).unionByName(more))
    of_class = classes.select("k1", "k2", F.col("doc_id").alias("rep")).join(
        found.withColumnRenamed("doc_id", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    named = signed.select("doc_id", "n_shingles", "k1", "k2")
    with_set = named.filter("k1 is not null and doc_id is not null").join(of_class, ["k1", "k2"], "left")
    without = named.filter("k1 is null or doc_id is null").withColumn("component", F.col("doc_id"))
    return with_set.unionByName(without).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the whole documents table."""
    return near_duplicates(table(spark, sf_dir, "documents"))
