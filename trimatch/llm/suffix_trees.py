"""Repeated passages by prefix-partitioned suffix trees.

Which suffixes matter: a passage of ``width`` words that two documents share
also shares the smallest of its ``PREFIX``-word sequences (by hash), so the
suffixes that start at such positions meet in the group of that prefix, and
only prefixes found in two documents or more are gone into.  Each occurrence
brings the context of all windows that its position stands for.

Groups: a prefix of ``PREFIX`` words normally makes a group small enough for
memory, and one task holds many groups.  A prefix with more than ``GROUP``
occurrences is lengthened to the full width: equal contexts are combined
first (by partial aggregation, before the shuffle), then the suffixes of the
different ones are spread by their first ``width`` words and the smallest
document of each is found by an ordinary aggregation.

Subtrees: the suffixes of a group are ranked by prefix doubling over exact
word numbers (depths 1, 2, 4, .. width), which gives the suffix tree's
internal nodes at each depth.  Two suffixes under one node of depth ``width``
share a window; the deep nodes' runs are the maximal repeats.

A word goes if a window that covers it also starts in a document with a
smaller id; windows are judged on the input.

Edge cases: null or empty text has no words; texts shorter than a window keep
all; a null doc_id is reported and neither gives nor loses anything; rows
that repeat a doc_id are each reported; repeats inside one document stay; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_starts, grams, row_slices, staged, table, text_blocks, text_buffer, word_hashes, words

WIDTH = 50
PREFIX = 18
GROUP = 16384                   # contexts of one group: about 8 MB of text
TREE_WORDS = 250_000
_U = np.uint64


# --- suffixes -------------------------------------------------------------------

def window_minima(g: np.ndarray, m: int) -> np.ndarray:
    """Position of the smallest of every m consecutive hashes (first of ties,
    compared by their upper half)."""
    packed = (g & _U(0xFFFFFFFF00000000)) | np.arange(len(g)).astype(np.uint64)
    low, size = packed, 1
    while 2 * size <= m:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if size < m:
        low = np.minimum(low[:len(g) - m + 1], low[m - size:m - size + len(g) - m + 1])
    return (low & _U(0xFFFFFFFF)).astype(np.int64)


def _anchors(width: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches):
            starts, ends, first = words(buf, offs)
            s = gram_starts(first, width)
            if not len(s):
                continue
            g = grams(word_hashes(buf, starts, ends), prefix)
            at = window_minima(g, width - prefix + 1)[s]
            begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.append(begin[1:], len(s)) - 1
            doc = np.searchsorted(first, s[begin], "right") - 1
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id").take(pa.array(doc)), pa.array(g[at[begin]].view(np.int64)),
                pa.array((s[begin] - first[doc]).astype(np.int32)), pa.array((last - begin + 1).astype(np.int32))],
                names=["doc_id", "h", "lo", "n"])
    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for b in row_slices(batches):
        z = [pack.compress(b" ".join((t.as_py() or "").encode().split())) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(z, pa.binary())], names=["doc_id", "z"])


def _contexts(width: int):
    """One row for each occurrence: its prefix, and the words of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            held = 0
            for doc_id, z, found in zip(*(b.column(c) for c in ("doc_id", "z", "at")), strict=True):
                text = unpack.decompress(z.as_py())
                gap = np.concatenate([[-1], np.flatnonzero(np.frombuffer(text, np.uint8) == 32), [len(text)]])
                for a in found.as_py():
                    lo, n = a["lo"], a["n"]
                    ctx = text[gap[lo] + 1:gap[lo + n + width - 1]]
                    for col, v in zip(out, (a["h"], doc_id.as_py(), lo, n, ctx), strict=True):
                        col.append(v)
                    held += len(ctx)
                if held > 4 << 20:
                    yield _context_batch(out)
                    out, held = ([], [], [], [], []), 0
            if out[0]:
                yield _context_batch(out)
    return run


def _context_batch(out: tuple[list, ...]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                      names=["h", "doc_id", "lo", "n", "ctx"])


def _full_width(width: int):
    """One row for each occurrence of a frequent prefix: 128 bits of the words
    of each of its windows, and of its whole context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in row_slices(batches, 100):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, z, found in zip(*(b.column(c) for c in ("doc_id", "z", "at")), strict=True):
                text = unpack.decompress(z.as_py())
                buf, offs = text_buffer(pa.array([text], pa.binary()).cast(pa.string()))
                starts, ends, _ = words(buf, offs)
                h = word_hashes(buf, starts, ends)
                one, two = grams(h, width).view(np.int64), grams(h, width, second=True).view(np.int64)
                for a in found.as_py():
                    s = slice(a["lo"], a["lo"] + a["n"])
                    key = np.frombuffer(xxhash.xxh3_128_digest(one[s].tobytes() + two[s].tobytes()), np.int64)
                    for col, v in zip(out, (doc_id.as_py(), a["lo"], int(key[0]), int(key[1]), one[s], two[s]), strict=True):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                             names=["doc_id", "lo", "c1", "c2", "w1", "w2"])
    return run


def _covered(width: int):
    """Word ranges of an occurrence whose windows start in an earlier document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            least = b.column("least")
            n = np.diff(least.offsets.to_numpy())
            row = np.repeat(np.arange(b.num_rows), n)
            within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            doc, lo = b.column("doc_id").to_numpy(), b.column("lo").to_numpy()
            yield _merged(doc, lo, row, within, least.flatten().to_numpy() < doc[row], width)
    return run


# --- subtrees -------------------------------------------------------------------

def deep_nodes(word: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix, the number of the suffix tree's node at ``depth``, by
    prefix doubling; suffixes that end earlier get no meaningful one."""
    rank, d = word.astype(np.int64), 1
    while d < depth:
        step = min(d, depth - d)
        pair = rank[:-step] * (rank.max() + 1) + rank[step:]
        rank, d = np.unique(pair, return_inverse=True)[1], d + step
    return rank


def _subtrees(width: int, tree_words: int):
    """Removed word ranges from whole groups of contexts, in order of prefix."""
    def solve(doc: np.ndarray, lo: np.ndarray, n: np.ndarray, ctx: pa.Array) -> pa.RecordBatch:
        buf, offs = text_buffer(pc.cast(ctx, pa.string()))
        starts, ends, first = words(buf, offs)
        off32 = np.empty(2 * len(starts) + 1, np.int64)
        off32[0:-1:2], off32[1::2], off32[-1] = starts, ends, ends[-1]
        cells = pa.LargeStringArray.from_buffers(len(off32) - 1, pa.py_buffer(off32), pa.py_buffer(np.ascontiguousarray(buf)))
        code = cells.dictionary_encode().indices.to_numpy()[::2]        # every other cell is a gap
        node = deep_nodes(code, width)
        row = np.repeat(np.arange(len(doc)), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = node[first[row] + within]
        least = np.full(int(at.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, at, doc[row])
        return _merged(doc, lo, row, within, least[at] < doc[row], width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(upto: int | None) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            t = pa.Table.from_batches(held).combine_chunks()
            now = t.slice(0, upto)
            if now.num_rows:
                yield solve(*(now.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "lo", "n")),
                            now.column("ctx").combine_chunks())
            held = [] if upto is None else t.slice(upto).to_batches()
            size = sum(x.column("ctx").nbytes for x in held)

        for big in batches:
            for i in range(0, big.num_rows, 512):
                b = big.slice(i, 512)
                held.append(b)
                size += b.column("ctx").nbytes
                if size > 6 * tree_words:
                    h = np.concatenate([x.column("h").to_numpy() for x in held])
                    cut = np.flatnonzero(h != h[-1])
                    if len(cut):                       # up to the last complete group
                        yield from flush(int(cut[-1]) + 1)
        if held:
            yield from flush(None)
    return run


def _merged(doc: np.ndarray, lo: np.ndarray, row: np.ndarray, within: np.ndarray, gone: np.ndarray, width: int) -> pa.RecordBatch:
    """One range for each run of windows that go; ``row`` and ``within`` say
    whose window and which."""
    r, s = row[gone], within[gone]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(r)) - 1 if len(r) else begin
    return _ranges(doc[r[begin]], lo[r[begin]] + s[begin], lo[r[begin]] + s[end] + width)


def _ranges(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc.astype(np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                                      names=["doc_id", "lo", "hi"])


# --- operator -------------------------------------------------------------------

def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def repeated_ranges(rows: DataFrame, packed: DataFrame, width: int = WIDTH, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """doc_id, lo, hi: word ranges whose windows also start in a document with
    a smaller id (ranges may overlap)."""
    found = staged(rows.filter("doc_id is not null").mapInArrow(_anchors(width, prefix), "doc_id long, h long, lo int, n int"), "prefixes")
    shared = found.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("m")) \
        .filter("a < b").select("h", (F.col("m") > group).alias("long"))
    kept = staged(found.join(shared, "h"), "shared-prefixes")

    def with_text(long: bool) -> DataFrame:
        at = kept.filter(F.col("long") == long).groupBy("doc_id").agg(F.collect_list(F.struct("h", "lo", "n")).alias("at"))
        return packed.join(at, "doc_id").select("doc_id", "z", "at")

    short = (with_text(False).mapInArrow(_contexts(width), "h long, doc_id long, lo int, n int, ctx binary")
             .repartition("h").sortWithinPartitions("h")
             .mapInArrow(_subtrees(width, TREE_WORDS), "doc_id long, lo int, hi int"))
    # a frequent prefix: equal contexts are combined before anything else, and
    # windows are compared between different contexts only
    wide = staged(with_text(True).mapInArrow(_full_width(width), "doc_id long, lo int, c1 long, c2 long, w1 array<long>, w2 array<long>"), "full-width")
    contexts = staged(wide.groupBy("c1", "c2").agg(F.min("doc_id").alias("first"), F.first("w1").alias("w1"), F.first("w2").alias("w2")), "contexts")
    window = contexts.select("c1", "c2", "first", F.posexplode(F.arrays_zip("w1", "w2")).alias("i", "w")).select("c1", "c2", "first", "i", "w.w1", "w.w2")
    least = window.groupBy("w1", "w2").agg(F.min("first").alias("least"))
    by_context = window.join(least, ["w1", "w2"]).groupBy("c1", "c2").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "least"))), lambda x: x["least"]).alias("least"))
    full = wide.select("doc_id", "lo", "c1", "c2").join(by_context, ["c1", "c2"]).select("doc_id", "lo", "least") \
        .mapInArrow(_covered(width), "doc_id long, lo int, hi int")
    return short.unionByName(full)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in row_slices(batches):
        out: tuple[list, ...] = ([], [], [], [])
        for z, gone in zip(b.column("z"), b.column("gone"), strict=True):
            w = unpack.decompress(z.as_py()).split()
            mark = np.zeros(len(w) + 1, np.int64)
            g = gone.as_py() or []
            np.add.at(mark, [r["lo"] for r in g], 1)
            np.add.at(mark, [r["hi"] for r in g], -1)
            keep = np.cumsum(mark[:-1]) == 0
            left = b" ".join(x for x, k in zip(w, keep.tolist(), strict=True) if k)
            for col, v in zip(out, (len(w), len(w) - int(keep.sum()), left.decode(), hashlib.sha256(left).hexdigest()), strict=True):
                col.append(v)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.string()), pa.array(out[3], pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, width: int = WIDTH, prefix: int = PREFIX, group: int = GROUP,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, parted by one space),
    kept_sha256."""
    rows = _source(docs, id_col, text_col)
    kind = "doc_id long, z binary"
    # one shuffle of the compressed texts by id serves every join below
    packed = rows.filter("doc_id is not null").mapInArrow(_squeeze, kind).filter("doc_id is not null")
    gone = repeated_ranges(rows, packed, width, prefix, group) \
        .groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("gone"))
    no_id = rows.filter("doc_id is null").mapInArrow(_squeeze, kind).withColumn("gone", F.lit(None).cast("array<struct<lo:int,hi:int>>"))
    return packed.join(gone, "doc_id", "left").unionByName(no_id).mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove repeated passages from the whole documents table."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
