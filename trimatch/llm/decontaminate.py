"""Benchmark decontamination with a positional inverted index.

Training documents are cut into index shards (blocks of text inside the scan
tasks, so the corpus is never shuffled).  A shard stores the postings
(position lists) of every term that the benchmark uses.  Each benchmark
window is answered by intersecting its lists, shifted by the term's offset,
from the rarest term on; what is left are exact phrase matches.  With
``slack`` the same lists give proximity matches: all terms of the window, in
any order, within one span of ``slack`` words.

The benchmark goes to the tasks in blocks of bounded size (``block_terms``
words each); every block passes over the whole corpus, so a larger benchmark
costs more passes and no more memory.

Edge cases: null or empty text has no words; a null item id takes part in
windows and is left out of the id list; repeated items count once; an item
of fewer words than a window is one window of all its words; rows that repeat
a doc_id or have none are each reported; ties don't arise; empty tables give no
matches; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_WORD, list_array, lower, row_places, staged, table, text_blocks, text_buffer, union_all, word_hashes, words

WINDOW = 10
BLOCK_TERMS = 2_000_000
#: Counts the words of an item; bytes lower() changes A-Z alone.
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
_SCHEMA = "row_f long, row_i long, doc_id long, n_words long, hit_starts array<int>, hit_ends array<int>, items array<string>, near_items array<string>"


class Windows:
    """The windows of one benchmark block: term hashes in fixed-width rows."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int) -> None:
        rows, lens, owner = [], [], []
        ids = [i for i, _ in items]
        buf, offs = text_buffer(pa.array([t for _, t in items], pa.string()))
        buf = lower(buf)
        starts, ends, first = words(buf, offs, NOT_WORD)
        h = word_hashes(buf, starts, ends)
        for k in range(len(items)):
            mine = h[first[k]:first[k + 1]]
            n = min(width, len(mine))
            for at in range(len(mine) - n + 1 if n else 0):
                row = np.zeros(width, np.uint64)
                row[:n] = mine[at:at + n]
                rows.append(row)
                lens.append(n)
                owner.append(k)
        self.ids = ids
        self.hashes = np.array(rows, np.uint64).reshape(-1, width)
        self.lens, self.owner = np.array(lens, np.int64), np.array(owner, np.int64)
        used = np.arange(width)[None, :] < self.lens[:, None]
        self.vocab = np.unique(self.hashes[used]) if len(rows) else np.zeros(0, np.uint64)
        self.terms = np.where(used, np.searchsorted(self.vocab, self.hashes), len(self.vocab)).astype(np.int64)
        # a bitmap over 16 hash bits sorts out most other words before the lookup
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocab >> np.uint64(44)).astype(np.int64)] = True


class Shard:
    """Positional inverted index of one block of documents."""

    def __init__(self, win: Windows, h: np.ndarray) -> None:
        at = np.flatnonzero(win.maybe[(h >> np.uint64(44)).astype(np.int64)])
        term = np.searchsorted(win.vocab, h[at])
        known = term < len(win.vocab)
        known[known] = win.vocab[term[known]] == h[at][known]
        at, term = at[known], term[known]
        order = np.argsort(term, kind="stable")
        self.positions, ordered = at[order], term[order]
        self.bounds = np.searchsorted(ordered, np.arange(len(win.vocab) + 1))
        self.count = np.append(np.diff(self.bounds), np.iinfo(np.int64).max)  # unused slots sort last
        self.at = np.full(len(h), -1, np.int32)     # term at each position: membership of a list
        self.at[at] = term

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.bounds[term]:self.bounds[term + 1]]

    def phrase(self, terms: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
        """Start positions of the exact phrase, rarest lists first."""
        order = np.argsort(self.count[terms], kind="stable")
        starts = self.postings(terms[order[0]]) - order[0]
        starts = starts[(starts >= 0) & (starts + len(terms) <= len(self.at))]
        for off in order[1:]:
            if not len(starts):
                return starts
            starts = starts[self.at[starts + off] == terms[off]]
        return starts[doc_of[starts] == doc_of[starts + len(terms) - 1]] if len(starts) else starts

    def near(self, terms: np.ndarray, doc_of: np.ndarray, slack: int) -> np.ndarray:
        """Positions of the rarest term that lie in a span of ``slack`` words
        of one document with every term of the window."""
        order = np.argsort(self.count[terms], kind="stable")
        pivot, others = self.postings(terms[order[0]]), [self.postings(t) for t in dict.fromkeys(terms[order[1:]].tolist()) if t != terms[order[0]]]
        for lst in others:          # each list has a posting near enough
            if not len(pivot):
                return pivot
            k = np.searchsorted(lst, pivot)
            ok = np.zeros(len(pivot), bool)
            for cand in (np.minimum(k, len(lst) - 1), np.maximum(k - 1, 0)):
                p = lst[cand]
                ok |= (np.abs(p - pivot) < slack) & (doc_of[p] == doc_of[pivot])
            pivot = pivot[ok]
        return np.array([p for p in pivot if self._spanned(p, others, doc_of, slack)], np.int64)

    @staticmethod
    def _spanned(p: int, others: list[np.ndarray], doc_of: np.ndarray, slack: int) -> bool:
        """Whether one span of ``slack`` words holds position p and every list."""
        around = []
        for lst in others:
            at = lst[np.searchsorted(lst, p - slack + 1):np.searchsorted(lst, p + slack)]
            around.append(at[doc_of[at] == doc_of[p]])
        first = np.unique(np.concatenate([[p], *[a[a <= p] for a in around]]))     # where a span may begin
        first = first[first > p - slack]
        return any(all(((a >= f) & (a < f + slack)).any() for a in around) for f in first)


def _match(win: Windows, slack: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in text_blocks(batches, max_bytes=1 << 20):
            buf = lower(buf)
            starts, ends, first = words(buf, offs, NOT_WORD)
            n = np.diff(first)
            doc_of = np.repeat(np.arange(len(n)), n)
            found = np.zeros((0, 3), np.int64)
            near = np.zeros((0, 2), np.int64)
            if len(starts) and len(win.lens):
                shard = Shard(win, word_hashes(buf, starts, ends))
                hits, close = [], []
                for w in np.flatnonzero((shard.count[win.terms] > 0).all(axis=1)):
                    terms = win.terms[w, :win.lens[w]]
                    at = shard.phrase(terms, doc_of)
                    if len(at):
                        hits.append(np.stack([at, np.full(len(at), win.lens[w]), np.full(len(at), win.owner[w])], 1))
                    if slack is not None:
                        p = shard.near(terms, doc_of, slack)
                        if len(p):
                            close.append(np.stack([doc_of[p], np.full(len(p), win.owner[w])], 1))
                if hits:
                    found = np.unique(np.concatenate(hits), axis=0)
                if close:
                    near = np.unique(np.concatenate(close), axis=0)
            owner_doc = doc_of[found[:, 0]] if len(found) else np.zeros(0, np.int64)
            pairs = np.unique(np.stack([owner_doc, found[:, 2]], 1), axis=0)
            cnt = np.bincount(owner_doc, minlength=len(n))
            local = found[:, 0] - first[owner_doc]
            yield pa.RecordBatch.from_arrays([
                *(rows.column(c) for c in ("row_f", "row_i", "doc_id")), pa.array(n, pa.int64()),
                list_array(local, cnt, pa.int32()), list_array(local + found[:, 1], cnt, pa.int32()),
                _names(win.ids, pairs, len(n)), _names(win.ids, near, len(n))],
                names=["row_f", "row_i", "doc_id", "n_words", "hit_starts", "hit_ends", "items", "near_items"])
    return run


def _names(ids: list, pairs: np.ndarray, n: int) -> pa.Array:
    return list_array([ids[k] for k in pairs[:, 1]], np.bincount(pairs[:, 0], minlength=n), pa.string())


def _blocks(benchmark: DataFrame, width: int, item_col: str, item_text: str, block_terms: int) -> Iterator[Windows]:
    """The benchmark's windows in blocks of bounded size; one at least."""
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    block, size, none = [], 0, True
    for r in items.orderBy("id", "text").toLocalIterator():
        block.append((r.id, r.text))
        size += width * len(_WORDS((r.text or "").encode().lower()))
        if size >= block_terms:
            yield Windows(block, width)
            block, size, none = [], 0, False
    if block or none:
        yield Windows(block, width)


def match_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slack: int | None = 2 * WINDOW,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per document: word count, the occurrences of windows as word
    spans, the items they come from, and the items with a proximity match.

    One benchmark block needs no shuffle.  With more, the documents are written
    once and each block's matches are written before the next block is built;
    they come together by the place of their row, so repeated and null ids keep
    a row each and the result is the same at any ``block_terms``."""
    lists = ("hit_starts", "hit_ends", "items", "near_items")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = _blocks(benchmark, width, item_col, item_text, block_terms)
    win, more = next(blocks), next(blocks, None)
    if more is None:
        nowhere = F.lit(None).cast("long")
        return source.select(nowhere.alias("row_f"), nowhere.alias("row_i"), "*").mapInArrow(_match(win, slack), _SCHEMA).drop("row_f", "row_i")
    rows = row_places(source, "doc_id", "text")
    every = staged(rows.mapInArrow(_match(win, slack), _SCHEMA), "matches")
    found = [every.select("row_f", "row_i", *lists)]
    while more is not None:
        part = rows.mapInArrow(_match(more, slack), _SCHEMA).select("row_f", "row_i", *lists)
        found.append(staged(part.filter((F.size("items") > 0) | (F.size("near_items") > 0) | (F.size("hit_starts") > 0)), "matches"))
        more = next(blocks, None)
    merged = union_all(found).groupBy("row_f", "row_i").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in lists))
    return every.drop(*lists).join(merged, ["row_f", "row_i"]).select("doc_id", "n_words", *lists)


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, flag: str = "contaminated", width: int = WINDOW,
                      text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                      block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``docs`` with a column that tells whether any window occurs; no shuffle
    however many blocks the benchmark has."""
    out = docs.withColumn(flag, F.lit(False))
    for win in _blocks(benchmark, width, item_col, item_text, block_terms):
        def run(batches: Iterator[pa.RecordBatch], match=_match(win, None)) -> Iterator[pa.RecordBatch]:
            for b in batches:
                slim = pa.RecordBatch.from_arrays([*[pa.nulls(b.num_rows, pa.int64())] * 3, b.column(text_col)],
                                                  names=["row_f", "row_i", "doc_id", "text"])
                hit = np.concatenate([np.diff(m.column("hit_starts").offsets.to_numpy()) > 0
                                      for m in match(iter([slim]))] or [np.zeros(0, bool)])
                hit |= b.column(flag).to_numpy(zero_copy_only=False)
                cols = list(b.columns)
                cols[b.schema.get_field_index(flag)] = pa.array(hit)
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
        out = out.mapInArrow(run, out.schema)
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for doc_id, n, starts, ends, items, near in zip(*(b.column(c).to_pylist() for c in range(6)), strict=True):
            hit = upto = 0
            for s, e in sorted(zip(starts, ends, strict=True)):
                hit += max(0, e - max(s, upto))
                upto = max(upto, e)
            ids = sorted({i for i in items if i is not None})
            out.append((doc_id, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0,
                        len({i for i in near if i is not None})))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[
            "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"])


def contamination(docs: DataFrame, benchmark: DataFrame, **kwargs) -> DataFrame:
    """One row per document: words, words hit, items found, and whether it is
    contaminated."""
    return match_benchmark(docs, benchmark, **kwargs).mapInArrow(
        _digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                 "contaminated boolean, n_near_items long")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of the whole documents table by the whole benchmark:
    exact phrases, with the columns of the SQL twin (``op10_proximity`` adds
    the proximity matches)."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slack=None).drop("n_near_items")


def op10_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op10_decontamination`` and n_near_items: items with a
    proximity match, all words of a window within 20 words in any order."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select item_id, least(10, len(w)) as n, w[i:i + least(10, len(w)) - 1] as g
  from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(i) where len(w) > 0),
sizes as (select distinct n from win),
occ as (
  select d.doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from d, sizes, unnest(range(1, len(w) - n + 2)) as t(i)),
hits as (
  select doc_id, i, occ.n, item_id from occ join win on occ.n = win.n and occ.g = array_to_string(win.g, ' ')),
pos as (
  select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as t(p) group by doc_id),
ids as (
  select doc_id, count(distinct cast(item_id as varchar)) as n_items,
         string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as s
  from hits group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join ids using (doc_id)
"""
