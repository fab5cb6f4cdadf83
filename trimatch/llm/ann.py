"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample (``sample_rows`` vectors with the
smallest hash of their id) and sent to the tasks; its size depends on its
parameters alone.  Every vector is indexed: it descends to one leaf.  A query
walks the tree through a priority queue ordered by the inner product with the
centroids, and visits leaves until it has seen as many as calibration found
necessary: ``probe_rows`` sampled queries are answered by brute force over
all rows, and the visits are widened until their recall reaches ``recall``.

Leaves of more than ``cell_rows`` vectors are split into cells by a hash of
the id, so a vector that fills a third of the table costs more cells and no
larger task.  A query's first leaves, and the sample, give a score that its
``k``-th neighbour reaches; the other leaves give only rows that reach it too.  Scores are double
precision inner products of the original vectors.

Edge cases: vectors that are null, empty, all zero, hold a null or non-finite
component, or have another length than most take no part, neither do null
ids; ties go to the smaller id; repeated rows are each candidates, and a
query id is asked once; fewer than ``k`` candidates are all returned; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged, table

K = 20
SAMPLE_ROWS = 20_000
PROBE_ROWS = 128
LEAF_ROWS = 256
MAX_LEAVES = 8192
CELL_ROWS = 2048
RECALL = 0.96
FIRST_LEAVES = 4
_TOP = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes in arrays: children's ids per inner node, leaf number or -1."""
    children: list[list[int]] = field(default_factory=list)
    centroids: list[np.ndarray] = field(default_factory=list)   # of the children, one matrix a node
    leaf: list[int] = field(default_factory=list)
    n_leaves: int = 0

    def add(self) -> int:
        self.children.append([])
        self.centroids.append(np.zeros((0, 0)))
        self.leaf.append(-1)
        return len(self.leaf) - 1

    @staticmethod
    def fit(x: np.ndarray, leaf_points: float, branch: int = 8, seed: int = 3) -> Tree:
        tree, rng = Tree(), np.random.default_rng(seed)
        todo = [(tree.add(), x)]
        while todo:
            node, pts = todo.pop()
            groups = _kmeans(pts, branch, rng) if len(pts) > max(leaf_points, 1) and tree.n_leaves < MAX_LEAVES else []
            if len(groups) < 2:
                tree.leaf[node] = tree.n_leaves
                tree.n_leaves += 1
                continue
            tree.centroids[node] = np.stack([g.mean(0) for g in groups])
            for g in groups:
                child = tree.add()
                tree.children[node].append(child)
                todo.append((child, g))
        return tree

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child at every node."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0 or not len(rows):
                out[rows] = self.leaf[node]
                continue
            c = self.centroids[node]
            near = ((c * c).sum(1) - 2 * x[rows] @ c.T).argmin(1)
            todo += [(child, rows[near == j]) for j, child in enumerate(self.children[node])]
        return out

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(-np.inf, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
                continue
            for s, child in zip((self.centroids[node] @ q).tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (-s, child))


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 8) -> list[np.ndarray]:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    near = None
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        kept = [j for j in range(len(c)) if (near == j).any()]
        c = np.stack([x[near == j].mean(0) for j in kept])
    near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
    return [g for g in (x[near == j] for j in range(len(c))) if len(g)]


def _matrix(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
         least: np.ndarray | None = None) -> list[tuple]:
    """The best k rows for each query that reach its ``least`` score:
    (query, row number, score)."""
    out = []
    for at in range(0, len(q), 512):
        scores = q[at:at + 512] @ x.T
        for i, s in enumerate(scores):
            me = q_ids[at + i]
            ok = np.flatnonzero(ids != me) if least is None else np.flatnonzero((ids != me) & (s >= least[at + i]))
            if len(ok) > k:
                s_ok = s[ok]
                ok = ok[s_ok >= np.partition(s_ok, len(ok) - k)[len(ok) - k]]
            ok = ok[np.lexsort((ids[ok], -s[ok]))][:k]
            out += [(me, j, s[j]) for j in ok]
    return out


def _least(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """A score that each query's k-th neighbour reaches: its k-th best among
    the sampled rows (less a rounding margin)."""
    out = np.full(len(q), -np.inf)
    for at in range(0, len(q), 64):
        s = q[at:at + 64] @ x.T
        s[q_ids[at:at + 64, None] == ids[None, :]] = -np.inf
        if s.shape[1] >= k:
            kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            out[at:at + 64] = kth - 1e-9 * (1 + np.abs(kth))
    return out


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0].d if sizes else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
            sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product
    found for each query row."""
    rows = valid_vectors(vectors, id_col, vec_col)
    asked = valid_vectors(queries, id_col, vec_col).dropDuplicates(["vec_id"])
    by_hash = [F.xxhash64("vec_id"), "vec_id"]
    n = rows.count()
    drawn = rows.orderBy(*by_hash).limit(sample_rows).collect()
    sample, sample_ids = np.array([r.v for r in drawn]), np.array([r.vec_id for r in drawn])
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree.fit(sample, leaf_rows * len(sample) / n)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.assign(_matrix(b.column("v"))), pa.int32()), *b.columns],
                                             names=["leaf", *b.schema.names])

    indexed = rows.mapInArrow(index, "leaf int, vec_id long, v array<double>")
    sizes = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}   # at most MAX_LEAVES rows
    probes = asked.orderBy(*by_hash).limit(PROBE_ROWS).collect()
    visits = _calibrate(tree, indexed, sizes, [r.vec_id for r in probes], np.array([r.v for r in probes]), k, recall)

    cells = {leaf: -(-c // CELL_ROWS) for leaf, c in sizes.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.assign(_matrix(b.column("v")))
            ids = b.column("vec_id").to_numpy().astype(np.uint64)
            mixed = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            cell = mixed % np.array([cells[x] for x in leaf.tolist()] or [1], np.uint64) if len(leaf) else mixed
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(cell.astype(np.int32)), *b.columns],
                                             names=["leaf", "cell", *b.schema.names])

    def route(rest: bool):
        """Queries with the cells of their first leaves, or of the rest."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    vectors = _matrix(part.column("v"))
                    if rest:
                        floor = np.maximum(part.column("least").to_numpy(), _least(
                            part.column("vec_id").to_numpy(), vectors, sample_ids, sample, k))
                        part = part.set_column(part.schema.get_field_index("least"), "least", pa.array(floor))
                    take, leaves, cell = [], [], []
                    for i, q in enumerate(vectors):
                        seen = found = 0
                        for leaf in tree.best_bins(q):
                            first = seen < FIRST_LEAVES or found <= k
                            if not first and (seen >= visits or not rest):
                                break
                            if first != rest:
                                here = cells.get(leaf, 0)
                                take += [i] * here
                                leaves += [leaf] * here
                                cell += range(here)
                            seen += 1
                            found += sizes.get(leaf, 0)
                    rows = part.take(pa.array(take, pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int32()), pa.array(cell, pa.int32()), *rows.columns],
                                                     names=["leaf", "cell", *b.schema.names])
        return run

    kind = "leaf int, cell int, vec_id long, v array<double>"

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = _top(left.column("vec_id").to_numpy(), _matrix(left.column("v")), right.column("vec_id").to_numpy(),
                   _matrix(right.column("v")), k, left.column("least").to_numpy()) if left.num_rows and right.num_rows else []
        ids = right.column("vec_id").to_numpy() if right.num_rows else []
        return pa.Table.from_batches([_rows(["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()],
                                            [(q, ids[j], s) for q, j, s in out])])

    def visit(queries: DataFrame, rest: bool) -> DataFrame:
        return queries.mapInArrow(route(rest), kind + ", least double").groupBy("leaf", "cell").cogroup(
            rows.mapInArrow(place, kind).groupBy("leaf", "cell")).applyInArrow(compare, _TOP)

    # the first leaves give k rows at least; with the sample they tell a score
    # that the k-th neighbour reaches, and the other leaves give only rows that
    # reach it too
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = staged(visit(asked.withColumn("least", F.lit(float("-inf"))), False), "first-leaves")
    kth = first.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    again = asked.join(kth, "vec_id", "left").select("vec_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    found = first.unionByName(visit(again, True))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _calibrate(tree: Tree, indexed: DataFrame, sizes: dict, ids: list[int], q: np.ndarray, k: int, recall: float) -> int:
    """Leaf visits that reach ``recall`` on the probe queries, from their true
    neighbours over all rows: a block of probes against every row, once."""
    if not ids or tree.n_leaves == 1:
        return tree.n_leaves
    me = np.array(ids)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf, vec = b.column("leaf").to_numpy(), b.column("vec_id").to_numpy()
                yield _rows(["query_id", "vec_id", "leaf", "score"], [pa.int64(), pa.int64(), pa.int32(), pa.float64()],
                            [(m, vec[j], leaf[j], s) for m, j, s in _top(me, q, vec, _matrix(b.column("v")), k)])

    best = indexed.mapInArrow(brute, "query_id long, vec_id long, leaf int, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = best.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).select("query_id", "leaf").collect()
    place = {m: {leaf: i for i, leaf in enumerate(tree.best_bins(v))} for m, v in zip(ids, q, strict=True)}
    need = np.sort([place[r.query_id][r.leaf] + 1 for r in true])
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)]) if len(need) else tree.n_leaves


def op3_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every query (id divisible by 20)."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))
