import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trimatch.llm import whitening as W


@pytest.mark.parametrize("n,seed", [(1, 0), (2, 1), (3, 2), (12, 3), (64, 4), (130, 5)])
def test_components_equal_numpy(n, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((3 * n, n)) * rng.uniform(0.1, 5, n)
    v = np.cov(a.T, bias=True).reshape(n, n)
    e, q = W.leading_components(v, 8)
    want, basis = np.linalg.eigh(v)
    want, basis = want[::-1][:8], basis[:, ::-1][:, :8]
    assert len(e) == min(n, 8) and np.allclose(e, want, rtol=1e-11)
    assert np.abs(np.abs((q * basis).sum(0)) - 1).max() < 1e-9
    assert np.abs(q.T @ q - np.eye(len(e))).max() < 1e-12


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 1, 1, 1, 1, 1, 1, 0, 0], [3, 3 - 1e-9, 3 - 2e-9, 1, 1 - 1e-12, 0.5, 0.5, 0.1, 0, 0], [2] * 10, [1e9, 1, 1e-3]])
def test_close_and_equal_eigenvalues(values):
    rng = np.random.default_rng(9)
    values = np.array(values, float)
    q0 = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    v = (q0 * values) @ q0.T
    v = (v + v.T) / 2
    e, q = W.leading_components(v, 8)
    want = np.sort(values)[::-1][:8]
    want = want[want > 1e-9 * want[0]]
    assert len(e) >= len(want) and np.allclose(e[:len(want)], want, rtol=1e-6)
    assert np.abs(q.T @ q - np.eye(len(e))).max() < 1e-10
    assert np.abs(v @ q - q * e).max() < 1e-9 * values[0]


def test_diagonal_block_and_zero_matrices():
    e, q = W.leading_components(np.diag([1.0, 4.0, 2.0, 3.0]), 3)
    assert np.allclose(e, [4, 3, 2]) and np.allclose(np.abs(q), np.eye(4)[:, [1, 3, 2]])
    assert len(W.leading_components(np.zeros((5, 5)))[0]) == 0 and len(W.leading_components(np.zeros((0, 0)))[0]) == 0
    d, o = np.array([1.0, 2.0, 3.0]), np.array([0.0, 0.0])
    assert W.count_below(d, o, np.array([0.5, 1.5, 2.5, 9.0])).tolist() == [0, 1, 2, 3]


def plain(vectors, k=8):
    """The contract with whole matrices: exact integers, numpy's eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n = len(x)
    s = [sum(col) for col in zip(*x)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    c = np.array(x, float) - np.array(s) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, dev, c @ q / np.sqrt(e), e / np.trace(v)


def compare(rows, ids, vectors, k=8):
    n, dev, white, explained = plain(vectors, k)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(got) == len(ids) * k
    sign = np.array([np.sign(got[ids[0], j + 1].whitened * white[0, j]) for j in range(k)])
    for a, i in enumerate(ids):
        for j in range(k):
            r = got[i, j + 1]
            assert r.n == n and int(r.deviation) == dev[a] and abs(r.whitened - sign[j] * white[a, j]) < 1e-6 * (1 + abs(r.whitened))
            assert abs(r.explained / explained[j] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whiten_equals_plain_with_awkward_rows(spark):
    rng = np.random.default_rng(1)
    mix = rng.standard_normal((12, 12))
    good = {i: (rng.standard_normal(12) @ mix).tolist() for i in range(300)}
    bad = [(900, None), (901, []), (902, [1.0] * 5), (903, [None] + [1.0] * 11), (904, [float("nan")] + [1.0] * 11),
           (905, [float("inf")] * 12), (906, [3e38] * 12)]
    df = spark.createDataFrame([*good.items(), *bad], "vec_id long, embedding array<float>").selectExpr("*", "'x' as component", "1 as n", "2 as w").repartition(6)
    compare(W.whiten(df).collect(), list(good), list(good.values()))


def test_repeated_rows_null_ids_and_few_rows(spark):
    rng = random.Random(3)
    some = [[rng.random() for _ in range(4)] for _ in range(3)]
    rows = [(None, some[0]), (None, some[0]), (1, some[1]), (1, some[2])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 4 * 2 and {r.n for r in got} == {4} and max(r.identity_error for r in got) < 1e-4
    same = spark.createDataFrame([(1, some[0]), (2, some[0])], "vec_id long, embedding array<double>")
    assert W.whiten(same).count() == 0
    assert W.whiten(same.limit(0)).count() == 0
    assert W.whiten(same.limit(0)).columns == W.whiten(same).columns


def test_deviation_is_exact_beyond_a_long(spark):
    vectors = [[1e6 * (i % 7), float(i), -2e9 * i] for i in range(500)]
    rows = W.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), 1).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    s = [sum(col) for col in zip(*x)]
    assert {r.vec_id: int(r.deviation) for r in rows} == {i: sum((500 * a - b) ** 2 for a, b in zip(row, s)) for i, row in enumerate(x)}


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").filter(
        "embedding is not null and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < 1e30)").collect()
    got = W.op11_whitening(spark, sf)
    assert dict(got.dtypes) | {"deviation": "bigint", "component": "int", "n": "bigint", "whitened": "double"} == dict(got.dtypes)
    compare(got.collect(), [r.vec_id for r in table], [r.embedding for r in table])
