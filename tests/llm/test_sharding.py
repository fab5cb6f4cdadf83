import struct
import zlib
from collections import Counter

import pytest
import xxhash
from helpers_llm import documents
from pyspark.sql import functions as F

from trimatch.llm import sharding


def mask(key, step, value, side):
    h = 42
    for v in (key, step, value):
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return (h - (1 << 64 if h >> 63 else 0)) % side


def plain_place(x, n, key):
    """The permutation row by row, in plain Python."""
    a = next(i for i in range(1, n + 2) if i * i >= n)
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for step in range(sharding.ROUNDS):
            side = (a, b)[step % 2]
            left, right = right, (left + mask(key, step, right, side)) % side
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 101, 1000])
def test_permutation_equals_plain_and_reverses(spark, n):
    df = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 7).alias("p")).withColumn("back", sharding.permuted(F.col("p"), n, 7, back=True))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.back == r.id and r.p == plain_place(r.id, n, 7) for r in rows)


def check(rows, texts, shards=16):
    n = len(texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(shards)) and max(sizes.values(), default=0) - min((sizes[s] for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert sum(sizes.values()) == n


def test_shards_hold_every_row_once_in_any_partitioning(spark):
    texts = [(i % 40, ["", None, "a b", "ärger", "x" * 50_000][i % 5]) for i in range(200)] + [(None, None)] * 150 + [(None, "same")] * 90
    df = spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id long, text string, shard string")
    a = sharding.shard_rows(df).collect()
    b = sharding.shard_rows(df.repartition(11)).collect()
    check(a, texts)
    assert Counter(tuple(r) for r in a) == Counter(tuple(r) for r in b)
    back = spark.createDataFrame([(r.shard, r.slot, r.row_no) for r in a], "shard int, slot long, row_no long")
    assert back.filter(sharding.row_at(F.col("shard"), F.col("slot"), len(texts)) != F.col("row_no")).count() == 0
    assert [r.shard for r in sorted(a, key=lambda r: r.row_no)] != sorted(r.shard for r in a)


def test_another_key_gives_another_shuffle_and_empty_gives_none(spark):
    df = documents(spark, [f"text {i}" for i in range(300)], extra=True)
    a = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(df, 4).collect()}
    b = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(df, 4, key=1).collect()}
    assert a != b and sum(a[i] == b[i] for i in a) < 30
    assert sharding.shard_rows(documents(spark, [])).count() == 0


def test_written_shards_read_back_in_slot_order(spark, tmp_path):
    df = documents(spark, [f"text {i}" for i in range(100)], extra=True)
    got = sharding.write_shards(df, str(tmp_path / "shards"), shards=4, file_rows=10)
    assert {"score", "path", "text", "shard", "slot"} <= set(got.columns)
    rows = got.withColumn("f", F.input_file_name()).withColumn("i", F.col("_metadata.row_index")).collect()
    assert sorted(r.text for r in rows) == sorted(f"text {i}" for i in range(100))
    assert all(r.slot == r.file * 10 + r.i for r in rows) and len({r.f for r in rows}) == 12


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sharding.op12_sharding(spark, "/root/testdata/sf0.001").collect()
    check(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    plan = sharding.op12_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "ExistingRDD"))
