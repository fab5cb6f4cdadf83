import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import documents, prose

from trimatch.llm import resampling as R

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, orders=(1,)):
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    w = WORD.findall(raw)
    return len(w), [b" ".join(w[i:i + k]) for k in orders for i in range(len(w) - k + 1)]


def plain(docs, target, percent=10, min_words=20, orders=(1,), buckets=10_000, seed=2024):
    """The contract row by row."""
    s, t = Counter(), Counter()
    for texts, c in ((docs, s), (target, t)):
        for _, text in texts:
            c.update(zlib.crc32(g) % buckets for g in grams(text, orders)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        n, g = grams(text, orders)
        weight = sum(gain[zlib.crc32(x) % buckets] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = k + 1
    return rows


def rows_of(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect())


def wanted(rows):
    return Counter((r[0], r[1], r[2], r[3], r[5]) for r in rows)


@pytest.mark.parametrize("orders", [(1,), (1, 2, 3)])
def test_resample_equals_plain(spark, orders):
    rng = random.Random(2)
    texts = [(i, prose(rng, rng.randrange(0, 60), 80)) for i in range(150)]
    texts += [(200, None), (201, ""), (202, "Ärger, ÉTÉ été; naïve space x1Y2 " * 9), (203, "a" * 70_000 + " b" * 400), (None, prose(rng, 40)), (204, "!!! ...")]
    texts += [(300, "same words " * 15)] * 20 + [(None, "same words " * 15)] * 30
    target = [(k, prose(rng, 30, 10)) for k in range(12)] + [(98, None), (99, "same")]
    df = documents(spark, [], extra=True)
    df = df.unionByName(spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True).repartition(5)
    want = plain(texts, target, 25, 5, orders, 300)
    got = R.resample(df, spark.createDataFrame(target, "item_id long, text string"), 25, 5, orders, 300)
    assert rows_of(got) == wanted(want)
    assert sorted(r.rank for r in got.collect() if r.rank) == list(range(1, sum(r[4] >= 5 for r in want) * 25 // 100 + 1))


def test_interning_survives_equal_hashes():
    rng = random.Random(4)
    texts = [prose(rng, 80, 50).encode() for _ in range(6)]
    offs = np.cumsum([0, *map(len, texts)])
    f = R.Features(np.frombuffer(b"".join(texts), np.uint8), offs, (1, 2))
    raw = f.text.tobytes()
    spans = [raw[a:b] for a, b in zip(f.begin, f.end)]
    want = np.bincount([zlib.crc32(x) % 97 for x in spans], minlength=97)
    for keys in (None, f.hashes() % np.uint64(5), np.zeros(len(spans), np.uint64), np.full(len(spans), 2**64 - 1, np.uint64)):
        got = R.Interned(f, 97, keys)
        assert (got.bucket_counts(97) == want).all()
        assert [raw[f.begin[o]:f.end[o]] for o in got.owner[got.slot]] == spans
        assert len({raw[f.begin[o]:f.end[o]] for o in got.owner[got.owner >= 0]}) == (got.owner >= 0).sum()


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, ["a b c " * 10] * 20)
    assert R.resample(none, some).count() == 0
    got = R.resample(some, none).collect()
    assert sorted(r.rank for r in got if r.rank) == [1, 2] and len({r.weight for r in got}) == 1


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows_of(R.op13_resampling(spark, sf)) == wanted(plain(docs, target))
