import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers_llm import by_id, documents, prose

from trimatch.llm import chosen_path, decontaminate, maxent, suffix_trees
from trimatch.llm import common


# --- word helpers ---------------------------------------------------------------

def test_words_match_bytes_split():
    import pyarrow as pa
    texts = ["", " a  b\tc\n", "één\x0btwo\x0c", None, "x", "a b", "c"]
    buf, offs = common.text_buffer(pa.array(texts))
    s, e, first = common.words(buf, offs)
    got = [[bytes(buf[s[i]:e[i]]) for i in range(first[k], first[k + 1])] for k in range(len(texts))]
    assert got == [(t or "").encode().split() for t in texts]


def test_equal_words_hash_alike_and_grams_follow_order():
    import pyarrow as pa
    buf, offs = common.text_buffer(pa.array(["b a b c", "zz b c a"]))
    s, e, _ = common.words(buf, offs)
    h = common.word_hashes(buf, s, e)
    assert h[0] == h[2] == h[5] and len({int(x) for x in h}) == 4
    g = common.grams(h, 2)
    assert g[2] == g[5] and len({int(x) for x in g}) == 6


# --- op4 -------------------------------------------------------------------------

def plain_removal(texts, width):
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - width + 1):
            first.setdefault(tuple(words[i][s:s + width]), i)
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < i:
                keep[s:s + width] = [False] * width
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        out[i] = (len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest())
    return out


def repeat_cases():
    rng = random.Random(1)
    passage = prose(rng, 70)
    texts = {i: prose(rng, rng.randrange(0, 200)) for i in range(20)}
    for i in range(20, 40):     # a passage that half the documents share, at any offset
        texts[i] = prose(rng, rng.randrange(0, 30)) + " " + passage + "\n" + prose(rng, rng.randrange(0, 30))
    texts |= {40: texts[25], 41: texts[25].upper(), 42: "", 43: None, 44: "the " * 300, 45: "the " * 120, 46: prose(rng, 49),
              47: " ".join(texts[25].split()[:60]), 48: prose(rng, 9000), 49: "a b " * 80}
    texts[50] = texts[48]
    return texts


@pytest.mark.parametrize("group", [4096, 3])
def test_suffix_trees_equal_plain_removal(spark, group):
    texts = repeat_cases()
    got = by_id(suffix_trees.remove_repeats(documents(spark, texts, extra=True), group=group))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == plain_removal(texts, 50)


def test_suffix_trees_other_width(spark):
    texts = repeat_cases()
    got = by_id(suffix_trees.remove_repeats(documents(spark, texts), width=12, prefix=5))
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == plain_removal(texts, 12)


def test_suffix_trees_empty_and_null_ids(spark):
    assert suffix_trees.remove_repeats(documents(spark, [])).count() == 0
    t = prose(random.Random(2), 80)
    df = documents(spark, {1: t, 2: t}).unionByName(documents(spark, {7: t}).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars"))
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffix_trees.remove_repeats(df).collect()) == [(0, 0), (1, 0), (2, 80)]


def test_deep_nodes_group_equal_prefixes():
    rng = np.random.default_rng(3)
    w = rng.integers(0, 3, 400)
    node = suffix_trees.deep_nodes(w, 7)
    seen = {}
    for i in range(len(w) - 6):
        assert seen.setdefault(tuple(w[i:i + 7]), node[i]) == node[i]
    assert len(set(seen.values())) == len(seen)


# --- op7 -------------------------------------------------------------------------

def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def plain_components(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            inter = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def near_cases(n_base=12, copies=12):
    rng = random.Random(4)
    texts, at = {}, 100
    for b in range(n_base):
        base = prose(rng, rng.randrange(60, 300), 5000).split()
        for c in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(9999)}"
            texts[at] = " ".join(w)
            at += 1
    texts |= {1: "", 2: None, 3: "one", 4: "ONE", 5: "one two", 6: " \n ", 7: prose(rng, 6000, 9000), 8: texts[100].upper()}
    return texts


@pytest.mark.parametrize("k,percent,node", [(3, 85, 1024), (5, 80, 1024), (3, 85, 4)])
def test_components_equal_all_pairs(spark, k, percent, node):
    texts = near_cases()
    got = by_id(chosen_path.near_duplicates(documents(spark, texts, extra=True), k, percent, node=node))
    # tiny nodes are tied, end in blocks of pairs or branch on
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == plain_components(texts, k, percent)


def variants(n, words=300):
    """Variants linked to one original, the largest id, and hardly to one another."""
    rng = random.Random(1)
    base = prose(rng, words, 5000).split()
    texts = {n: " ".join(base)}
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(words - 3), rng.randrange(5, 9)):
            w[at] = f"e{rng.randrange(10 ** 6)}"
        texts[i] = " ".join(w)
    return texts


def test_oversized_nodes_are_compared_wholly(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "ROUNDS", 0)
    texts = variants(150)
    got = by_id(chosen_path.near_duplicates(documents(spark, texts), node=16))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == plain_components(texts, 3, 85)


def test_deeper_nodes_get_more_trees(spark):
    texts = variants(150)       # nodes of 16: all six rounds
    got = by_id(chosen_path.near_duplicates(documents(spark, texts), node=16))
    assert {i: r.component_id for i, r in got.items()} == {i: v[1] for i, v in plain_components(texts, 3, 85).items()}
    for percent in (80, 85, 90):
        for depth in (4, 13, 22):
            trees = chosen_path.trees_for(percent, depth)
            assert chosen_path.shared(percent, depth, trees) >= chosen_path.RECALL > chosen_path.shared(percent, depth, trees - 1)


def test_near_duplicates_empty_null_repeated(spark):
    assert chosen_path.near_duplicates(documents(spark, [])).count() == 0
    df = documents(spark, {1: "a b c d", 2: "a b c d"})
    null = df.limit(1).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")
    got = chosen_path.near_duplicates(df.unionByName(df.filter("doc_id = 2")).unionByName(null)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (1, 1, True), (2, 1, False), (2, 1, False)]


def test_node_links_bitmaps_equal_plain():
    rng = np.random.default_rng(5)
    base = np.arange(200, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(200) < 0.06, rng.integers(1000, 9000, 200), base)).astype(np.uint64) for _ in range(40)]
    ids = np.arange(40) * 3
    small = {}
    for i in range(40):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                small.setdefault(i, []).append(j)
    label = list(range(40))
    for _ in range(40):
        for i, js in small.items():
            for j in js:
                label[i] = label[j] = min(label[i], label[j])
    want = {int(ids[i]): int(ids[label[i]]) for i in range(40) if label[i] != i}
    assert dict(chosen_path.node_links(ids, sets, 85)) == want


# --- op10 ------------------------------------------------------------------------

def plain_contamination(texts, items):
    import regex
    split = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    out = {}
    for i, t in texts.items():
        w = split.findall((t or "").translate(low))
        hit, found = set(), set()
        for item, q in items:
            b = split.findall((q or "").translate(low))
            n = min(10, len(b))
            for s in range(len(b) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == b[s:s + n]:
                        hit |= set(range(p, p + n))
                        found.add(item)
        found.discard(None)
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block", [2_000_000, 100])
def test_decontamination_equals_plain(spark, block):
    rng = random.Random(6)
    items = [(f"q{i}", prose(rng, rng.randrange(1, 25), 60)) for i in range(12)] + [("q3", "w1 w2"), (None, "W5, w6"), ("e", ""), ("n", None)]
    texts = {i: prose(rng, 60, 60) + ". " + (items[i % 12][1].upper() if i % 2 else "") + "-" + prose(rng, 20, 60) for i in range(20)}
    texts |= {20: None, 21: "", 22: items[0][1]}
    bench = spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "'x' as doc_id")
    got = by_id(decontaminate.contamination(documents(spark, texts, extra=True), bench, block_terms=block))
    want = plain_contamination(texts, items)
    assert {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in got.items()} == want
    flags = by_id(decontaminate.flag_contaminated(documents(spark, texts), bench, block_terms=block))
    assert {i: r.contaminated for i, r in flags.items()} == {i: v[4] for i, v in want.items()}


def test_decontamination_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    docs = documents(spark, {1: "a b c"})
    assert [(r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, none).collect()] == [(3, 0, False)]
    assert decontaminate.contamination(documents(spark, []), none).count() == 0


@pytest.mark.parametrize("block", [2_000_000, 5, 60])
def test_each_row_keeps_its_matches_at_any_block_size(spark, block):
    items = [(f"q{i}", f"k{i} a{i} b{i} c{i}") for i in range(6)]
    rows = [(1, "x k0 a0 b0 c0"), (1, "k1 a1 b1 c1 y"), (None, "k2 a2 b2 c2"), (None, "nothing at all"), (None, "k3, A3. b3 c3 k4 a4 b4 c4")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row_f"), bench, block_terms=block).collect()
    assert sorted(((r.doc_id or 0), r.n_words, r.n_hit, r.n_items) for r in got) == [(0, 3, 0, 0), (0, 4, 4, 1), (0, 8, 8, 2), (1, 5, 4, 1), (1, 5, 4, 1)]


def plain_near(texts, items, slack=20):
    """Items with a window whose words all lie in some span of ``slack`` words."""
    out = {}
    for i, t in texts.items():
        w, found = (t or "").lower().split(), set()
        spans = [set(w[p:p + slack]) for p in range(len(w))]
        for item, q in items:
            b = q.lower().split()
            n = min(10, len(b))
            if any(set(b[s:s + n]) <= span for s in range(len(b) - n + 1 if n else 0) for span in spans):
                found.add(item)
        out[i] = len(found)
    return out


@pytest.mark.parametrize("block", [2_000_000, 150])
def test_proximity_equals_plain(spark, block):
    rng = random.Random(16)
    items = [(f"q{i}", prose(rng, rng.randrange(1, 16), 25)) for i in range(15)]
    texts = {i: prose(rng, rng.randrange(5, 120), 30) for i in range(40)} | {50: "", 51: None, 52: items[0][1]}
    for i in range(60, 75):             # a window's words, shuffled and thinned out
        w = items[i - 60][1].split()[:10]
        w += [f"o{k}" for k in range(rng.randrange(0, 14))]
        rng.shuffle(w)
        texts[i] = " ".join(w)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = by_id(decontaminate.contamination(documents(spark, texts), bench, block_terms=block))
    want = plain_near(texts, items)
    assert {i: r.n_near_items for i, r in got.items()} == want and len(set(want.values())) > 3


def test_proximity_finds_shuffled_items(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    mixed = "kappa iota theta x eta zeta epsilon y delta gamma beta alpha"
    bench = spark.createDataFrame([("q", item)], "item_id string, text string")
    got = by_id(decontaminate.contamination(documents(spark, {1: mixed, 2: "alpha beta gamma", 3: item}), bench))
    assert [(got[i].n_hit, got[i].n_near_items) for i in (1, 2, 3)] == [(0, 1), (0, 0), (10, 1)]


def test_registered_proximity_query(spark, tmp_path):
    import __spark_entry__ as entry
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    mixed = "kappa iota theta x eta zeta epsilon y delta gamma beta alpha"
    spark.createDataFrame([("q", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents(spark, {1: mixed, 2: "alpha beta gamma", 3: item}).write.parquet(f"{tmp_path}/documents.parquet")
    found = entry.queries()["op10_proximity"](spark, str(tmp_path))
    exact = entry.queries()["op10_decontamination"](spark, str(tmp_path))
    assert found.columns == [*exact.columns, "n_near_items"]
    assert sorted(found.drop("n_near_items").collect()) == sorted(exact.collect())
    assert {i: r.n_near_items for i, r in by_id(found).items()} == {1: 1, 2: 0, 3: 1}


# --- op6 -------------------------------------------------------------------------

def lm_texts():
    rng = random.Random(7)
    texts = {i: " ".join(["the cat sat on the mat", "der Hund lief weg"][i % 2] for _ in range(6)) + " " + prose(rng, 30, 300) for i in range(200)}
    return texts | {900: "", 901: None, 902: "new words only here", 903: prose(rng, 5000, 100)}


@pytest.mark.parametrize("known", [1 << 18, 16])
def test_language_model(spark, monkeypatch, known):
    from collections import Counter
    from math import log10
    texts = lm_texts()
    monkeypatch.setattr(maxent.vocabulary, "__defaults__", (known,))
    got = by_id(maxent.model_scores(documents(spark, texts, extra=True)))
    toks = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c = Counter(x for i, t in toks.items() if not held[i] for x in t)
    n, v = sum(c.values()), len(c)
    for i, t in toks.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(c[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), rel=1e-9)
        assert r.score < 0
    # on held-out documents the contexts tell more than the counts
    out = [i for i in texts if held[i] and i < 900]
    assert sum(got[i].score for i in out) > 0.9 * sum(got[i].base_score for i in out)


def test_language_model_is_a_distribution(spark):
    docs = documents(spark, lm_texts()).select("doc_id", "text")
    counts = maxent.staged(maxent.count_words(docs), "test-counts")
    vocab = maxent.vocabulary(counts)
    weights = maxent.train(docs, vocab, rounds=1)
    rows = maxent.context(np.arange(9, dtype=np.uint64), np.zeros(9, np.int64))
    p = maxent.softmax(weights, vocab.bias, rows)
    cls = np.where(np.isin(np.arange(len(vocab.known)), np.flatnonzero(vocab.single)), vocab.single, 0)
    by_hash = {r.wh: (r.ending, r.c) for r in counts.collect()}
    total = p @ vocab.unknown
    for k, h in enumerate(vocab.known.view(np.int64)):
        ending, c = by_hash[int(h)]
        own = cls[k] or (0 if ending < 0 else 1 + maxent.SINGLES + ending)
        total += p[:, own] * (1 - vocab.unknown[own]) * c / vocab.mass[own]
    assert total == pytest.approx(np.ones(9), abs=1e-3)


def test_a_word_given_its_class_depends_on_the_context(spark):
    # "wbar" and "vbar" end alike and are no class of their own: only the word before tells them apart
    rng = random.Random(3)
    fill = [f"f{k:02d}" for k in range(30)]
    pair = lambda: [rng.choice(["one wbar", "two vbar"])] * (rng.random() < 0.2)
    texts = {i: " ".join(w for _ in range(20) for w in (*pair(), *rng.sample(fill, 4))) for i in range(300)}
    held = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 5 == 1]
    texts |= {held[0]: "one wbar", held[1]: "one vbar", held[2]: "two vbar", held[3]: "two wbar"}
    got = by_id(maxent.model_scores(documents(spark, texts)))
    right, wrong = got[held[0]].score + got[held[2]].score, got[held[1]].score + got[held[3]].score
    assert right > wrong + 1
    assert got[held[0]].base_score + got[held[2]].base_score == pytest.approx(got[held[1]].base_score + got[held[3]].base_score)


@pytest.mark.parametrize("known", [1 << 18, 60, 1])
def test_words_of_a_class_share_one_in_any_context(spark, known):
    docs = documents(spark, lm_texts()).select("doc_id", "text")
    counts = maxent.staged(maxent.count_words(docs), "test-counts")
    vocab = maxent.vocabulary(counts, known)
    by_class, by_word = maxent.two_tables(maxent.train(docs, vocab, rounds=1))
    keys = maxent.context_keys(np.arange(5, dtype=np.uint64), np.zeros(5, np.int64))
    # all leaves: the known words and the rest of each class that has one
    own = vocab.classes(vocab.known, np.array([{r.wh: r.ending for r in counts.collect()}[int(h)] for h in vocab.known.view(np.int64)]))[0]
    rest = np.flatnonzero(vocab.rest > 0)
    leaf = np.concatenate([np.arange(len(own)), len(own) + rest])
    cls = np.concatenate([own, rest])
    assert vocab.rest.min() >= 0 and vocab.rest.sum() + vocab.count.sum() == vocab.total
    unlike = 0
    for k in range(5):
        at, node, taken = vocab.steps(leaf)
        rows = maxent.word_rows(np.repeat(keys[:, k:k + 1], len(leaf), axis=1), at, node)
        p = maxent.softmax(by_word, vocab.node_bias[node], rows)
        z, total = maxent.products(maxent.exponentials(by_word), np.exp(vocab.node_bias)[node], rows)
        assert z / total[:, None] == pytest.approx(p, abs=1e-3)
        share = np.exp(np.bincount(at, np.log(p[np.arange(len(p)), taken]), len(leaf)))
        total = np.bincount(cls, share, maxent.CLASSES)
        assert total[np.unique(cls)] == pytest.approx(np.ones(len(np.unique(cls))), abs=1e-3)
        unlike += not k or np.abs(share - before).max() > 0.01
        before = share
    assert unlike == 5 or known == 1
    # the weights started from the words' frequencies
    count = np.concatenate([vocab.count, vocab.rest[rest]])
    at, node, taken = vocab.steps(leaf)
    flat = np.exp(np.bincount(at, vocab.node_bias[node, taken], len(leaf)))
    assert flat == pytest.approx(count / vocab.mass[cls], rel=1e-4)


def test_known_words_are_found_at_any_number_of_them():
    rng = np.random.default_rng(4)
    none = np.zeros(0)
    for n in (0, 1, 2, 3, 100, 5000):
        known = np.sort(np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)))
        vocab = maxent.Vocabulary(known, *[none] * 2, 0, 0, *[none] * 6)
        h = np.concatenate([known, known + np.uint64(1), known - np.uint64(1), np.array([0, (1 << 64) - 1], np.uint64)])
        at, there = vocab.look(h)
        assert (there == np.isin(h, known)).all() and (not n or (known[at[there]] == h[there]).all())


def test_sums_of_runs_of_any_length():
    rng = np.random.default_rng(5)
    n = maxent.LONG_RUN
    count = np.array([5 * n, n + 1, 3 * n, n, n - 1, 7, 2, 2, 1])
    rows = rng.random((count.sum(), 16)).astype(np.float32)
    order = rng.permutation(len(rows))
    begin = np.cumsum(count) - count
    got = maxent._sum_runs(rows, order, begin, count, maxent.Room(16))
    assert got == pytest.approx(np.add.reduceat(rows[order].astype(float), begin, axis=0), rel=1e-5)


def test_language_model_empty(spark):
    assert maxent.model_scores(documents(spark, [])).count() == 0


def test_repeated_and_null_ids_are_scored_each(spark):
    rows = [(1, "w1 w2 w3"), (1, "w1 never seen"), (None, "w2 w2"), (None, "w2 w2"), (None, None)] + [(i, f"w{i % 9} w{i % 7} w3") for i in range(10, 40)]
    got = maxent.model_scores(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row_i")).collect()
    assert len(got) == len(rows)
    mine = sorted((r.doc_id or 0, r.n_tokens) for r in got if r.doc_id in (1, None))
    assert mine == [(0, 1), (0, 3), (0, 3), (1, 4), (1, 4)]
    assert len({r.score for r in got if r.doc_id is None and r.n_tokens == 3}) == 1
