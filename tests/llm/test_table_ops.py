import random
import re
import zlib

import numpy as np
import pytest
from helpers_llm import by_id, documents, prose

from trimatch.llm import ann, chat, packing, pii, quality, token_files


# --- op1 -------------------------------------------------------------------------

def plain_best_fit(pieces, capacity):
    bins = []
    for k, (size, source, cluster) in enumerate(pieces):
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= size
                and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        if fits:
            b = bins[min(fits)[1]]
        else:
            b = {"room": capacity, "s": set(), "c": set(), "k": []}
            bins.append(b)
        b["k"].append(k)
        b["room"] -= size
        b["s"].add(source)
        b["c"].add(cluster)
    return [b["k"] for b in bins]


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_full_search(seed):
    rng = random.Random(seed)
    pieces = [(rng.randrange(0, 60), rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([1, 2, 3, None, *range(10, 60)])) for _ in range(300)]
    assert packing.best_fit(pieces, 100) == plain_best_fit(pieces, 100)


def test_packing_keeps_all_tokens_and_conflicts_apart(spark):
    rng = random.Random(1)
    texts = {i: prose(rng, rng.randrange(0, 150)) for i in range(200)} | {300: prose(rng, 1000), 301: None, 302: "", 303: "same text", 304: "same  TEXT"}
    df = packing.with_tokens(documents(spark, texts, extra=True))
    rows = packing.pack(df, capacity=256, cell_rows=64).collect()
    got, bins = {}, {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.token_start, r.n_tokens))
        bins.setdefault(r.bin_id, []).append(r)
    for i, t in texts.items():
        n, spans = len((t or "").split()), sorted(got[i])
        assert sum(x[1] for x in spans) == n and all(a + b == c for (a, b), (c, _) in zip(spans, spans[1:]))
    for members in bins.values():
        assert sum(r.n_tokens for r in members) == members[0].bin_tokens <= 256
        for c in ("source", "cluster"):
            v = [r[c] for r in members if r[c] is not None]
            assert len(v) == len(set(v))
    assert len({r.bin_id >> 32 for r in rows}) > 1


def test_packing_empty_and_null(spark):
    assert packing.pack(packing.with_tokens(documents(spark, []))).count() == 0
    df = spark.createDataFrame([(None, None, None), (None, "a b", "s")], "doc_id long, text string, source string")
    assert sorted(r.n_tokens for r in packing.pack(packing.with_tokens(df)).collect()) == [0, 2]


# --- op2 -------------------------------------------------------------------------

def plain_dialogue(turns):
    """perspective -> (text, text under the mask)."""
    out = {}
    for me in sorted({r for _, r, _ in turns if r != "system"}):
        text = mask = ""
        for _, role, t in sorted(turns):
            head = "system" if role == "system" else "assistant" if role == me else f"user name={role}"
            text += f"<|im_start|>{head}\n{t}<|im_end|>\n"
            mask += t if role == me else ""
        out[me] = (text, mask)
    return out


@pytest.mark.parametrize("run", [256, 3])
def test_perspectives_render_whole_dialogues(spark, run):
    rng = random.Random(2)
    convs = {c: [(t, rng.choice(["ann", "bob", "cy", "system"]), prose(rng, rng.randrange(0, 6))) for t in range(rng.randrange(1, 30))] for c in range(15)}
    convs[99] = [(t, "ann" if t % 2 else "bob", f"t{t}") for t in range(900)]
    rows = [(c, t, r, x, "clash") for c, ts in convs.items() for t, r, x in ts]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, perspective string")
    got = {}
    for r in chat.perspectives(df, run=run).orderBy("conv_id", "perspective", "seq").collect():
        text, mask, n = got.get((r.conv_id, r.perspective), ("", "", 0))
        assert r.char_start == len(text) and r.seq == n + 1
        full = text + r.rendered
        got[r.conv_id, r.perspective] = (full, mask + full[r.mask_start:r.mask_end], n + 1)
    assert {k: v[:2] for k, v in got.items()} == {(c, p): v for c, ts in convs.items() for p, v in plain_dialogue(ts).items()}


def test_perspectives_edge_cases(spark):
    kind = "conv_id long, turn int, role string, text string"
    assert chat.perspectives(spark.createDataFrame([], kind)).count() == 0
    df = spark.createDataFrame([(None, None, None, None), (1, 0, "system", "s"), (2, 0, "a", "x"), (2, 0, "a", "x")], kind)
    got = chat.perspectives(df).collect()
    assert sorted((r.conv_id or 0, r.perspective, r.seq) for r in got) == [(0, "unknown", 1), (2, "a", 1), (2, "a", 2)]


# --- op3 -------------------------------------------------------------------------

def test_tree_search_recall_and_order(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 16))
    x = (centers[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[1000:2000] = x[1000]                       # a vector that a third of all rows share
    rows = [(i, v.tolist(), "q") for i, v in enumerate(x)]
    rows += [(5000, None, "q"), (5020, [0.0] * 16, "q"), (5040, [float("nan")] + [1.0] * 15, "q"), (5060, [1.0, 2.0], "q"),
             (5080, [None] + [1.0] * 15, "q"), (None, [1.0] * 16, "q"), (5100, [], "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = ann.nearest(df, df.filter("vec_id % 100 = 0"), k=20, leaf_rows=64).toPandas()
    y, hit, n = x.astype(float), 0, 0
    for q in range(0, 3000, 100):
        s = y @ y[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -s))[:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine.score, s[mine.vec_id])
        assert list(zip(-mine.score, mine.vec_id)) == sorted(zip(-mine.score, mine.vec_id))
        hit += np.isclose(np.sort(mine.score), np.sort(s[want])).sum()
        n += 20
    assert hit / n >= 0.9 and set(got.query_id) == set(range(0, 3000, 100))


def test_tree_search_small_and_empty(spark):
    kind = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], kind), spark.createDataFrame([], kind)).count() == 0
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], kind)
    got = ann.nearest(df, df.filter("vec_id = 0")).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(i, i, 1.0) for i in range(1, 5)]


# --- op5 -------------------------------------------------------------------------

def test_feistel_is_a_permutation():
    for n in (1, 2, 10, 97, 1000):
        assert sorted(pii.permute(i, n, b"k" * 32, b"t") for i in range(n)) == list(range(n))
    assert [pii.permute(i, 1000, b"k" * 32, b"t") for i in range(9)] != [pii.permute(i, 1000, b"j" * 32, b"t") for i in range(9)]


VALID = {
    "card": ["4539578763621486", "4539 5787 6362 1486", "371449635398431"], "ssn": ["123-45-6789", "899-99-9999"],
    "ipv4": ["97.51.17.173", "0.0.0.0"], "date": ["2021-02-28", "12/31/1999", "31/12/1999", "28.02.2020"],
    "phone": ["+1 (017) 555-7713", "(212) 555-0199"], "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "email": ["und.34@mail7.example.com", "été.12@mail1.example.com"], "secret": ['"04dbebab91ab85687d33eeaaf9ac699e1188f962"'],
}


@pytest.mark.parametrize("kind", VALID)
def test_pseudonyms_are_valid_and_linked(kind):
    change = pii.Pseudonymizer(b"key")
    for old in VALID[kind]:
        text, spans = change.apply(f"a {old} b {old}.")
        assert [s[2] for s in spans] == [kind, kind]
        one, two = (text[s:e] for s, e, _ in spans)
        assert one == two and one != old.strip('"') and old.strip('"') not in text
        if kind != "ipv4":      # the same format, character by character
            assert re.sub(r"\d", "9", re.sub("[A-Za-z]", "x", one)) == re.sub(r"\d", "9", re.sub(r"[^\W\d_]", "x", old.strip('"'))) or kind in ("secret", "iban")
        again, found = change.apply(one if kind != "secret" else f'"{one}"')     # what comes out is valid too
        assert [f[2] for f in found] == [kind] and again != one


def test_invalid_numbers_stay():
    text = "1234567890123456 300.1.1.1 2021-02-30 000-12-3456 GB00WEST12345698765432 4.0 v1.2.3 12345"
    assert pii.Pseudonymizer(b"key").apply(text) == (text, [])


@pytest.mark.parametrize("text,kind,old", [
    ("BE68539007547034 EUR", "iban", "BE68539007547034"),
    ("pay ES91 2100 0418 4502 0005 1332 BIC now", "iban", "ES91 2100 0418 4502 0005 1332"),
    ("BE68 5390 0754 7034 EUR TO X", "iban", "BE68 5390 0754 7034"),
    ("ID42 4539 5787 6362 1486", "card", "4539 5787 6362 1486"),
    ("NO42 BE68 5390 0754 7034 EUR", "iban", "BE68 5390 0754 7034"),
])
def test_failed_candidates_hide_nothing(text, kind, old):
    change = pii.Pseudonymizer(b"key")
    new, spans = change.apply(text)
    at = text.index(old)
    assert spans == [(at, at + len(old), kind)] and old not in new
    assert new[:at] == text[:at] and new[at + len(old):] == text[at + len(old):]
    assert new[at:at + len(old)] == change.apply(old)[0]


def test_values_without_digits_are_replaced(spark):
    mail, key = "john.smith@example.com", "abcdefabcdef" * 3
    texts = {1: f"to {mail} now", 2: f"to {mail} now 7", 3: f"key {key} end", 4: f"key {key.upper()} end", 5: "no value"}
    got = by_id(pii.pseudonymize(documents(spark, texts)))
    assert [[x.kind for x in got[i].pii] for i in range(1, 6)] == [["email"], ["email"], ["secret"], ["secret"], []]
    assert got[2].text == got[1].text + " 7" and mail not in got[1].text and got[5].text == "no value"


def test_pseudonymize_table(spark):
    texts = {1: "x 4539578763621486 y", 2: None, 3: "", 4: "plain", 5: "z 4539578763621486", 6: "9 " * 20000 + "97.51.17.173"}
    df = documents(spark, texts, extra=True)
    got = by_id(pii.pseudonymize(df))
    assert got[2].text is None and got[3].text == "" and got[4].text == "plain" and got[1].score == "x"
    assert got[1].text.split()[1] == got[5].text.split()[1] != "4539578763621486"
    assert [len(got[i].pii) for i in sorted(texts)] == [1, 0, 0, 0, 1, 1]
    s = got[6].pii[0]
    assert got[6].text[:s.start] == texts[6][:s.start] and s.end == len(got[6].text)
    assert pii.pseudonymize(documents(spark, [])).count() == 0


# --- op8 -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


ODD = ["a  b", " a", "a ", "a \n b", "it's don't 'x", "a\x1c b", "a\n\nb c", "日本 語 a", "x<|endoftext|> y <|endoftext|>", "12 3.4 ½ ² x²",
       "a\t b", "é̀ à̂ É", "a   b", "a\x85 b", ".. !a b's", "word,\nnext Word. x.\ny", "a\xa0b \xa0 c", "-- a-b c_d", "\n", " ", "ab12cd e3"]


def test_piece_encoder_equals_library(bpe):
    enc = token_files.PieceEncoder(bpe, size=50)
    rng = random.Random(8)
    parts = ODD + ["The", "ereden", "été.", "x!!", "A\nb", "'s", "100%", ""]
    for t in ODD + [" ".join(rng.choice(parts) for _ in range(30)) for _ in range(200)]:
        assert enc.encode(t) == enc.whole(t)


def test_piece_encoder_keeps_to_what_it_knows(bpe, tmp_path):
    """All characters in every place; tokenizers of other kinds go to the library."""
    import json
    enc = token_files.PieceEncoder(bpe, size=5000)
    for c in [*range(1, 0x3100), *range(0x4E00, 0x9FA6, 50), *range(0x1F300, 0x1F700, 9)]:
        t = f"a{chr(c)}1 {chr(c)}{chr(c)}b {chr(c)} x's{chr(c)}"
        assert enc.encode(t) == enc.whole(t), hex(c)
    settings = json.load(open(bpe))
    assert enc.by_piece and token_files.splits_into_pieces(settings)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"pre_tokenizer": settings["pre_tokenizer"] | {"add_prefix_space": True}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(settings | change))
        other = token_files.PieceEncoder(str(path))
        assert not other.by_piece and all(other.encode(t) == other.whole(t) for t in [*ODD, "A Word a word"])


def test_files_follow_ids_and_repeated_rows_are_each_written(spark, bpe, tmp_path):
    rng = random.Random(19)
    rows = [(i % 30 if i % 7 else None, prose(rng, 40), "x") for i in range(200)] + [(5, "same", "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, h string")
    folder = f"file://{tmp_path}/many"
    manifest = token_files.write_token_files(df, bpe, folder, frame_ids=300, file_ids=900)
    assert len(manifest) > 12 and all(m["n_ids"] >= 900 or m["name"].rsplit("-", 1)[0] != n["name"].rsplit("-", 1)[0] for m, n in zip(manifest, manifest[1:]))
    got = sorted(token_files.read_token_files(spark, folder, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None and r.doc_id for r in got] == sorted(i is not None and i for i, *_ in rows)
    enc = token_files.PieceEncoder(bpe)
    assert sorted(bytes(r.ids)[:-4] for r in got) == sorted(enc.whole(t) for _, t, _ in rows)
    assert [r.start for r in got] == [0, *np.cumsum([len(r.ids) // 4 for r in got])[:-1].tolist()]


def test_token_files_round_trip(spark, bpe, tmp_path):
    from tokenizers import Tokenizer
    rng = random.Random(9)
    texts = {i: prose(rng, rng.randrange(0, 80)) for i in range(120)} | {500: None, 501: "", 502: prose(rng, 20000), 503: ODD[4]}
    folder = f"file://{tmp_path}/ids"
    manifest = token_files.write_token_files(documents(spark, texts, extra=True).repartition(5), bpe, folder, frame_ids=256)
    rows = token_files.read_token_files(spark, folder, manifest).collect()
    tok, at = Tokenizer.from_file(bpe), 0
    got = {r.doc_id: r for r in rows}
    for i in sorted(texts):
        ids = [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert got[i].start == at and np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert zlib.crc32(bytes(got[i].ids)) == token_files.crc32_ids(ids)
        at += len(ids)
    assert len(rows) == len(texts) and sum(m["n_ids"] for m in manifest) == at
    some = token_files.read_token_files(spark, folder, manifest, {3, 502}).collect()
    assert {r.doc_id: r.ids for r in some} == {i: got[i].ids for i in (3, 502)}


def test_frames_are_independent_and_checked(tmp_path):
    import io

    import zstandard
    out = io.BytesIO()
    w = token_files.FrameWriter(out, frame_ids=10)
    docs = [(i, np.arange(i * 3, dtype="<u4").tobytes()) for i in range(8)]
    for d in docs:
        w.add(*d)
    w.close()
    raw = out.getvalue()
    # any zstandard reader sees the ids alone: the tables are skippable frames
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(d[1] for d in docs)
    reader = token_files.FrameReader(io.BytesIO(raw), len(raw))
    assert len(reader.seek) > 1 and {i: x.tobytes() for i, _, x in reader.scan({5})} == {5: docs[5][1]}
    bad = bytearray(raw)
    bad[int(reader.at[1]) + 12] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.FrameReader(io.BytesIO(bytes(bad)), len(raw)).scan())


def test_token_files_empty(spark, bpe, tmp_path):
    folder = f"file://{tmp_path}/none"
    manifest = token_files.write_token_files(documents(spark, []), bpe, folder)
    assert manifest == [] and token_files.read_token_files(spark, folder, manifest).count() == 0


# --- op9 -------------------------------------------------------------------------

def test_features_are_those_of_each_text_alone():
    import pyarrow as pa
    from trimatch.llm.common import text_buffer
    texts = ["été a", "", None, "ab ab cd", "x", "ab ab ab"]
    buf, offs = text_buffer(pa.array(texts))
    idx, doc = quality.features(buf, offs)
    for k, t in enumerate(texts):
        b, o = text_buffer(pa.array([t]))
        assert sorted(idx[doc == k]) == sorted(quality.features(b, o)[0])
    # été: one word, <ét été té> <été été> <été> and a: one word, <a>; n-grams are over characters
    assert (doc == 0).sum() == 1 + 3 + 2 + 1 + 1 + 1


def test_quality_learns_and_edges(spark):
    rng = random.Random(10)
    texts = {i: prose(rng, 40) if i % 2 else " ".join(x.upper() + "!!" for x in prose(rng, 40).split()) for i in range(300)}
    docs = documents(spark, texts | {900: None, 901: ""}, extra=True)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in texts] + [(None, 1, 0), (5, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    got = by_id(quality.score(docs, quality.fit(docs, labels)))
    out = [i for i in texts if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i].score >= quality.THRESHOLD) == i % 2 for i in out]) > 0.95
    assert 0 < got[900].score < 1 and got[900].score == got[901].score


def test_quality_without_labels(spark):
    docs = documents(spark, ["a", "b"])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.score(documents(spark, []), quality.fit(docs, none)).count() == 0


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(got) > 50 and np.mean([r.predicted == r.quality for r in got]) > 0.9


def test_dates_of_either_order_and_any_century():
    change = pii.Pseudonymizer(b"key")
    olds = ["12-31-2020", "31-12-2020", "12.31.2020", "12/31/2020", "31/12/2020", "1850-06-15", "06/15/1850", "31-01-0099", "2150-01-01", "9999-12-31"]
    for old in olds:
        new, spans = change.apply(f"on {old}.")
        assert spans == [(3, 13, "date")] and new != f"on {old}."
        years = [int(re.search(r"\d{4}", x).group()) for x in (old, new)]       # the year keeps to its span
        assert len({y // 100 for y in years}) == 1 or all(1900 <= y <= 2099 for y in years)
    assert change.apply("30-30-2020 00-12-2020 0000-01-01")[1] == []


def test_dates_of_a_spelling_never_collide():
    change = pii.Pseudonymizer(b"key")
    for sep in "-./":
        days = [f"{a:02d}{sep}{b:02d}{sep}1850" for a in range(1, 32) for b in range(1, 32)]
        olds = [d for d in days if change.apply(d)[1]]
        news = [change.apply(d)[0] for d in olds]
        assert len(olds) > 365 and len(set(news)) == len(news) and all(change.apply(n)[1] for n in news)


def test_the_session_names_the_key(spark):
    df = documents(spark, ["born 1990-02-03"])
    plain = by_id(pii.pseudonymize(df))
    spark.conf.set(pii.KEY_SETTING, "another")
    try:
        own = by_id(pii.pseudonymize(df))
    finally:
        spark.conf.unset(pii.KEY_SETTING)
    assert plain != own and own == by_id(pii.pseudonymize(df, b"another"))
