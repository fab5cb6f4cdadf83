"""The driver queries of the subpackage and the pipeline."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from oracle_harness import duck, rows_of  # noqa: E402

from trimatch.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    import __spark_entry__ as entry
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duck(SF)
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    cols = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert rows_of(got.columns, got.collect()) == rows_of(cols, want.fetchall())


def test_stages_take_effect(spark):
    """Each stage gets what its predecessor kept, and gives documents (the last: pieces)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "pii", "pack"]
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        kept = {r.doc_id for r in rows}
        assert kept <= ids
        if name in ("quality", "near_duplicates"):
            assert kept < ids
        if name in ("pii", "pack"):
            assert kept == ids
        if name != "pack":
            assert out.columns == docs.columns and len(rows) == len(kept)
            docs = spark.createDataFrame(rows, docs.schema)
        ids = kept


def test_pipeline_runs_on_empty_documents(spark, tmp_path):
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


ROWS = "doc_id long, text string, lang string, source string, n_chars int, row_no int, score string, contaminated string"


def rows_for(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", "y") for i, t in rows], ROWS)


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    one, two = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, one), (1, one), (2, one), (None, one), (None, one), (None, two), (None, two + " end"), (7, None), (7, None), (8, "")]
    out = corpus_pipeline.one_of_each_group(spark, rows_for(spark, rows).repartition(4), SF)
    got = sorted(((r.doc_id or 0), r.text or "") for r in out.collect())
    assert out.columns == corpus_pipeline.COLUMNS
    assert len(got) == 5 and (1, one) in got and [g for g in got if g[0] >= 7] == [(7, ""), (7, ""), (8, "")]
    assert [g[1] in (two, two + " end") for g in got if g[0] == 0] == [True]


def test_stages_keep_rows_apart(spark):
    """Nulls, repeated rows and clashing names in the other stages."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    plain = "The quick report of the town council says that all roads will be mended before the winter comes."
    rows = [(1, plain), (1, plain), (None, plain), (None, None), (3, ""), (4, item), (4, plain), (5, plain + " call me at a.b@example.com"), (5, plain + " call me at a.b@example.com")]
    docs = rows_for(spark, rows)
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted((i or 0, t or "") for i, t in rows if t != item)
    hidden = corpus_pipeline.hide_personal(spark, docs, SF)
    got = hidden.collect()
    assert hidden.columns == corpus_pipeline.COLUMNS and len(got) == len(rows)
    assert all((r.text is None) == (r.n_chars is None) and (r.text is None or r.n_chars == len(r.text)) for r in got)
    assert len({r.text for r in got if r.doc_id == 5}) == 1 and not any("a.b@example.com" in (r.text or "") for r in got)
    assert sum(r.text is None for r in got) == 1
    scored = corpus_pipeline.quality_filter(spark, docs, SF)
    by_text = {}
    for r in scored.collect():
        by_text[r.text] = by_text.get(r.text, 0) + 1
    assert all(n == sum(t == text for _, t in rows) for text, n in by_text.items())
    packed = corpus_pipeline.pack_sequences(spark, docs, SF)
    assert packed.agg({"n_tokens": "sum"}).first()[0] == sum(len((t or "").split()) for _, t in rows)
