"""Row numbers against a plain sort; exact report parts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from trimatch.operators.numbering import number_rows
from trimatch.plans.report import report_parts, write_report


def test_numbers_equal_a_plain_sort(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = number_rows(df, ["v", F.desc("i")], ["g"], unique=True).collect()
    for g in ("a", "b", None):
        want = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, -r[2]))
        assert [(r.g, r.v, r.i) for r in sorted((r for r in got if r.g == g), key=lambda r: r.row_no)] == want
        assert sorted(r.row_no for r in got if r.g == g) == list(range(len(want)))


def test_equal_rows_fill_several_ranges(spark):
    df = spark.range(0, 4000, 1, 6).select(F.lit("x").alias("g"), F.lit(None).cast("int").alias("__no"), F.lit(1).alias("row"))
    got = number_rows(df, ["g"], out="n", partitions=8)
    assert sorted(r.n for r in got.collect()) == list(range(4000))
    assert got.columns == ["g", "__no", "row", "n"]
    sizes = [len(p) for p in df.repartitionByRange(8, "g").rdd.glom().collect()]
    assert max(sizes) == 4000            # one range without the written places


def test_empty_table_has_no_numbers(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert number_rows(df, ["v"], ["g"]).count() == 0 and number_rows(df, ["v"]).count() == 0


def _detail(spark, n):
    return spark.range(n).select(
        F.format_string("DD%05d", F.col("id") % 700).alias("order_no"), F.col("id").cast("string").alias("item_code"),
        F.when(F.col("id") % 3 == 0, "1240").when(F.col("id") % 3 == 1, "9999").alias("inv_sales_org"),
        F.when(F.col("id") % 5 < 3, "1.1完全匹配").otherwise("2.Not test").alias("category"),
        F.lit("1.00").cast("decimal(28,2)").alias("invoice_amount"))


def test_parts_are_exact(spark):
    parts = report_parts(_detail(spark, 3000), 100)
    n = Counter((r.org_group, r.category, r.part) for r in parts.collect())
    groups = {k[:2] for k in n}
    assert len(groups) == 4 and sum(n.values()) == 3000
    for g in groups:
        sizes = [n[k] for k in sorted(k for k in n if k[:2] == g)]
        assert sizes[:-1] == [100] * (len(sizes) - 1) and 0 < sizes[-1] <= 100
    first = [r for r in parts.collect() if (r.org_group, r.category, r.part) == ("other", "1.1完全匹配", 1)]
    rest = [r for r in parts.collect() if (r.org_group, r.category) == ("other", "1.1完全匹配") and r.part > 1]
    assert max((r.order_no, r.item_code) for r in first) < min((r.order_no, r.item_code) for r in rest)


def test_written_parts_are_files_of_the_cap(spark, tmp_path):
    counts = write_report(_detail(spark, 1000), str(tmp_path / "r"), max_rows=150)
    assert counts["全部数据"] == 1000
    files = spark.read.parquet(str(tmp_path / "r" / "detail")).groupBy("org_group", "category", "part", F.input_file_name().alias("f")).count().collect()
    by_part = Counter((r.org_group, r.category, r.part) for r in files)
    assert max(by_part.values()) == 1                      # a part is one file
    for g in {k[:2] for k in by_part}:
        sizes = [r["count"] for r in sorted((r for r in files if (r.org_group, r.category) == g), key=lambda r: r.part)]
        assert sizes[:-1] == [150] * (len(sizes) - 1) and 0 < sizes[-1] <= 150
