"""What must not grow with the input in one task or on disk."""

import glob
import os

from pyspark.sql import functions as F

from trimatch.operators.repair import repair_shift
from trimatch.plans import queries as Q
from trimatch.sources import dump
from trimatch.sources import tpch_legs as L

SF = "/root/testdata/sf0.001"
TRAP = "ਅ一"          # its bytes hold a line end, little endian


def _set(spark, conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return before


def _folders(folder, name):
    return [f for f in glob.glob(f"{folder}/{name}-*") if "values" not in f]


def test_rows_are_not_shuffled_by_file(spark):
    before = _set(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    try:
        lg = L.legs(spark, SF)
        parsed = dump.stage_parse(L.order_dump(lg.orders), "t")
        shifted = L.shifted_delivery_file(lg.deliveries)
        plain = spark.createDataFrame([("f", "1", "DD1")], "src_file string, order_no string, item_code string")
        for df in (dump.order_rows(parsed), dump.rows_with_header(spark, parsed, dump.ORDER_COLS_HEADERLESS, pad_from=11),
                   dump.repaired_delivery_rows(dump.stage_parse(L.values_lines(shifted, dump.DELIVERY_COLS_7), "t")), repair_shift(plain)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        _set(spark, before)


def test_folder_of_dumps_is_written_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("trimatch.operators.numbering.checkpoint_dir", lambda _: str(tmp_path))
    before = _set(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    try:
        got = {tuple(r) for r in Q.first_value_folder(spark, SF).collect()}
        (folder,) = _folders(tmp_path, "months")
        assert len(glob.glob(f"{folder}/f=03/part-*")) > 1          # no task holds a whole file
        k = F.col("src_pos")
        place = F.struct(F.when(k % 97 == 0, 1).when(k % 7 == 0, 2).otherwise(3), k)
        want = L.legs(spark, SF).orders.groupBy("sale_order_no").agg(
            F.min_by("order_status", F.when(F.col("order_status").isNotNull(), place)), F.min_by("item_code", place), F.count(F.lit(1)))
        assert got == {tuple(r) for r in want.collect()}
    finally:
        _set(spark, before)


def test_folder_of_dumps_and_their_parse_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("trimatch.operators.numbering.checkpoint_dir", lambda _: str(tmp_path))
    rows = Q.first_value_folder(spark, SF)
    (folder,) = _folders(tmp_path, "months")
    files = glob.glob(f"{folder}/f=*/part-*")
    lines = spark.read.text(folder)
    assert files and sum(os.path.getsize(f) for f in files) < 0.5 * lines.agg(F.sum(F.length("value") + 1)).first()[0]
    assert max(r["n"] for r in lines.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) <= 200_000     # each is read whole
    assert all(".zstd." in f for f in glob.glob(f"{tmp_path}/months-values-*/part-*"))
    assert rows.agg(F.sum("n_rows")).first()[0] == lines.count()


def test_only_false_cuts_are_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("trimatch.operators.numbering.checkpoint_dir", lambda _: str(tmp_path / "work"))
    lines = [f"row {i} " + "x" * (i % 7) for i in range(4000)]
    lines[17] = f"a{TRAP}b"
    lines[2500] = f"a{TRAP}{TRAP}b"
    (tmp_path / "d.sql").write_bytes("".join(x + "\n" for x in lines).encode("UTF-16LE"))
    got = dump.read_lines(spark, str(tmp_path / "d.sql"), "UTF-16LE").orderBy("src_pos").collect()
    (pieces,) = _folders(tmp_path / "work", "pieces")
    assert [r["line"] for r in got] == lines
    assert spark.read.parquet(pieces).count() == 4                  # of 4003: the two ends at each trapped line


def test_pieces_inside_a_code_unit_over_splits(spark, tmp_path):
    lines = [f"{i}" + "x" * (i % 5) + (TRAP + "y" * (i % 3)) * (i % 4) for i in range(24)]
    for charset in ("UTF-16LE", "UTF-32LE"):
        folder = tmp_path / charset
        folder.mkdir()
        for f in ("a", "b"):
            (folder / f).write_bytes("".join(x + f + "\n" for x in lines).encode(charset))
        before = _set(spark, {"spark.sql.files.maxPartitionBytes": "203"})
        try:
            got = [r["line"] for r in dump.read_lines(spark, str(folder), charset).orderBy("src_pos").collect()]
        finally:
            _set(spark, before)
        assert got == [x + f for f in ("a", "b") for x in lines]


def test_dump_builders_read_the_legs_once(spark):
    lg = L.legs(spark, SF)
    for df, of in ((L.order_dump(lg.orders), lg.orders), (L.delivery_dump(lg.deliveries), lg.deliveries), (L.headed_dump(lg.orders), lg.orders)):
        scans = [x._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") for x in (df, of)]
        assert scans[0] == scans[1]


def test_shared_legs_join_the_tables_once(spark):
    lg = L.shared_legs(spark, SF)
    for df, want in zip((lg.orders, lg.deliveries, lg.invoices), (L.legs(spark, SF).orders, L.legs(spark, SF).deliveries, L.legs(spark, SF).invoices), strict=True):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
