"""Spellings of dates: one parse a value, files read in their own way."""

import datetime as dt

from pyspark.sql import functions as F

from trimatch.functions.dates import DEFAULT_FORMATS, safe_timestamp
from trimatch.operators.date_forms import date_shapes, parse_dates

AWKWARD = ["2025-02-30", "2025-13-01", "2025-01-02 24:00:00", "2025-01-02 23:59:59", "2025-01-02 23:59:59.5", "2025-01-02 23:59:59.123456",
           "2025/01/02", "2025/01/02 03:04:05", "20250102", "2025-01-02T03:04:05", "", "  2025-01-02  ", "2025-1-2", "junk", "12345678", None,
           "2025-01-02 03:04", "0000-01-01", "1900-02-29", "2000-02-29", "2025-01-02 03:04:05 ", "2025-01/02", "９９９９-01-01", "2025-01-02 03:04:05.1234567"]


def test_one_parse_equals_trying_all_formats(spark):
    df = spark.createDataFrame([(t,) for t in AWKWARD], "t string")
    tried = F.coalesce(*[F.try_to_timestamp(F.trim("t"), F.lit(f)) for f in DEFAULT_FORMATS])
    for r in df.select("t", safe_timestamp("t").cast("string").alias("one"), tried.cast("string").alias("all")).collect():
        assert r["one"] == r["all"], r


def test_files_vote_on_day_or_month_first(spark):
    rows = [("d", "03/04/2025"), ("d", "25/04/2025"), ("m", "03/04/2025"), ("m", "04/25/2025 10:11"), ("none", "03/04/2025"), (None, "31.12.2024"), (None, "01.12.2024"),
            ("d", None), ("d", "45/45/2025"), ("d", "2025年3月4日"), ("m", "20250304050607"), ("m", "2025-03-04T05:06:07.25"), ("m", "12:30"), ("m", "2025"), ("m", "0000-01-01")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "src_file string, t string, __other string")
    got = {(r["src_file"], s): r["t"] for r, (_, s) in zip(parse_dates(df.withColumn("n", F.monotonically_increasing_id()), ["t"]).orderBy("n").collect(), rows)}
    D = dt.datetime
    assert got == {("d", "03/04/2025"): D(2025, 4, 3), ("d", "25/04/2025"): D(2025, 4, 25), ("m", "03/04/2025"): D(2025, 3, 4),
                   ("m", "04/25/2025 10:11"): D(2025, 4, 25, 10, 11), ("none", "03/04/2025"): D(2025, 3, 4), (None, "31.12.2024"): D(2024, 12, 31),
                   (None, "01.12.2024"): D(2024, 12, 1), ("d", None): None, ("d", "45/45/2025"): None, ("d", "2025年3月4日"): D(2025, 3, 4),
                   ("m", "20250304050607"): D(2025, 3, 4, 5, 6, 7), ("m", "2025-03-04T05:06:07.25"): D(2025, 3, 4, 5, 6, 7, 250000),
                   ("m", "12:30"): None, ("m", "2025"): None, ("m", "0000-01-01"): None}
    shapes = {(r["src_file"], r["shape"]): (r["n_rows"], r["unread"]) for r in date_shapes(df, ["t"]).collect()}
    assert shapes["d", "99/99/9999"] == (3, 1) and shapes["m", "99:99"] == (1, 1) and shapes["m", "9999-99-99A99:99:99.99"] == (1, 0)
    assert parse_dates(df.limit(0), ["t"]).count() == 0 and parse_dates(df.withColumn("t", F.current_timestamp()), ["t"]).count() == len(rows)
