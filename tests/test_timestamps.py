from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import at
from tickbars import Settings
from tickbars.functions.fields import file_date, lenient_bigint, lenient_double_text
from tickbars.functions.timestamps import floor_minutes, parse_timestamp, to_local, to_utc

ZONE = "Asia/Karachi"
INSTANT = at("2026-06-19T04:17:00")


def parsed(spark, texts, fmt, zone=ZONE):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    out = frame.select("i", parse_timestamp(F.col("t"), fmt, zone).alias("ts")).orderBy("i")
    return [r.ts for r in out.collect()]


@pytest.mark.parametrize(
    ("fmt", "text"),
    [
        ("epoch_s", "1781842620"),
        ("epoch_ms", "1781842620000"),
        ("naive_utc", "2026-06-19 04:17:00"),
        ("naive_local", "2026-06-19 09:17:00"),
        ("iso", "2026-06-19T09:17:00+05:00"),
        ("iso", "2026-06-19T09:17:00+0500"),
        ("iso", "2026-06-19T04:17:00Z"),
        ("iso", "2026-06-19 04:17:00"),
        ("iso", "2026-06-18T23:17:00-05:00"),
        ("auto", "1781842620"),
        ("auto", "1781842620.0"),
        ("auto", "1781842620000"),
        ("auto", "2026-06-19 04:17:00"),
        ("auto", "2026-06-19T04:17:00"),
        ("auto", "2026-06-19 04:17:00Z"),
        ("auto", "2026-06-18 23:17:00-05:00"),
    ],
)
def test_one_instant_in_every_encoding(spark, fmt, text):
    assert parsed(spark, [text], fmt) == [INSTANT]


@pytest.mark.parametrize("fmt", ["epoch_s", "epoch_ms", "naive_utc", "naive_local", "iso", "auto"])
def test_unusable_text_is_null(spark, fmt):
    assert parsed(spark, [None, "", "bad", "09:17:00", "2026-13-45 00:00:00"], fmt) == [None] * 5


def test_naive_needs_the_exact_pattern(spark):
    texts = ["2026-06-19", "2026-06-19T04:17:00", "2026-06-19 04:17", "2026-06-19 04:17:00.5"]
    assert parsed(spark, texts, "naive_utc") == [None] * 4


def test_bare_date_is_midnight_in_iso(spark):
    assert parsed(spark, ["2026-06-19"], "iso") == [datetime(2026, 6, 19)]


def test_wall_clock_skipped_in_the_session_zone_survives(spark):
    # New York has no 02:30 on this day; the session zone must not matter.
    assert parsed(spark, ["2026-03-08 02:30:00"], "naive_utc") == [at("2026-03-08T02:30:00")]


def test_epoch_out_of_range_is_null(spark):
    assert parsed(spark, ["99999999999999999", "-99999999999999999"], "epoch_s") == [None, None]


def test_auto_decides_row_by_row(spark):
    texts = ["2026-06-19 04:17:00", None, "1781842620", "2026-06-19T09:17:00+05:00", "1781842620000"]
    assert parsed(spark, texts, "auto") == [INSTANT, None, INSTANT, INSTANT, INSTANT]


def test_unknown_format_fails_when_the_plan_is_built():
    with pytest.raises(ValueError):
        Settings(timestamp_format="julian")


def test_zone_self_test(spark):
    frame = spark.createDataFrame([(INSTANT,)], "t TIMESTAMP_NTZ")
    (local, back) = frame.select(
        to_local(F.col("t"), ZONE), to_utc(to_local(F.col("t"), ZONE), ZONE)
    ).first()
    assert (local, back) == (at("2026-06-19T09:17:00"), INSTANT)


def test_zone_is_a_parameter(spark):
    frame = spark.createDataFrame([(INSTANT,)], "t TIMESTAMP_NTZ")
    assert frame.select(to_local(F.col("t"), "Asia/Kathmandu")).first()[0] == at("2026-06-19T10:02:00")


def test_floor_keeps_the_type(spark):
    frame = spark.createDataFrame([(at("2026-06-19T04:17:59.999999"),)], "t TIMESTAMP_NTZ")
    out = frame.select(floor_minutes(F.col("t"), 5).alias("t"))
    assert out.dtypes == [("t", "timestamp_ntz")]
    assert out.first()[0] == at("2026-06-19T04:15:00")


def test_file_dates(spark):
    names = {
        "ticks_20260619.db": "2026-06-19",
        "/landing/ticks_20260619.db": "2026-06-19",
        "file:/x_2024/1m_20260619.csv": "2026-06-19",
        "x_20260619_v2.db": None,
        "ticks.csv": None,
        "ticks_20261319.db": None,
        "a.20260619.csv": "2026-06-19",
        "12_20260619": "2026-06-19",
    }
    frame = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = {r.n: r.d and str(r.d) for r in frame.select("n", file_date(F.col("n")).alias("d")).collect()}
    assert got == names


def test_lenient_numbers(spark):
    frame = spark.createDataFrame([(t,) for t in ["12.5", " 12 ", "12d", "0x10p1", "NaN", "1e3", "", None]], "t STRING")
    got = [tuple(r) for r in frame.select(lenient_double_text(F.col("t")), lenient_bigint(F.col("t"))).collect()]
    assert [g[0] for g in got] == [12.5, 12.0, None, None, None, 1000.0, None, None]
    assert [g[1] for g in got] == [None, 12, None, None, None, None, None, None]
