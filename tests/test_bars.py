import random
from dataclasses import replace
from datetime import time

import pytest
from pyspark.sql import functions as F

from conftest import at, day, make_candles, make_ticks, rows
from test_ticks import random_trades
from tickbars import Limits, Settings
from tickbars.operators import bars, shaping, ticks
from tickbars.schemas import TICKS
from tickbars.settings import Hours, SessionRules

SETTINGS = Settings()


def trades(spark, data):
    return ticks.dedup_ticks(make_ticks(spark, data))


def test_ohlcv_of_one_minute(spark):
    frame = trades(
        spark,
        [
            ("S", "2026-06-18T05:00:30", 12, 1),
            ("S", "2026-06-18T05:00:01", 10, 2),
            ("S", "2026-06-18T05:00:59.999999", 11, 4),
            ("S", "2026-06-18T05:00:40", 9, 8),
            ("S", "2026-06-18T05:02:00", 20, 1),
        ],
    )
    got = rows(bars.candles_1m(frame, SETTINGS), "ts", "minute_local", "open", "high", "low", "close", "volume", "had_trade")
    assert got == [
        (at("2026-06-18T05:00:00"), at("2026-06-18T10:00:00"), 10.0, 12.0, 9.0, 11.0, 15, True),
        (at("2026-06-18T05:02:00"), at("2026-06-18T10:02:00"), 20.0, 20.0, 20.0, 20.0, 1, True),
    ]


def test_ties_on_the_time_go_by_price_then_volume(spark):
    frame = trades(spark, [("S", "2026-06-18T05:00:00", p, v) for p, v in ((11, 1), (10, 9), (12, 3))])
    (bar,) = bars.candles_1m(frame.repartition(3), SETTINGS).collect()
    assert (bar.open, bar.close) == (10.0, 12.0)


def test_no_ticks_no_bars_but_a_schema(spark):
    empty = bars.candles_1m(ticks.dedup_ticks(spark.createDataFrame([], TICKS)), SETTINGS)
    assert empty.count() == 0
    assert dict(empty.dtypes)["ts"] == "timestamp_ntz" and dict(empty.dtypes)["volume"] == "bigint"


def test_bars_do_not_depend_on_row_order_or_partitions(spark):
    data = [(s, t.isoformat(), p, v) for s, t, p, v in random_trades(3, 2000)]
    columns = ("symbol", "ts", "open", "high", "low", "close", "volume")
    expected = rows(bars.candles_1m(trades(spark, data), SETTINGS), *columns)
    random.Random(1).shuffle(data)
    assert rows(bars.candles_1m(trades(spark, data).repartition(7), SETTINGS), *columns) == expected


@pytest.mark.parametrize("slice_seconds", [1, 30, 60])
def test_bars_from_slices_equal_bars_from_trades(spark, slice_seconds):
    data = [(s, t.isoformat(), p, v) for s, t, p, v in random_trades(4, 2000)]
    frame = make_ticks(spark, data + data[:100] + [("A", "2026-06-18T05:00:00", -1, 1), (None, None, None, None)])
    settings = replace(SETTINGS, limits=Limits(slice_seconds=slice_seconds))
    sliced = bars.candles_from_slices(ticks.trade_slices(frame, settings), settings)
    direct = bars.candles_1m(ticks.session_trades(frame, settings), settings)
    assert sliced.columns == direct.columns
    assert rows(sliced, *direct.columns) == rows(direct, *direct.columns)


def test_bar_invariants(spark):
    data = [(s, t.isoformat(), p, v) for s, t, p, v in random_trades(5, 2000)]
    frame = trades(spark, data)
    candles = bars.candles_1m(frame, SETTINGS)
    broken = candles.filter(
        (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))
    )
    assert broken.count() == 0
    assert candles.agg(F.sum("volume")).first()[0] == frame.agg(F.sum("volume")).first()[0]


def test_five_minutes_from_bars_and_from_ticks_agree(spark):
    data = [(s, t.isoformat(), p, v) for s, t, p, v in random_trades(9, 2000)]
    frame = trades(spark, data)
    rolled = bars.rollup(bars.candles_1m(frame, SETTINGS), 5, SETTINGS)
    direct = bars.ohlcv_from_ticks(
        frame.withColumn("ts", F.window("ts_utc", "5 minutes").start), "symbol", "trade_date", "ts"
    )
    columns = ("symbol", "ts", "open", "high", "low", "close", "volume")
    assert rows(rolled, *columns) == rows(direct, *columns)


def test_rollup_aligns_to_the_local_hour(spark):
    zone = replace(SETTINGS, timezone="Asia/Kathmandu")  # UTC+5:45
    frame = ticks.dedup_ticks(make_ticks(spark, [("S", "2026-06-18T05:20:00", 1, 1)], zone))
    (bar,) = bars.rollup(bars.candles_1m(frame, zone), 30, zone).collect()
    assert bar.ts == at("2026-06-18T05:15:00")


@pytest.mark.parametrize("minutes", [0, 7, 90])
def test_rollup_rejects_widths_that_do_not_divide_the_hour(minutes):
    with pytest.raises(ValueError):
        bars.rollup(None, minutes, SETTINGS)


def flat(symbol, t, price, volume=5):
    return (symbol, t, price, price, price, price, volume)


def test_flat_fill_repeats_the_close_inside_the_session_only(spark):
    frame = make_candles(
        spark,
        [flat("S", "2026-06-18T04:31:00", 10.0), flat("S", "2026-06-18T04:34:00", 12.0), flat("S", "2026-06-18T10:30:00", 13.0)],
    )
    filled = shaping.flat_fill(frame, SETTINGS)
    early = rows(filled.filter(F.col("minute_local") <= F.lit("2026-06-18 09:35:00").cast("timestamp_ntz")), "minute_local", "close", "volume", "had_trade")
    assert early == [
        (at("2026-06-18T09:31:00"), 10.0, 5, True),
        (at("2026-06-18T09:32:00"), 10.0, 0, False),
        (at("2026-06-18T09:33:00"), 10.0, 0, False),
        (at("2026-06-18T09:34:00"), 12.0, 5, True),
        (at("2026-06-18T09:35:00"), 12.0, 0, False),
    ]
    # 09:31 to 15:29, and the real bar at the inclusive end.
    assert filled.count() == 359 + 1
    assert filled.agg(F.max("minute_local")).first()[0] == at("2026-06-18T15:30:00")


def test_flat_fill_leaves_the_friday_break_empty(spark):
    frame = make_candles(spark, [flat("S", "2026-06-19T06:58:00", 10.0)])
    local = [r.minute_local for r in shaping.flat_fill(frame, SETTINGS).orderBy("minute_local").collect()]
    assert local[:2] == [at("2026-06-19T11:58:00"), at("2026-06-19T11:59:00")]
    assert local[2] == at("2026-06-19T14:00:00") and local[-1] == at("2026-06-19T16:29:00")


def test_carry_close_invents_no_bars(spark):
    daily = bars.daily_bars(make_candles(spark, [flat("S", "2026-06-15T05:00:00", 10.0), flat("S", "2026-06-18T05:00:00", 20.0)]))
    days = spark.createDataFrame([(day(f"2026-06-{d}"),) for d in (12, 15, 16, 17, 18, 19)], "trade_date DATE")
    stats = spark.createDataFrame(
        [(day("2026-06-15"), "COMPLETE"), (day("2026-06-16"), "CONFLICT"), (day("2026-06-18"), "COMPLETE")],
        "trade_date DATE, status STRING",
    )
    got = rows(shaping.carry_close(daily, days, stats), "trade_date", "status", "close", "mark_close")
    assert got == [
        (day("2026-06-15"), "COMPLETE", 10.0, 10.0),
        (day("2026-06-16"), "CONFLICT", None, 10.0),
        (day("2026-06-17"), "MISSING", None, 10.0),
        (day("2026-06-18"), "COMPLETE", 20.0, 20.0),
        (day("2026-06-19"), "MISSING", None, 20.0),
    ]


def test_daily_bars_consult_the_status(spark):
    candles = make_candles(
        spark,
        [flat("A", "2026-06-15T05:00:00", 1.0), flat("A", "2026-06-15T05:01:00", 2.0), flat("B", "2026-06-15T05:00:00", 3.0),
         flat("A", "2026-06-16T05:00:00", 4.0), flat("A", "2026-06-17T05:00:00", 5.0)],
    )
    known = spark.createDataFrame(
        [("A", day("2026-06-15"), "COMPLETE"), ("*", day("2026-06-15"), "MISSING"), ("*", day("2026-06-16"), "CONFLICT"),
         ("*", day("2026-06-17"), "COMPLETE")],
        "symbol STRING, trade_date DATE, status STRING",
    )
    # A's own row wins over the market's; B has only the market's; the 16th is in conflict.
    assert rows(shaping.gated_daily_bars(candles, known), "symbol", "trade_date", "open", "close", "minutes_count") == [
        ("A", day("2026-06-15"), 1.0, 2.0, 2), ("A", day("2026-06-17"), 5.0, 5.0, 1)
    ]


def test_the_local_hour_that_comes_twice_keeps_its_bars(spark):
    own = Settings(timezone="America/New_York", session=SessionRules(regular=Hours(time(0, 0), time(3, 0)), weekdays=tuple(range(7)), friday=()))
    minutes = [("S", "2026-11-01T05:30:00", 1, 5), ("S", "2026-11-01T06:30:00", 2, 7)]  # both 01:30 local
    candles = bars.candles_1m(make_ticks(spark, minutes, own), own)
    assert rows(bars.rollup(candles, 5, own), "ts", "close", "volume") == [
        (at("2026-11-01T05:30:00"), 1.0, 5),
        (at("2026-11-01T06:30:00"), 2.0, 7),
    ]
    filled = shaping.flat_fill(candles, own)
    assert rows(filled.filter("had_trade"), "ts", "close") == [(at("2026-11-01T05:30:00"), 1.0), (at("2026-11-01T06:30:00"), 2.0)]
    assert filled.agg({"volume": "sum"}).first()[0] == 12
    assert filled.filter("NOT had_trade AND ts > timestamp_ntz '2026-11-01 06:30:00'").first().close == 2.0
