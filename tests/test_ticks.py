import random
from dataclasses import replace
from datetime import datetime, time, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at, day, make_ticks, rows
from tickbars import DatedHours, Hours, Limits, SessionRules, Settings, SourceColumns
from tickbars.operators import calendar, ticks
from tickbars.schemas import TICKS

SETTINGS = Settings()


def local_ticks(spark, *local_times, settings=SETTINGS):
    """One tick per exchange-time text."""
    return make_ticks(
        spark, [("S", (at(t) - timedelta(hours=5)).isoformat(), 10, 1) for t in local_times], settings
    )


def kept_times(frame, settings):
    return [str(r.ts_local) for r in ticks.session_filter(frame, settings).orderBy("ts_local").collect()]


def test_session_ends_are_inclusive_to_the_microsecond(spark):
    frame = local_ticks(
        spark,
        "2026-06-18T09:29:59.999999", "2026-06-18T09:30:00", "2026-06-18T15:30:00", "2026-06-18T15:30:00.000001",
        "2026-06-18T15:30:00.500000",
    )
    assert kept_times(frame, SETTINGS) == ["2026-06-18 09:30:00", "2026-06-18 15:30:00"]


def test_friday_has_two_windows(spark):
    frame = local_ticks(
        spark,
        "2026-06-19T09:14:59", "2026-06-19T09:15:00", "2026-06-19T12:00:00", "2026-06-19T12:00:00.000001",
        "2026-06-19T13:00:00", "2026-06-19T14:00:00", "2026-06-19T16:30:00", "2026-06-19T16:30:01",
    )
    assert kept_times(frame, SETTINGS) == [
        "2026-06-19 09:15:00", "2026-06-19 12:00:00", "2026-06-19 14:00:00", "2026-06-19 16:30:00"
    ]


def overridden(**kwargs):
    first = DatedHours(day("2026-06-16"), day("2026-06-19"), Hours(time(10), time(13)))
    second = DatedHours(day("2026-06-18"), day("2026-06-22"), Hours(time(20), time(21)))
    return replace(SETTINGS, session=SessionRules(overrides=(first, second), **kwargs))


def test_first_matching_override_wins_on_inclusive_dates(spark):
    frame = local_ticks(
        spark,
        "2026-06-15T09:45:00",  # before the range
        "2026-06-16T09:45:00", "2026-06-16T12:00:00",  # first day
        "2026-06-18T12:30:00", "2026-06-18T20:30:00",  # both ranges: the first counts
        "2026-06-22T20:30:00", "2026-06-22T12:00:00",  # second range only
    )
    assert kept_times(frame, overridden()) == [
        "2026-06-15 09:45:00", "2026-06-16 12:00:00", "2026-06-18 12:30:00", "2026-06-22 20:30:00"
    ]


def test_friday_windows_beat_overrides_unless_told_otherwise(spark):
    frame = local_ticks(spark, "2026-06-19T09:20:00", "2026-06-19T12:30:00")
    assert kept_times(frame, overridden()) == ["2026-06-19 09:20:00"]
    assert kept_times(frame, overridden(overrides_apply_on_friday=True)) == ["2026-06-19 12:30:00"]


def test_session_table_follows_the_same_rules(spark):
    dates = spark.createDataFrame([(day(d),) for d in ("2026-06-15", "2026-06-16", "2026-06-19")], "trade_date DATE")
    got = rows(calendar.session_table(dates, overridden().session), "trade_date", "start_second", "end_second")
    assert got == [
        (day("2026-06-15"), 34200, 55800),
        (day("2026-06-16"), 36000, 46800),
        (day("2026-06-19"), 33300, 43200),
        (day("2026-06-19"), 50400, 59400),
    ]


def test_invalid_ticks_are_dropped_and_reported(spark):
    nan = float("nan")
    frame = make_ticks(
        spark,
        [
            ("S", "2026-06-18T05:00:00", 10, 1),
            ("S", "2026-06-18T05:00:01", 10, 0),
            ("S", "2026-06-18T05:00:02", 0, 1),
            ("S", "2026-06-18T05:00:03", -1, 1),
            ("S", "2026-06-18T05:00:04", 10, -1),
            ("S", "2026-06-18T05:00:05", nan, 1),
            ("S", "2026-06-18T05:00:06", None, 1),
            ("S", "2026-06-18T05:00:07", 10, None),
            ("S", None, 10, 1),
            (None, "2026-06-18T05:00:08", 10, 1),
        ],
    )
    assert ticks.drop_invalid(frame).count() == 2
    assert rows(ticks.rejected_ticks(frame), "defect") == sorted(
        (d,)
        for d in (
            "price_not_positive", "price_not_positive", "volume_negative", "no_price", "no_price",
            "no_volume", "no_timestamp", "no_symbol",
        )
    )


def test_exact_duplicates_merge_across_files(spark):
    frame = make_ticks(
        spark,
        [("S", "2026-06-18T05:00:00", 10, 1, f) for f in "AB"]
        + [("S", "2026-06-18T05:00:00", 10, 2), ("S", "2026-06-18T05:00:00", 11, 1)],
    )
    assert ticks.dedup_ticks(frame).count() == 3


def brute_force_spikes(data, pct=0.2):
    flags, last = {}, {}
    for symbol, t, price, volume in sorted(set(data), key=lambda r: (r[0], r[1], r[2], r[3])):
        key = (symbol, (t + timedelta(hours=5)).date())
        before = last.get(key)
        flags[(symbol, t, price, volume)] = before is not None and abs(price - before) / before > pct
        last[key] = price
    return flags


def random_trades(seed, n=3000, hot_share=0.35):
    """Trades of several days, a third of them in one minute of one symbol."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        if rng.random() < hot_share:
            t = datetime(2026, 6, 18, 5, 0) + timedelta(microseconds=rng.randrange(60_000_000))
            symbol = "HOT"
        else:
            t = datetime(2026, 6, 17, 18, 0) + timedelta(seconds=rng.randrange(2 * 86_400))
            symbol = rng.choice("ABC")
        out.append((symbol, t, float(rng.choice([8, 9, 10, 11, 12, 13])), rng.randrange(1, 4)))
    return out


@pytest.mark.parametrize("slice_seconds", [1, 20, 60])
def test_spikes_match_brute_force_under_skew(spark, slice_seconds):
    data = random_trades(7)
    frame = make_ticks(spark, [(s, t.isoformat(), p, v) for s, t, p, v in data])
    settings = replace(SETTINGS, limits=Limits(slice_seconds=slice_seconds))
    flagged = ticks.flag_spikes(ticks.dedup_ticks(frame), settings)
    got = {(r.symbol, r.ts_utc, r.price, r.volume): r.spike_flag for r in flagged.collect()}
    assert got == brute_force_spikes(data)


def test_spike_needs_more_than_the_limit_and_restarts_each_day(spark):
    frame = make_ticks(
        spark,
        [
            ("S", "2026-06-18T05:00:00", 100, 1),
            ("S", "2026-06-18T05:00:01", 120, 1),  # exactly 20 %
            ("S", "2026-06-18T05:09:00", 150, 1),  # 25 %
            ("S", "2026-06-19T05:00:00", 500, 1),  # first of its day
        ],
    )
    flagged = ticks.flag_spikes(ticks.dedup_ticks(frame), SETTINGS)
    assert rows(flagged, "price", "spike_flag") == [
        (100.0, False), (120.0, False), (150.0, True), (500.0, False)
    ]


def test_no_window_over_a_whole_symbol_day_of_ticks(spark):
    frame = ticks.dedup_ticks(make_ticks(spark, [("S", "2026-06-18T05:00:00", 1, 1)]))
    plan = ticks.flag_spikes(frame, SETTINGS)._jdf.queryExecution().optimizedPlan().toString()
    over_day = [line for line in plan.splitlines() if "Window [lag(price" in line and "[symbol" in line]
    assert over_day and all("slice" in line for line in over_day)


def test_counters_follow_the_order_of_the_steps(spark):
    good = ("S", "2026-06-18T05:00:00", 100, 1)
    frame = make_ticks(
        spark,
        [
            good, (*good, "B"),  # duplicate
            ("S", "2026-06-18T05:00:30", 130, 1),  # spike
            ("S", "2026-06-18T01:00:00", 10, 1), ("S", "2026-06-18T01:00:00", 10, 1),  # off session, twice
            ("S", "2026-06-18T05:01:00", -5, 1), ("S", "2026-06-18T05:01:00", -5, 1),  # invalid, not duplicates
            ("S", "2026-06-18T05:01:00", None, 1),
            (None, "2026-06-18T05:01:00", 5, 1),
        ],
    )
    (got,) = [r.asDict() for r in ticks.clean_stats(frame, SETTINGS).collect()]
    assert got == {
        "trade_date": day("2026-06-18"), "input_rows": 9, "coercion_failures": 1, "invalid_dropped": 4,
        "duplicates_dropped": 2, "out_of_session_dropped": 1, "spikes_flagged": 1, "output_rows": 2,
    }


def test_tick_without_time_counts_for_the_date_of_its_file(spark):
    frame = make_ticks(spark, [("S", None, 1, 1, "ticks_20260618.db"), ("S", "2026-06-18T05:00:00", 1, 1)])
    (got,) = ticks.clean_stats(frame, SETTINGS).collect()
    assert (got.trade_date, got.input_rows, got.coercion_failures) == (day("2026-06-18"), 2, 1)


def test_counters_match_the_operators_on_random_trades(spark):
    data = random_trades(11)
    frame = make_ticks(spark, [(s, t.isoformat(), p, v) for s, t, p, v in data])
    stats = ticks.clean_stats(frame, SETTINGS).agg(F.sum("output_rows"), F.sum("spikes_flagged")).first()
    clean = ticks.clean_ticks(frame, SETTINGS).agg(F.count("*"), F.count_if("spike_flag")).first()
    assert tuple(stats) == tuple(clean)


def test_date_window_is_seven_days_back_and_one_ahead(spark):
    names = ["f_20260610.db", "f_20260615.db", "other.db"]
    files = spark.createDataFrame([(n,) for n in names], "source_file STRING")
    frame = local_ticks(spark, *(f"2026-06-{d:02d}T10:00:00" for d in (2, 3, 10, 16, 17)))
    got = [r.trade_date.day for r in ticks.within_file_dates(frame, files).orderBy("trade_date").collect()]
    assert got == [3, 10, 16]
    undated = files.filter(F.col("source_file") == "other.db")
    assert ticks.within_file_dates(frame, undated).count() == 5


def test_target_dates(spark):
    frame = make_ticks(spark, [("S", "2026-06-18T05:00:00", 1, 1), ("S", "2026-06-18T20:00:00", 1, 1), ("S", None, 1, 1)])
    assert ticks.ticks_for_dates(frame, [day("2026-06-19")]).count() == 1  # 20:00 UTC is the next day there
    assert ticks.ticks_for_dates(frame).count() == 2


def test_empty_input_keeps_the_schema(spark):
    empty = spark.createDataFrame([], TICKS)
    assert ticks.clean_ticks(empty, SETTINGS).columns == [
        "symbol", "trade_date", "ts_utc", "price", "volume", "spike_flag", "ts_local"
    ]
    assert ticks.clean_ticks(empty, SETTINGS).count() == 0
    assert ticks.clean_stats(empty, SETTINGS).count() == 0


def test_settings_from_a_configuration_mapping():
    got = Settings.from_mapping(
        {
            "timezone": "Asia/Karachi",
            "session": {
                "start": "9:30", "end": "15:30", "days": ["mon", "wed"],
                "friday": [{"start": "09:15", "end": "12:00"}],
                "overrides": [{"from": "2026-02-18", "to": "2026-03-19", "start": "09:00", "end": "13:00"}],
            },
            "thresholds": {"spike_pct": 0.3, "min_session_minutes": 50},
            "columns": {"symbol": "ticker", "price": "px", "volume": "qty", "timestamp": "stamp"},
            "timestamp_format": "epoch_s",
            "source_format": "csv",
        }
    )
    assert got.session.regular == Hours(time(9, 30), time(15, 30))
    assert got.session.weekdays == (0, 2)
    assert got.session.overrides[0].last == day("2026-03-19")
    assert got.limits == Limits(spike_pct=0.3, min_session_minutes=50)
    assert got.columns == SourceColumns("ticker", "px", "qty", "stamp")
    assert got.glob == "*.csv"
