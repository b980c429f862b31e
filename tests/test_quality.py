import pytest
from pyspark.sql import functions as F

from conftest import at, day, make_candles, make_ticks, rows
from tickbars import Limits, Settings
from tickbars.operators import calendar, quality, replication, reports, status
from tickbars.settings import DEFAULT_HOLIDAYS

SETTINGS = Settings(limits=Limits(min_session_minutes=3, min_symbol_minutes=2))
CHECK_COLUMNS = ("ohlc_valid", "price_valid", "volume_valid", "minute_boundary", "is_valid")


def bar(t, o=10.0, h=11.0, low=9.0, c=10.0, v=1, symbol="S"):
    return (symbol, t, o, h, low, c, v)


@pytest.mark.parametrize(
    ("candle", "expected"),
    [
        (bar("2026-06-18T05:00:00"), (True, True, True, True, True)),
        (bar("2026-06-18T05:00:00", h=9.5), (False, True, True, True, False)),
        (bar("2026-06-18T05:00:00", low=10.5), (False, True, True, True, False)),
        (bar("2026-06-18T05:00:00", o=-1.0, low=-2.0), (True, False, True, True, False)),
        (bar("2026-06-18T05:00:00", v=-1), (True, True, False, True, False)),
        (bar("2026-06-18T05:00:05"), (True, True, True, False, False)),
        (bar("2026-06-18T05:00:00", c=None), (True, None, True, True, False)),
    ],
)
def test_candle_checks(spark, candle, expected):
    checked = quality.check_candles(make_candles(spark, [candle]))
    assert tuple(checked.select(*CHECK_COLUMNS).first()) == expected


def test_valid_and_quarantine_share_out_all_bars(spark):
    checked = quality.validate_candles(
        make_candles(spark, [bar("2026-06-18T05:00:00"), bar("2026-06-18T05:01:00", c=None), bar("2026-06-18T05:02:00", v=-1)]),
        SETTINGS,
    )
    assert quality.valid_candles(checked).count() == 1
    bad = quality.quarantined_candles(checked)
    assert rows(bad, "volume", "quarantine_date") == [(-1, day("2026-06-18")), (1, day("2026-06-18"))]


def test_candle_spike_uses_the_bar_before_even_an_invalid_one(spark):
    frame = make_candles(
        spark,
        [bar("2026-06-18T05:00:00", c=10.0), bar("2026-06-18T05:01:00", c=13.0, v=-1), bar("2026-06-18T05:02:00", c=13.0),
         bar("2026-06-18T05:03:00", c=-5.0), bar("2026-06-18T05:04:00", c=50.0), bar("2026-06-19T05:00:00", c=500.0)],
    )
    got = rows(quality.flag_candle_spikes(frame, SETTINGS), "ts", "spike_flag")
    # After a close that is not positive nothing is flagged; a new day starts anew.
    assert [flag for _, flag in got] == [False, True, False, True, False, False]


def stats_of(spark, candles, settings=SETTINGS):
    checked = quality.validate_candles(make_candles(spark, candles), settings)
    return {r.trade_date: r for r in quality.day_stats(checked, settings).collect()}


def test_day_status(spark):
    got = stats_of(
        spark,
        [bar(f"2026-06-15T05:0{m}:00", symbol=s) for m in (0,) for s in "ABC"]  # 3 symbol-minutes
        + [bar(f"2026-06-16T05:0{m}:00") for m in (0, 1)]  # 2, but one symbol has 2
        + [bar("2026-06-17T05:00:00", symbol=s) for s in "AB"]  # 2, spread
        + [bar("2026-06-18T05:00:00", v=-1)],  # none valid
    )
    assert [(d.day, r.status, r.reason, r.minutes_count, r.symbols_count) for d, r in sorted(got.items())] == [
        (15, "COMPLETE", None, 3, 3),
        (16, "COMPLETE", None, 2, 1),
        (17, "MISSING", "insufficient_minutes (2 < 3)", 2, 2),
        (18, "MISSING", "no_valid_candles", 0, 0),
    ]


def test_gap_is_longer_than_two_hours_on_the_busiest_symbol(spark):
    def flags(*candles):
        return [r.gap_flag for r in stats_of(spark, list(candles)).values()]

    assert flags(bar("2026-06-18T05:00:00"), bar("2026-06-18T07:00:00")) == [False]
    assert flags(bar("2026-06-18T05:00:00"), bar("2026-06-18T07:01:00")) == [True]
    # A friday break from 11:59 to 14:00 counts.
    assert flags(bar("2026-06-19T06:59:00"), bar("2026-06-19T09:00:00")) == [True]
    # The gap of a quieter symbol does not; on a tie the first name decides.
    quiet = [bar("2026-06-18T05:00:00", symbol="B"), bar("2026-06-18T09:00:00", symbol="B")]
    busy = [bar(f"2026-06-18T05:0{m}:00", symbol="C") for m in range(3)]
    assert flags(*quiet, *busy) == [False]
    assert flags(*quiet, *(bar(f"2026-06-18T05:0{m}:00", symbol="A") for m in range(2))) == [False]


def test_duplicate_keys_and_constraints(spark):
    frame = make_candles(spark, [bar("2026-06-18T05:00:00"), bar("2026-06-18T05:00:00"), bar("2026-06-18T05:01:00", c=None)])
    assert rows(quality.duplicate_keys(frame), "ts", "n") == [(at("2026-06-18T05:00:00"), 2)]
    assert rows(quality.constraint_violations(frame), "ts", "violation", "n_rows") == [
        (at("2026-06-18T05:00:00"), "duplicate_key", 2), (at("2026-06-18T05:01:00"), "null_close", 1)
    ]


def copies(spark, **files):
    data = [("S", t, p, v, name) for name, trades in files.items() for t, p, v in trades]
    return make_ticks(spark, data)


def audit(spark, **files):
    frame = copies(spark, **files)
    (verdict,) = replication.replication_audit(replication.copy_candles(frame)).collect()
    return frame, verdict


FIRST, SECOND = ("2026-06-18T05:00:00", 10, 1), ("2026-06-18T05:01:00", 11, 1)


def test_identical_copies_collapse_to_one(spark):
    frame, verdict = audit(spark, b=[FIRST, SECOND], a=[SECOND, FIRST], c=[FIRST, SECOND, SECOND])
    assert (verdict.n_copies, verdict.action, verdict.detail, verdict.kept_source) == (3, "collapsed_identical", "", "a")
    verdicts = replication.replication_audit(replication.copy_candles(frame))
    assert {r.source_file for r in replication.collapse_copies(frame, verdicts).collect()} == {"a"}


def test_a_minute_that_only_one_copy_has_is_a_conflict(spark):
    # Equal row counts, different minutes.
    frame, verdict = audit(spark, a=[FIRST], b=[SECOND])
    assert (verdict.action, verdict.detail) == ("CONFLICT", "2 minute(s) disagree")
    verdicts = replication.replication_audit(replication.copy_candles(frame))
    assert replication.collapse_copies(frame, verdicts).count() == 0
    assert replication.drop_conflicts(frame, verdicts).count() == 0


def test_one_of_many_copies_differs(spark):
    _, verdict = audit(spark, a=[FIRST, SECOND], b=[FIRST, SECOND], c=[FIRST, (SECOND[0], 11, 2)])
    assert (verdict.n_copies, verdict.action, verdict.detail) == (3, "CONFLICT", "1 minute(s) disagree")


def test_row_order_within_a_copy_does_not_matter(spark):
    tie = [("2026-06-18T05:00:00", 10, 1), ("2026-06-18T05:00:00", 12, 1)]
    _, verdict = audit(spark, a=tie, b=tie[::-1])
    assert verdict.action == "collapsed_identical"


def test_a_single_copy_needs_no_verdict(spark):
    frame = copies(spark, a=[FIRST])
    assert replication.replication_audit(replication.copy_candles(frame)).count() == 0
    assert replication.duplicate_days(frame).count() == 0


def stats_frame(spark, *data):
    return spark.createDataFrame(
        [(day(d), s, r, n, n, 0, 0, 0, 0, 0, 0, False) for d, s, r, n in data],
        "trade_date DATE, status STRING, reason STRING, minutes_count BIGINT, symbols_count BIGINT, quarantined BIGINT, "
        "spikes_flagged BIGINT, ohlc_failures BIGINT, price_failures BIGINT, volume_failures BIGINT, "
        "boundary_failures BIGINT, gap_flag BOOLEAN",
    )


def dates(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "trade_date DATE")


def test_days_without_candles_are_corrupt_and_conflicts_win(spark):
    stats = stats_frame(spark, ("2026-06-15", "COMPLETE", None, 70), ("2026-06-16", "COMPLETE", None, 70))
    got = status.classify_days(
        dates(spark, "2026-06-15", "2026-06-16", "2026-06-17"), stats, dates(spark, "2026-06-16")
    )
    assert rows(got, "trade_date", "status", "reason", "minutes_count") == [
        (day("2026-06-15"), "COMPLETE", None, 70),
        (day("2026-06-16"), "CONFLICT", "conflict", 70),
        (day("2026-06-17"), "MISSING", "corrupt", 0),
    ]


def test_expected_days_leave_out_weekends_and_holidays(spark):
    closed = calendar.holidays(spark, [(day("2024-01-05"), "x"), (day("2024-01-15"), "y"), (day("2024-01-20"), "z")])
    days = calendar.expected_days(spark, day("2024-01-01"), day("2024-01-31"), closed, SETTINGS.session)
    assert days.count() == 21
    assert len(DEFAULT_HOLIDAYS) == calendar.holidays(spark).count() == 9


def test_coverage_defaults_and_summary(spark):
    stats = stats_frame(
        spark, ("2026-06-15", "COMPLETE", None, 70), ("2026-06-16", "MISSING", "corrupt", 0), ("2026-06-17", "CONFLICT", "conflict", 5)
    )
    report = reports.coverage(dates(spark, "2026-06-15", "2026-06-16", "2026-06-17", "2026-06-18"), stats)
    assert rows(report, "trade_date", "day_of_week", "status", "reason", "minutes_count") == [
        (day("2026-06-15"), "Monday", "COMPLETE", None, 70),
        (day("2026-06-16"), "Tuesday", "MISSING", "corrupt", 0),
        (day("2026-06-17"), "Wednesday", "CONFLICT", "conflict", 5),
        (day("2026-06-18"), "Thursday", "MISSING", "absent", 0),
    ]
    assert tuple(reports.coverage_summary(report).first()) == (4, 1, 2, 1)


def test_absent_days_tell_scraping_from_ingest(spark):
    got = status.absent_day_status(
        dates(spark, "2026-06-15", "2026-06-16", "2026-06-17"), dates(spark, "2026-06-16", "2026-06-17"),
        dates(spark, "2026-06-17"), F.lit("2026-06-20 00:00:00").cast("timestamp_ntz"),
    )
    assert rows(got, "symbol", "trade_date", "status", "reason") == [
        ("*", day("2026-06-15"), "MISSING", "scrape_failed"), ("*", day("2026-06-16"), "MISSING", "ingest_failed")
    ]
