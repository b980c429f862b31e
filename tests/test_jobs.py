import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at, day, rows
from test_sources import write_csv, write_db
from tickbars import Limits, Settings
from tickbars.operators import calendar
from tickbars.plans import jobs
from tickbars.plans.jobs import backfill, coverage_report, ingest, process_days
from tickbars.sources import store as tables
from tickbars.sources.store import Store
from tickbars.streaming.incremental import incremental_update, record_absent_days

SETTINGS = Settings(source_format="csv", limits=Limits(min_session_minutes=3, min_symbol_minutes=2))
BUILT = datetime(2026, 7, 1)


def minutes(date_text, count, symbol="S", price=10):
    """Lines with one trade a minute from 10:00 exchange time on."""
    start = at(f"{date_text}T05:00:00")
    return [f"{symbol},{(start + timedelta(minutes=i)).isoformat(sep=' ')},{price + i / 100},1" for i in range(count)]


def run(spark, landing, root, **kwargs):
    store = Store(spark, str(root))
    kwargs.setdefault("csv", False)
    return store, backfill(spark, str(landing), store, SETTINGS, built_at=BUILT, **kwargs)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def snapshot(store):
    return {
        t.name: rows(store.read(t), *t.schema.fieldNames())
        for t in (tables.CANDLES, tables.DAY_STATUS, tables.VALIDATION, tables.QUARANTINE, tables.CLEAN_STATS)
    }


def test_backfill_classifies_and_loads(spark, landing, tmp_path):
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5) + minutes("2026-06-15", 2, "T"))
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 1))
    write_csv(landing / "t_20260617.csv", ["S,2026-06-17 01:00:00,10,1", "S,bad,1,1"] + minutes("2022-01-03", 9))
    write_csv(landing / "t_20260618.csv", minutes("2026-06-18", 4) + minutes("2026-06-15", 5))
    store, summary = run(spark, landing, tmp_path / "store", closed=calendar.holidays(spark, []), csv=True)
    assert rows(store.read(tables.DAY_STATUS), "symbol", "trade_date", "status", "reason", "minutes_count", "built_at") == [
        ("*", day("2026-06-16"), "MISSING", "insufficient_minutes (1 < 3)", 0, BUILT),
        ("*", day("2026-06-17"), "MISSING", "corrupt", 0, BUILT),
        ("S", day("2026-06-15"), "COMPLETE", None, 5, BUILT),
        ("S", day("2026-06-18"), "COMPLETE", None, 4, BUILT),
        ("T", day("2026-06-15"), "COMPLETE", None, 2, BUILT),
    ]
    assert store.read(tables.CANDLES).count() == 11  # the ticks of 2022 are stale
    assert store.read_candle_csvs().count() == 11
    # Range and counts of the calendar from the 15th to the 18th.
    assert tuple(summary.first()) == (day("2026-06-15"), day("2026-06-18"), 4, 2, 2, 0, 11, 2)
    stats = {r.trade_date.day: r for r in store.read(tables.CLEAN_STATS).collect()}
    assert (stats[15].input_rows, stats[15].duplicates_dropped) == (12, 5)
    assert (stats[17].input_rows, stats[17].coercion_failures, stats[17].out_of_session_dropped) == (2, 1, 1)
    assert rows(store.read(tables.REJECTS), "defect", "reject_date") == [("no_timestamp", day("2026-06-17"))]


def test_backfill_twice_gives_the_same_tables(spark, landing, tmp_path):
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 1))
    store, _ = run(spark, landing, tmp_path / "store")
    first = snapshot(store)
    run(spark, landing, tmp_path / "store")
    assert snapshot(store) == first


def test_audit_mode_marks_conflicts_and_merge_mode_does_not(spark, landing, tmp_path):
    write_csv(landing / "a_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "b_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "a_20260616.csv", minutes("2026-06-16", 5))
    write_csv(landing / "b_20260616.csv", minutes("2026-06-16", 4, price=11))
    audited, _ = run(spark, landing, tmp_path / "audited", replication_mode="audit")
    assert rows(audited.read(tables.DAY_STATUS), "symbol", "trade_date", "status", "reason") == [
        ("*", day("2026-06-16"), "CONFLICT", "conflict"), ("S", day("2026-06-15"), "COMPLETE", None)
    ]
    assert rows(audited.read(tables.DEDUP_LOG), "trade_date", "n_copies", "action") == [
        (day("2026-06-15"), 2, "collapsed_identical"), (day("2026-06-16"), 2, "CONFLICT")
    ]
    merged, _ = run(spark, landing, tmp_path / "merged")
    assert rows(merged.read(tables.DAY_STATUS), "symbol", "status") == [("S", "COMPLETE")] * 2


def test_replace_and_upsert_differ_on_what_a_rerun_no_longer_has(spark, landing, tmp_path):
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    stores = {}
    for mode in ("replace_day", "upsert"):
        stores[mode], _ = run(spark, landing, tmp_path / mode, write_mode=mode)
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 1))
    for mode in stores:
        run(spark, landing, tmp_path / mode, write_mode=mode)
    assert stores["replace_day"].read(tables.CANDLES).count() == 0
    assert rows(stores["replace_day"].read(tables.DAY_STATUS), "symbol", "status") == [("*", "MISSING")]
    assert stores["upsert"].read(tables.CANDLES).count() == 5
    assert rows(stores["upsert"].read(tables.DAY_STATUS), "symbol", "status") == [("*", "MISSING"), ("S", "COMPLETE")]


def test_wrong_modes_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        process_days(Store(spark, str(tmp_path)), SETTINGS, None, replication_mode="guess")
    with pytest.raises(ValueError):
        process_days(Store(spark, str(tmp_path)), SETTINGS, None, write_mode="append")


def test_coverage_by_calendar_or_by_data(spark, landing, tmp_path):
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "t_20260618.csv", minutes("2026-06-18", 5))
    store, _ = run(spark, landing, tmp_path / "store")
    closed = calendar.holidays(spark, [(day("2026-06-16"), "closed")])
    by_calendar = coverage_report(store, SETTINGS, "calendar", closed)
    assert rows(by_calendar, "trade_date", "status", "reason") == [
        (day("2026-06-15"), "COMPLETE", None), (day("2026-06-17"), "MISSING", "absent"), (day("2026-06-18"), "COMPLETE", None)
    ]
    assert coverage_report(store, SETTINGS, "observed").count() == 2


def files_of_three_days(landing):
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 2, "T") + minutes("2026-06-08", 5))
    # Late ticks of earlier days, one of which was out of range until now.
    write_csv(landing / "t_20260614.csv", minutes("2026-06-16", 6) + minutes("2026-06-07", 5) + minutes("2026-06-01", 5))


def test_updates_in_small_steps_equal_one_backfill(spark, landing, tmp_path):
    files_of_three_days(landing)
    whole, _ = run(spark, landing, tmp_path / "whole")
    steps = Store(spark, str(tmp_path / "steps"))
    incremental_update(
        spark, str(landing), steps, str(tmp_path / "progress"), SETTINGS, built_at=BUILT, files_per_batch=1, csv=False
    )
    assert snapshot(steps) == snapshot(whole)


def test_update_takes_only_new_files(spark, landing, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    arguments = (spark, str(landing), store, str(tmp_path / "progress"), SETTINGS)
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    incremental_update(*arguments, csv=False, built_at=BUILT)
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 5))
    incremental_update(*arguments, csv=False, built_at=BUILT + timedelta(days=1))
    assert rows(store.read(tables.DAY_STATUS), "trade_date", "built_at") == [
        (day("2026-06-15"), BUILT), (day("2026-06-16"), BUILT + timedelta(days=1))
    ]


def test_files_without_ticks_change_nothing(spark, landing, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    arguments = (spark, str(landing), store, str(tmp_path / "progress"), SETTINGS)
    incremental_update(*arguments, csv=False, built_at=BUILT)  # an empty folder
    write_csv(landing / "t_20260614.csv", [])
    incremental_update(*arguments, csv=False, built_at=BUILT)
    assert store.read(tables.DAY_STATUS).count() == 0
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    incremental_update(*arguments, csv=False, built_at=BUILT)
    assert store.read(tables.CANDLES).count() == 5


def test_update_reads_sqlite_files(spark, landing, tmp_path):
    settings = replace(SETTINGS, source_format="sqlite")
    data = [tuple(line.split(",")) for line in minutes("2026-06-15", 5)]
    write_db(landing / "t_20260615.db", data)
    store = Store(spark, str(tmp_path / "store"))
    incremental_update(spark, str(landing), store, str(tmp_path / "progress"), settings, built_at=BUILT, csv=False)
    assert store.read(tables.CANDLES).count() == 5
    whole = Store(spark, str(tmp_path / "whole"))
    backfill(spark, str(landing), whole, settings, built_at=BUILT, csv=False)
    assert snapshot(whole) == snapshot(store)


def test_absent_days_are_recorded(spark, landing, tmp_path):
    write_csv(landing / "t_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "t_20260616.csv", ["S,bad,1,1"])
    store, _ = run(spark, landing, tmp_path / "store")
    expected = spark.createDataFrame([(day(f"2026-06-{d}"),) for d in (15, 16, 17)], "trade_date DATE")
    record_absent_days(spark, str(landing), store, expected, SETTINGS, built_at=BUILT)
    assert rows(store.read(tables.DAY_STATUS).filter(F.col("symbol") == "*"), "trade_date", "reason") == [
        (day("2026-06-16"), "ingest_failed"), (day("2026-06-17"), "scrape_failed")
    ]


def test_what_a_shorter_file_no_longer_has_goes(spark, landing, tmp_path):
    write_csv(landing / "t_20260616.csv", minutes("2026-06-15", 5) + minutes("2026-06-16", 4) + ["S,bad,1,1"])
    store, _ = run(spark, landing, tmp_path / "store", csv=True)
    assert store.read(tables.REJECTS).count() == 1
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 4))
    run(spark, landing, tmp_path / "store", csv=True)
    assert rows(store.read(tables.CANDLES).groupBy("trade_date").count(), "trade_date", "count") == [(day("2026-06-16"), 4)]
    assert store.read(tables.REJECTS).count() == 0 and store.read_candle_csvs().count() == 4
    assert rows(store.read(tables.INGESTED), "trade_date") == [(day("2026-06-16"),)]


def test_a_late_file_with_an_old_time_is_taken(spark, landing, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for k, name in enumerate(("2026-06-15", "2026-06-16")):
        path = landing / f"t_{name.replace('-', '')}.csv"
        write_csv(path, minutes(name, 5))
        if k:
            old = path.stat().st_mtime - 10 * 86_400
            os.utime(path, (old, old))
        incremental_update(spark, str(landing), store, str(tmp_path / "progress"), SETTINGS, built_at=BUILT, csv=False)
    assert store.read(tables.CANDLES).count() == 10


def test_days_left_out_by_target_dates_stay_pending(spark, landing, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    arguments = {"csv": False, "built_at": BUILT}
    write_csv(landing / "t_20260616.csv", minutes("2026-06-15", 5) + minutes("2026-06-16", 4))
    write_csv(landing / "t_20260617.csv", minutes("2026-06-17", 4))
    incremental_update(spark, str(landing), store, str(tmp_path / "progress"), SETTINGS, **arguments)
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 4))  # a done day loses its ticks
    write_csv(landing / "u_20260617.csv", minutes("2026-06-17", 7))  # another one gets more
    arguments |= {"checkpoint": str(tmp_path / "again-progress"), "settings": SETTINGS}
    incremental_update(spark, str(landing), store, target_dates=[day("2026-06-16")], **arguments)
    counts = store.read(tables.CANDLES).groupBy("trade_date").count()
    assert rows(counts, "trade_date", "count") == [(day("2026-06-15"), 5), (day("2026-06-16"), 4), (day("2026-06-17"), 4)]
    incremental_update(spark, str(landing), store, **arguments)  # no new file
    counts = store.read(tables.CANDLES).groupBy("trade_date").count()
    assert rows(counts, "trade_date", "count") == [(day("2026-06-16"), 4), (day("2026-06-17"), 7)]
    assert store.read(tables.PENDING).count() == 0


def test_files_of_one_symbol_are_copies_of_that_symbol(spark, landing, tmp_path):
    settings = replace(SETTINGS, file_layout="one_per_symbol")
    write_csv(landing / "S_20260615.csv", minutes("2026-06-15", 5))
    write_csv(landing / "T_20260615.csv", minutes("2026-06-15", 5, "T", 20))
    write_csv(landing / "T2_20260615.csv", minutes("2026-06-15", 5, "T", 20))
    write_csv(landing / "U_20260615.csv", minutes("2026-06-15", 5, "U", 30))
    write_csv(landing / "U2_20260615.csv", minutes("2026-06-15", 4, "U", 30))
    store = Store(spark, str(tmp_path / "store"))
    backfill(spark, str(landing), store, settings, replication_mode="audit", built_at=BUILT, csv=False)
    assert rows(store.read(tables.DAY_STATUS), "symbol", "status", "reason", "minutes_count") == [
        ("S", "COMPLETE", None, 5), ("T", "COMPLETE", None, 5), ("U", "CONFLICT", "conflict", 0)
    ]
    assert rows(store.read(tables.DEDUP_LOG), "symbol", "n_copies", "action") == [("T", 2, "collapsed_identical"), ("U", 2, "CONFLICT")]
    assert rows(store.read(tables.CANDLES).groupBy("symbol").count(), "symbol", "count") == [("S", 5), ("T", 5)]


def test_a_run_that_stops_behind_the_archive_is_made_good(spark, landing, tmp_path):
    path, again = landing / "t_20260616.csv", {"closed": calendar.holidays(spark, [])}
    write_csv(path, minutes("2026-06-15", 5) + minutes("2026-06-16", 4) + ["S,bad,1,1"])
    store, _ = run(spark, landing, tmp_path / "store", **again)
    assert store.read(tables.CANDLES).count() == 9
    write_csv(path, minutes("2026-06-16", 4))
    ingest(spark, str(landing), store, SETTINGS)  # and nothing after it
    run(spark, landing, tmp_path / "store", **again)
    assert rows(store.read(tables.CANDLES), "trade_date") == [(day("2026-06-16"),)] * 4
    assert store.read(tables.PENDING).count() == store.read(tables.REJECTS).count() == 0


def test_files_without_a_needed_column_are_listed_and_mended(spark, landing, tmp_path):
    path = landing / "t_20260615.csv"
    write_csv(path, ["S,10"], header="symbol,price")
    write_csv(landing / "t_20260616.csv", minutes("2026-06-16", 4))
    store, _ = run(spark, landing, tmp_path / "store")
    assert rows(store.read(tables.PROBLEMS), "source_file", "trade_date", "problem", "n_rows") == [
        ("t_20260615.csv", day("2026-06-15"), "no column time, volume", 1)
    ]
    write_csv(path, minutes("2026-06-15", 5))
    run(spark, landing, tmp_path / "store")
    assert store.read(tables.PROBLEMS).count() == 0 and store.read(tables.CANDLES).count() == 9


@pytest.mark.parametrize("source", ["sqlite", "csv"])
def test_each_file_is_read_once(spark, landing, tmp_path, monkeypatch, source):
    lines, settings = minutes("2026-06-15", 5), replace(SETTINGS, source_format=source)
    path, own = landing / f"t_20260615.{'db' if source == 'sqlite' else 'csv'}", jobs.raw_files

    def emptied(stored, settings):
        path.write_bytes(b"")  # from here on only the stored rows can be read
        return own(stored, settings)

    monkeypatch.setattr(jobs, "raw_files", emptied)
    store = Store(spark, str(tmp_path / "store"))
    for _ in range(2):
        path.unlink(missing_ok=True)
        if source == "sqlite":
            write_db(path, [tuple(line.split(",")) for line in lines])
        else:
            write_csv(path, lines)
        backfill(spark, str(landing), store, settings, built_at=BUILT, csv=False)
        assert store.read(tables.CANDLES).count() == 5
