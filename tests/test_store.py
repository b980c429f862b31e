import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import at, day, make_ticks, rows
from tickbars import schemas
from tickbars.operators import merge
from tickbars.sources import store as tables
from tickbars.sources.store import Store

STATUS = "symbol STRING, trade_date DATE, status STRING, reason STRING, minutes_count BIGINT"
FIRST, SECOND = datetime(2026, 6, 20), datetime(2026, 6, 21)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def candles(spark, *data):
    """(symbol, utc text, close) to stored bars."""
    full = [(s, at(t).date(), at(t), at(t), c, c, c, c, 1, True, False) for s, t, c in data]
    return spark.createDataFrame(full, schemas.CANDLES)


def statuses(spark, moment, *data):
    full = [(s, day(d), status, None, n, None, None, moment) for s, d, status, n in data]
    return spark.createDataFrame(full, schemas.DAY_STATUS)


def test_a_table_not_written_yet_is_empty(store):
    assert store.read(tables.CANDLES).count() == 0


def test_archive_keeps_every_file_of_a_day(spark, store):
    frame = make_ticks(
        spark,
        [("S", "2026-06-18T05:00:00", 1, 1, "a=1.csv"), ("S", "2026-06-18T05:00:00", 2, 1, "20260618"), (None, None, None, None, "a=1.csv")],
    )
    store.archive(frame)
    store.archive(frame.filter(F.col("source_file") == "20260618"))
    columns = frame.columns
    assert rows(store.read(tables.ARCHIVE), *columns) == rows(frame, *columns)


def test_upsert_replaces_and_adds_by_key_and_leaves_other_days(spark, store):
    store.upsert(tables.CANDLES, candles(spark, ("A", "2026-06-17T05:00:00", 1.0), ("A", "2026-06-18T05:00:00", 2.0), ("A", "2026-06-18T05:01:00", 3.0)))
    update = candles(spark, ("A", "2026-06-18T05:01:00", 30.0), ("B", "2026-06-18T05:01:00", 4.0), ("B", "2026-06-19T05:00:00", 5.0))
    expected = [1.0, 2.0, 30.0, 4.0, 5.0]
    for _ in range(2):  # twice is once
        store.upsert(tables.CANDLES, update)
        got = [r.close for r in store.read(tables.CANDLES).orderBy("symbol", "ts").collect()]
        assert got == expected


def test_last_writer_wins_by_the_given_order(spark):
    frame = spark.createDataFrame([("A", 1, "old"), ("A", 3, "new"), ("A", 2, "mid"), ("B", 1, None)], "k STRING, version INT, v STRING")
    assert rows(merge.last_per_key(frame, ["k"], ["version"]), "k", "version", "v") == [("A", 3, "new"), ("B", 1, None)]


def test_partial_upsert_keeps_the_other_columns(spark, store):
    store.upsert(tables.DAY_STATUS, statuses(spark, FIRST, ("A", "2026-06-18", "COMPLETE", 5), ("B", "2026-06-18", "COMPLETE", 6)))
    changes = statuses(spark, SECOND, ("A", "2026-06-18", "MISSING", 0), ("*", "2026-06-18", "MISSING", 0), ("*", "2026-06-19", "MISSING", 0))
    store.partial_upsert(
        tables.DAY_STATUS,
        changes.select("symbol", "trade_date", "status", "reason", "built_at"),
        ["status", "reason", "built_at"],
        {"minutes_count": F.lit(0)},
    )
    assert rows(store.read(tables.DAY_STATUS), "symbol", "trade_date", "status", "minutes_count", "built_at") == [
        ("*", day("2026-06-18"), "MISSING", 0, SECOND),
        ("*", day("2026-06-19"), "MISSING", 0, SECOND),
        ("A", day("2026-06-18"), "MISSING", 5, SECOND),
        ("B", day("2026-06-18"), "COMPLETE", 6, FIRST),
    ]


def test_replace_days_removes_what_is_gone(spark, store):
    store.upsert(tables.CANDLES, candles(spark, *(("A", f"2026-06-{d}T05:00:00", 1.0) for d in (16, 17, 18)), ("B", "2026-06-17T05:00:00", 1.0)))
    dates = spark.createDataFrame([(day("2026-06-17"),), (day("2026-06-18"),)], "trade_date DATE")
    store.replace_days(tables.CANDLES, candles(spark, ("A", "2026-06-17T05:01:00", 9.0)), dates)
    assert rows(store.read(tables.CANDLES), "symbol", "ts", "close") == [
        ("A", at("2026-06-16T05:00:00"), 1.0), ("A", at("2026-06-17T05:01:00"), 9.0)
    ]


def test_read_of_some_days_prunes_partitions(spark, store):
    store.upsert(tables.CANDLES, candles(spark, *(("A", f"2026-06-{d}T05:00:00", 1.0) for d in (16, 17, 18))))
    dates = spark.createDataFrame([(day("2026-06-17"),)], "trade_date DATE")
    frame = store.read(tables.CANDLES, dates)
    assert frame.count() == 1
    assert "dynamicpruning" in frame._jdf.queryExecution().optimizedPlan().toString().lower()


def test_candle_csvs_are_one_per_symbol_and_day(spark, store, tmp_path):
    frame = candles(spark, ("A", "2026-06-18T05:00:00", 1.5), ("A", "2026-06-18T05:01:00", 2.0), ("B", "2026-06-18T05:00:00", 3.0))
    for _ in range(2):
        store.write_candle_csvs(frame)
    assert rows(store.read_candle_csvs(), *tables.CSV_COLUMNS) == rows(frame, *tables.CSV_COLUMNS)
    files = list((tmp_path / "store" / "csv").glob("for_symbol=*/for_date=*/*.csv"))
    assert len(files) == 2
    first = files[0].read_text().splitlines()[0]
    assert first == "symbol,minute_local,ts,open,high,low,close,volume,had_trade"


def test_staged_rows_are_gone_afterwards(spark, store, tmp_path):
    with store.staged(candles(spark, ("A", "2026-06-18T05:00:00", 1.0)), schemas.CANDLES) as rows_:
        assert rows_.count() == 1
    assert not list((tmp_path / "store" / "_staging").iterdir())


def test_rows_that_break_a_rule_are_set_aside(spark, store):
    ok = candles(spark, ("A", "2026-06-17T05:00:00", 1.0), ("B", "2026-06-17T05:00:00", 2.0))
    twice = candles(spark, ("C", "2026-06-17T05:00:00", 1.0), ("C", "2026-06-17T05:00:00", 2.0))
    holes = candles(spark, ("D", "2026-06-18T05:00:00", None), (None, "2026-06-18T05:01:00", 1.0)).union(candles(spark, ("E", "2026-06-18T05:00:00", 1.0)).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    bare = candles(spark, ("F", "2026-06-18T05:00:00", 5.0)).withColumn("volume", F.lit(None).cast("bigint")).withColumn("had_trade", F.lit(None).cast("boolean"))
    store.guarded_upsert(tables.CANDLES, ok.union(twice).union(holes).union(bare))
    assert rows(store.read(tables.CANDLES), "symbol", "volume", "had_trade") == [("A", 1, True), ("B", 1, True), ("F", 0, True)]
    assert rows(store.read(tables.BREACHES), "table_name", "trade_date", "rule") == [
        ("candles_1m", day("2026-06-17"), "repeated_key"), ("candles_1m", day("2026-06-17"), "repeated_key"),
        ("candles_1m", day("2026-06-18"), "null_open"), ("candles_1m", day("2026-06-18"), "null_symbol"), ("candles_1m", day("2026-06-18"), "null_ts"),
    ]
    store.guarded_upsert(tables.CANDLES, candles(spark, ("C", "2026-06-17T05:00:00", 3.0)))  # the day comes again, clean
    assert rows(store.read(tables.BREACHES), "trade_date") == [(day("2026-06-18"),)] * 3
    assert store.read(tables.CANDLES).count() == 4


def test_conform_orders_casts_and_adds(spark):
    frame = spark.createDataFrame([(1, "A")], "minutes_count INT, symbol STRING")
    out = schemas.conform(frame, schemas.DAY_STATUS)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DAY_STATUS.fields]


def test_null_and_repeated_keys_are_refused(spark, store):
    twice = candles(spark, ("A", "2026-06-17T05:00:00", 1.0), ("A", "2026-06-17T05:00:00", 2.0))
    with pytest.raises(ValueError, match="repeated keys"):
        store.upsert(tables.CANDLES, twice)
    store.upsert(tables.CANDLES, twice, newest=["close"])
    assert rows(store.read(tables.CANDLES), "close") == [(2.0,)]
    with pytest.raises(ValueError, match="null"):
        store.upsert(tables.CANDLES, candles(spark, (None, "2026-06-17T05:00:00", 1.0)))


def test_partitions_with_odd_names_can_be_dropped(spark, store):
    frame = make_ticks(spark, [("S", "2026-06-18T05:00:00", 1, 1, "a=1 %.csv"), (None, None, None, None, "a=1 %.csv"), ("S", "2026-06-18T05:00:00", 2, 1, "b")])
    by_name = tables.Table("by_name", schemas.TICKS, ("trade_date", "source_file"))
    store.overwrite_partitions(by_name, frame)
    gone = frame.filter("source_file <> 'b'").select("trade_date", "source_file")
    store.drop_partitions(by_name, gone)
    assert rows(store.read(by_name), "source_file") == [("b",)]


def archived(spark, *data):
    """(path, day, price) to ticks of files that all have one name."""
    frame = make_ticks(spark, [("S", d and f"{d}T05:00:00", p, 1, path) for path, d, p in data])
    return frame.withColumn("source_path", F.col("source_file")).withColumn("source_file", F.lit("t.csv"))


def test_a_file_replaces_only_its_own_rows_in_shared_folders(spark, tmp_path):
    store = Store(spark, str(tmp_path / "one"), buckets=1)  # all files of a day share a folder
    store.archive(archived(spark, ("/a/t.csv", "2026-06-17", 1), ("/a/t.csv", "2026-06-18", 2), ("/b/t.csv", "2026-06-18", 3), ("/b/t.csv", None, 4), ("/a/t.csv", None, 5)))
    store.archive(archived(spark, ("/a/t.csv", "2026-06-19", 6)))
    got = rows(store.read(tables.ARCHIVE), "source_path", "trade_date", "price")
    assert got == sorted([("/a/t.csv", day("2026-06-19"), 6.0), ("/b/t.csv", day("2026-06-18"), 3.0), ("/b/t.csv", None, 4.0)], key=repr)
    assert rows(store.read(tables.INGESTED), "source_path", "trade_date", "n_ticks") == sorted(
        [("/a/t.csv", day("2026-06-19"), 1), ("/b/t.csv", day("2026-06-18"), 1), ("/b/t.csv", None, 1)], key=repr
    )
    assert rows(store.read(tables.PENDING), "trade_date", "emptied") == [
        (day("2026-06-17"), True), (day("2026-06-18"), True), (day("2026-06-19"), False)
    ]
    days = [p.name for p in (tmp_path / "one" / "archive").iterdir() if p.is_dir()]
    assert "trade_date=2026-06-17" not in days or not list((tmp_path / "one" / "archive" / "trade_date=2026-06-17").iterdir())


@pytest.mark.parametrize("step", ["overwrite_partitions", "drop_partitions", "_replace_listed"])
@pytest.mark.parametrize("nth", [1, 2])
def test_work_that_stops_anywhere_is_finished_by_the_next_call(spark, tmp_path, monkeypatch, step, nth):
    store = Store(spark, str(tmp_path / "store"), buckets=1)
    store.archive(archived(spark, ("/a/t.csv", "2026-06-17", 1), ("/a/t.csv", "2026-06-18", 2), ("/b/t.csv", "2026-06-18", 3)))
    calls, own = [], getattr(Store, step)

    def breaks(self, table, *rest, **options):
        mine = step == "_replace_listed" or table.name in ("archive", "ingested")
        if mine:
            calls.append(table)
        if len(calls) == nth and mine:
            if step == "overwrite_partitions":  # a folder is gone and its new content not there yet
                shutil.rmtree(tmp_path / "store" / "archive" / "trade_date=2026-06-18")
            raise RuntimeError("stopped")
        return own(self, table, *rest, **options)

    monkeypatch.setattr(Store, step, breaks)
    with pytest.raises(RuntimeError, match="stopped"):
        store.archive(archived(spark, ("/a/t.csv", "2026-06-18", 9)))
    monkeypatch.undo()
    assert day("2026-06-17") in [r.trade_date for r in store.read(tables.PENDING).where("emptied").collect()]
    again = Store(spark, str(tmp_path / "store"), buckets=1)
    again.recover()
    want = [("/a/t.csv", day("2026-06-18"), 9.0), ("/b/t.csv", day("2026-06-18"), 3.0)]
    assert rows(again.read(tables.ARCHIVE), "source_path", "trade_date", "price") == want
    assert rows(again.read(tables.INGESTED), "source_path", "trade_date", "n_ticks") == [(p, d, 1) for p, d, _ in want]
    assert not list((tmp_path / "store" / "_intents").iterdir())


def test_an_unfinished_note_of_work_is_dropped(spark, store, tmp_path):
    store.archive(archived(spark, ("/a/t.csv", "2026-06-18", 2)))
    (tmp_path / "store" / "_intents" / "half" / "ticks").mkdir(parents=True)
    store.recover()
    assert rows(store.read(tables.ARCHIVE), "price") == [(2.0,)] and not list((tmp_path / "store" / "_intents").iterdir())


def test_few_rows_of_many_days_are_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from tickbars.sources.store import STALE, Store

    store = Store(spark, str(tmp_path / "spread"))
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    days = spark.range(4000).select(F.expr("date_add(date'2024-01-01', int(id % 40))").alias("trade_date"))
    rows = days.withColumn("n_rows", F.monotonically_increasing_id()).withColumn("problem", F.sha2(F.col("n_rows").cast("string"), 512))
    store.overwrite_partitions(STALE, rows)
    files = [f for f in (tmp_path / "spread").rglob("part-*.parquet")]
    assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) == 2
    assert store.read(STALE).count() == 4000 and spark.conf.get(key) == before
