import sqlite3
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import at, day, rows
from tickbars import Settings, SourceColumns
from tickbars.operators import ticks
from tickbars.sources.files import landed_files, read_csv_ticks, read_problems, read_raw_ticks, read_sqlite_ticks, sqlite_read_errors
from tickbars.sources.paths import scratch_dir
from tickbars.sources.sqlite import SqliteReader

CSV = Settings(source_format="csv")
SQLITE = Settings()


def write_csv(path, lines, header="symbol,time,price,volume"):
    path.write_text("\n".join([header, *lines]) + "\n")


def write_db(path, data, ddl="symbol TEXT, time TEXT, price REAL, volume INTEGER", table="intraday_data"):
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE {table} ({ddl})")
        if data:
            db.executemany(f"INSERT INTO {table} VALUES ({','.join('?' * len(data[0]))})", data)
    db.close()


def test_csv_files_of_a_folder(spark, tmp_path):
    write_csv(tmp_path / "t_20260618.csv", ["S,2026-06-18 05:00:00,10.5,3", "S,bad,x,y"])
    write_csv(tmp_path / "t_20260619.csv", ["S,2026-06-19 05:00:00,11,4"])
    write_csv(tmp_path / "notes.txt", ["not,a,tick,file"])
    got = ticks.normalise_ticks(read_csv_ticks(spark, str(tmp_path), CSV), CSV)
    assert rows(got, "symbol", "ts_utc", "trade_date", "price", "volume", "source_file") == sorted(
        [
            ("S", at("2026-06-18T05:00:00"), day("2026-06-18"), 10.5, 3, "t_20260618.csv"),
            ("S", None, None, None, None, "t_20260618.csv"),
            ("S", at("2026-06-19T05:00:00"), day("2026-06-19"), 11.0, 4, "t_20260619.csv"),
        ],
        key=repr,
    )


def test_csv_column_names_are_a_setting(spark, tmp_path):
    own = replace(CSV, columns=SourceColumns("ticker", "px", "qty", "stamp"), timestamp_format="epoch_s")
    write_csv(tmp_path / "a.csv", ["9,1781842620,10,S"], header="qty,stamp,px,ticker")
    got = ticks.normalise_ticks(read_csv_ticks(spark, str(tmp_path), own), own)
    assert rows(got, "symbol", "ts_utc", "price", "volume") == [("S", at("2026-06-19T04:17:00"), 10.0, 9)]


def test_csv_files_of_several_headers(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["S,2026-06-18 05:00:00,1,1"])
    write_csv(tmp_path / "b_20260618.csv", ["2,S,2026-06-18 05:01:00,x y,5"], header="\ufeffvolume,symbol,time,note,price")
    write_csv(tmp_path / "c.csv", ["3,S,2026-06-18 05:02:00,6"], header="volume,symbol,time,price")
    write_csv(tmp_path / "d_20260618.csv", ["S,2026-06-18 05:03:00,1", "S,2026-06-18 05:04:00,2"], header="symbol,time,price")
    write_csv(tmp_path / "e.csv", [])
    (tmp_path / "f.csv").write_text("")
    got = read_csv_ticks(spark, str(tmp_path), CSV)
    assert rows(got, "symbol", "ts_raw", "price", "volume", "source_file") == sorted(
        [
            ("S", "2026-06-18 05:00:00", "1", "1", "a.csv"),
            ("S", "2026-06-18 05:01:00", "5", "2", "b_20260618.csv"),
            ("S", "2026-06-18 05:02:00", "6", "3", "c.csv"),
        ],
        key=repr,
    )
    assert rows(read_problems(spark, str(tmp_path), CSV), "source_file", "trade_date", "problem", "n_rows") == [
        ("d_20260618.csv", day("2026-06-18"), "no column volume", 2)
    ]


def test_no_row_of_a_file_in_blocks_is_taken_for_its_header(spark, tmp_path):
    lines = [f"S,2026-06-18 05:00:00,{i},1" for i in range(20_000)]
    write_csv(tmp_path / "long.csv", lines)
    write_csv(tmp_path / "other.csv", ["1,S,2026-06-18 05:00:00,1"], header="volume,symbol,time,price")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = read_csv_ticks(spark, str(tmp_path), CSV)
        assert got.where("source_file = 'long.csv'").select("price").distinct().count() == got.count() - 1 == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    folders = [tmp_path / "x", tmp_path / "y"]
    for k, folder in enumerate(folders):
        folder.mkdir()
        write_csv(folder / "t.csv", [f"S,2026-06-18 05:0{k}:00,1,1"])
    got = read_csv_ticks(spark, [str(f) for f in folders], CSV)
    assert [(a, b.rsplit("/", 2)[1]) for a, b in rows(got, "source_file", "source_path")] == [("t.csv", "x"), ("t.csv", "y")]


@pytest.mark.parametrize("settings", [CSV, SQLITE])
def test_missing_folder_has_no_ticks(spark, tmp_path, settings):
    assert read_raw_ticks(spark, str(tmp_path / "absent"), settings).count() == 0


def test_sqlite_files(spark, tmp_path):
    write_db(tmp_path / "t_20260618.db", [("S", "2026-06-18 05:00:00", 10.1, 3), (None, "2026-06-18 05:00:01", 0.1 + 0.2, 4.0)])
    write_db(tmp_path / "t_20260619.db", [("S", 1781842620, "11", 12.9)], "symbol, time, price, volume")
    write_db(tmp_path / "empty.db", [])
    settings = replace(SQLITE, timestamp_format="auto")
    got = ticks.normalise_ticks(read_sqlite_ticks(spark, str(tmp_path), settings), settings)
    assert rows(got, "symbol", "ts_utc", "price", "volume", "source_file") == sorted(
        [
            ("S", at("2026-06-18T05:00:00"), 10.1, 3, "t_20260618.db"),
            (None, at("2026-06-18T05:00:01"), 0.1 + 0.2, 4, "t_20260618.db"),
            ("S", at("2026-06-19T04:17:00"), 11.0, 12, "t_20260619.db"),
        ],
        key=repr,
    )


def test_sqlite_column_names_and_table_are_settings(spark, tmp_path):
    write_db(tmp_path / "a.db", [("S", "2026-06-18 05:00:00", 1.0, 2)], '"the ticker", stamp, px, qty', "trades")
    own = replace(SQLITE, columns=SourceColumns("the ticker", "px", "qty", "stamp"), sqlite_table="trades")
    assert rows(read_sqlite_ticks(spark, str(tmp_path), own), "symbol", "price", "volume") == [("S", "1.0", "2")]


def test_unreadable_sqlite_file_is_reported_and_the_rest_read(spark, tmp_path):
    write_db(tmp_path / "good.db", [("S", "2026-06-18 05:00:00", 1.0, 2)])
    (tmp_path / "broken.db").write_bytes(b"this is no database" * 100)
    write_db(tmp_path / "other.db", [("x",)], "a TEXT", "something_else")
    assert read_sqlite_ticks(spark, str(tmp_path), SQLITE).count() == 1
    assert [r[0] for r in rows(sqlite_read_errors(spark, str(tmp_path), SQLITE), "source_file")] == ["broken.db", "other.db"]


def test_one_large_sqlite_file_is_read_by_many_tasks(spark, tmp_path):
    data = [("S", "2026-06-18 05:00:00", 1.0, i) for i in range(1000)]
    write_db(tmp_path / "big.db", data)
    with sqlite3.connect(tmp_path / "big.db") as db:
        db.execute("DELETE FROM intraday_data WHERE volume BETWEEN 300 AND 420")
    reader = SqliteReader({"path": str(tmp_path), "rowspersplit": "64"})
    parts = reader.partitions()
    assert len(parts) == 16
    got = sorted(int(v) for p in parts for b in reader.read(p) for v in b.column("volume").to_pylist())
    assert got == [i for i in range(1000) if not 300 <= i <= 420]


def test_sqlite_table_without_row_ids(spark, tmp_path):
    with sqlite3.connect(tmp_path / "w.db") as db:
        db.execute("CREATE TABLE intraday_data (symbol TEXT, time TEXT, price REAL, volume INTEGER, PRIMARY KEY (symbol, time)) WITHOUT ROWID")
        db.execute("INSERT INTO intraday_data VALUES ('S', '2026-06-18 05:00:00', 1, 1)")
    assert read_sqlite_ticks(spark, str(tmp_path), SQLITE).count() == 1


def test_landed_files_carry_their_date(spark, tmp_path):
    write_csv(tmp_path / "t_20260618.csv", [])
    write_csv(tmp_path / "x.csv", [])
    assert rows(landed_files(spark, str(tmp_path), CSV), "source_file", "trade_date") == [
        ("t_20260618.csv", day("2026-06-18")), ("x.csv", None)
    ]


def test_scratch_folders_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first.startswith(shared) and first != second


def test_merged_sources_keep_every_row(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["S,2026-06-18 05:00:00,1,1"])
    write_db(tmp_path / "b.db", [("S", "2026-06-18 05:00:00", 1.0, 1)])
    merged = ticks.merge_sources(
        [
            ticks.normalise_ticks(read_csv_ticks(spark, str(tmp_path), CSV), CSV),
            ticks.normalise_ticks(read_sqlite_ticks(spark, str(tmp_path), SQLITE), SQLITE),
        ]
    )
    assert merged.count() == 2 and ticks.dedup_ticks(merged).count() == 1
    assert merged.select(F.count_distinct("source_file")).first()[0] == 2


def test_a_broken_sqlite_file_is_left_out_whole(spark, tmp_path):
    write_db(tmp_path / "bad_20260618.db", [("S", "2026-06-18 05:00:00", float(i), i) for i in range(60_000)])
    write_db(tmp_path / "good_20260618.db", [("S", "2026-06-18 05:00:00", 1.0, 1)])
    path = tmp_path / "bad_20260618.db"
    data = bytearray(path.read_bytes())
    middle = len(data) * 6 // 10 // 4096 * 4096
    data[middle : middle + 3 * 4096] = b"\xff" * (3 * 4096)
    path.write_bytes(data)
    assert rows(read_sqlite_ticks(spark, str(tmp_path), SQLITE), "source_file") == [("good_20260618.db",)]
    problems = read_problems(spark, str(tmp_path), SQLITE).collect()
    assert [(r.source_file, r.trade_date) for r in problems] == [("bad_20260618.db", day("2026-06-18"))] and problems[0].problem


def test_far_row_ids_do_not_flood_the_driver(tmp_path):
    path = tmp_path / "wide.db"
    write_db(path, [])
    with sqlite3.connect(path) as db:
        db.execute("INSERT INTO intraday_data (rowid, symbol) VALUES (1, 'A'), (1000000000000, 'B')")
    db.close()
    ranges = SqliteReader({"path": str(path)}).partitions()
    assert len(ranges) == 1 and (ranges[0].first_row, ranges[0].last_row) == (1, 10**12)


def test_landed_files_of_an_absent_folder(spark, tmp_path):
    assert landed_files(spark, str(tmp_path / "none"), CSV).count() == 0
