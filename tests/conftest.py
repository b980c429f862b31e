import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A session zone with daylight saving: no result may depend on it.
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tickbars-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def make_ticks(spark, data, settings=None):
    """(symbol, utc text, price, volume[, source]) tuples to typed ticks."""
    from tickbars.operators.ticks import with_local_time
    from tickbars.schemas import TICKS, conform
    from tickbars.settings import Settings

    full = [
        (s, at(t) if t else None, None if p is None else float(p), v, (rest or ["A"])[0])
        for s, t, p, v, *rest in data
    ]
    frame = spark.createDataFrame(
        full, "symbol STRING, ts_utc TIMESTAMP_NTZ, price DOUBLE, volume BIGINT, source_file STRING"
    )
    return conform(with_local_time(frame, settings or Settings()), TICKS)


def make_candles(spark, data):
    """(symbol, utc text, open, high, low, close, volume) tuples to bars."""
    from datetime import timedelta

    full = []
    for symbol, t, *ohlcv in data:
        ts = at(t)
        local = ts + timedelta(hours=5)
        full.append((symbol, local.date(), ts, local, *ohlcv, True))
    return spark.createDataFrame(
        full,
        "symbol STRING, trade_date DATE, ts TIMESTAMP_NTZ, minute_local TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, "
        "low DOUBLE, close DOUBLE, volume BIGINT, had_trade BOOLEAN",
    )
