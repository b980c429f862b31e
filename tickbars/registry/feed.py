"""Tick and bar feeds derived from the ``events`` table.

The table is clean, so the feeds put in the kinds of dirt real ticks have:
nulls, negative prices and volumes, whole copied days, and bars that break a
check. Every event takes part.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from dataclasses import replace
from datetime import date, time

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators.bars import candles_1m
from tickbars.operators.ticks import session_trades, with_local_time
from tickbars.schemas import TICKS, conform
from tickbars.settings import DatedHours, Hours, Limits, SessionRules, Settings

SETTINGS = Settings(
    timestamp_format="iso",
    source_format="csv",
    file_layout="single_file",
    limits=Limits(min_session_minutes=80, min_symbol_minutes=20),
)

# The regular rules plus dated hours from Tuesday to Friday.
OVERRIDES = replace(
    SETTINGS,
    session=SessionRules(
        overrides=(DatedHours(date(2024, 1, 9), date(2024, 1, 12), Hours(time(10, 0), time(13, 0))),)
    ),
)

# Days without a session in the test calendar.
CLOSED = ((date(2024, 1, 5), "Friday"), (date(2024, 1, 15), "Monday"), (date(2024, 1, 20), "Saturday"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def tick_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with dirt; some days come twice, from files A and B.

    The copies are generated after the local time is known, so a filter on it
    does not work it out again for every comparison.
    """
    stamped = with_local_time(events(spark, sf_dir).withColumn("ts_utc", F.col("ts")), SETTINGS)
    day = F.day("trade_date")
    files = F.when(F.col("twice"), F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("A")))
    copied = stamped.select(
        "event_id", "event_type", "ts_utc", "ts_local", "trade_date", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        ((day % 5 == 0) | (day % 7 == 0)).alias("twice"),
        (day % 7 == 0).alias("altered"),
    ).withColumn("source_file", F.explode(files))
    n, price, second = F.col("event_id"), F.col("value"), F.col("source_file") == "B"

    def dirt(every: int) -> Column:
        return (F.col("source_file") == "A") & (n % every == 0) & ~F.col("twice")

    return conform(
        copied.select(
            F.when(~dirt(101), F.col("event_type")).alias("symbol"),
            *(F.when(~dirt(83), F.col(c)).alias(c) for c in ("ts_utc", "ts_local", "trade_date")),
            F.when(dirt(97), -price)
            .when(second & F.col("altered") & (n % 5 == 0), price + 1)
            .otherwise(price)
            .alias("price"),
            F.when(dirt(89), None).when(dirt(79), F.lit(-1)).otherwise(F.col("k")).alias("volume"),
            "source_file",
        ),
        TICKS,
    )


def iso_text(ts: Column) -> Column:
    """``2024-01-01T00:00:00.5Z`` of a UTC timestamp, free of the session zone."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tick feed as the text a file would hold."""
    return tick_feed(spark, sf_dir).select(
        "symbol",
        iso_text(F.col("ts_utc")).alias("ts_raw"),
        F.col("price").cast("string").alias("price"),
        F.col("volume").cast("string").alias("volume"),
        "source_file",
    )


def candle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_1m(session_trades(tick_feed(spark, sf_dir), SETTINGS), SETTINGS)


def imported_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of which some break a check."""
    m = F.minute("ts")
    rule = (
        F.when(m % 17 == 0, "high_below_low")
        .when(m % 19 == 0, "negative_open")
        .when(m % 23 == 0, "negative_volume")
        .when(m % 29 == 0, "off_minute")
        .when(m % 31 == 0, "no_close")
        .otherwise("")
    )
    bars = candle_feed(spark, sf_dir).withColumn("rule", rule)
    is_rule = F.col("rule").__eq__
    return bars.withColumns(
        {
            "high": F.when(is_rule("high_below_low"), F.col("low") - 0.01).otherwise(F.col("high")),
            "open": F.when(is_rule("negative_open"), -F.col("open")).otherwise(F.col("open")),
            "volume": F.when(is_rule("negative_volume"), F.lit(-1)).otherwise(F.col("volume")),
            "ts": F.when(is_rule("off_minute"), F.timestamp_add("SECOND", F.lit(5), F.col("ts"))).otherwise(
                F.col("ts")
            ),
            "close": F.when(~is_rule("no_close"), F.col("close")),
        }
    ).drop("rule")


def repeated_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imported bars of which some come twice."""
    bars = imported_bars(spark, sf_dir)
    times = F.when(F.minute("ts") % 37 == 0, 2).otherwise(1)
    return bars.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def write_csv_landing(raw: DataFrame, path: str) -> None:
    raw.select("symbol", F.col("ts_raw").alias("time"), "price", "volume").write.csv(path, header=True)


def write_sqlite_landing(raw: DataFrame, path: str) -> None:
    """One SQLite file per task, below a path all executors have mounted."""
    folder = path.removeprefix("file://").removeprefix("file:")
    if "://" in folder:
        raise ValueError(f"SQLite files need a mounted path, got {path}")

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        context = TaskContext.get()
        final = f"{folder}/part-{context.partitionId()}.db"
        draft = f"{final}.{context.taskAttemptId()}"
        written = 0
        connection = sqlite3.connect(draft)
        connection.execute("CREATE TABLE intraday_data (symbol TEXT, time TEXT, price REAL, volume INTEGER)")
        for batch in batches:
            rows = batch.astype(object).where(batch.notna(), None).values.tolist()
            connection.executemany("INSERT INTO intraday_data VALUES (?, ?, ?, ?)", rows)
            written += len(rows)
        connection.commit()
        connection.close()
        os.replace(draft, final)  # a repeated task replaces the whole file
        yield pd.DataFrame({"n": [written]})

    columns = raw.select("symbol", "ts_raw", "price", "volume")
    columns.mapInPandas(save, "n BIGINT").write.format("noop").mode("overwrite").save()
