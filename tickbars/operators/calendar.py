"""Expected trading days and session windows per day."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.sessions import session_windows as windows_of
from tickbars.settings import DEFAULT_HOLIDAYS, SessionRules


def holidays(spark: SparkSession, rows: Iterable[tuple[date, str]] = DEFAULT_HOLIDAYS) -> DataFrame:
    return spark.createDataFrame(list(rows), "date DATE, name STRING")


def day_range(df: DataFrame, day: str = "trade_date") -> DataFrame:
    """One row with the first and last day of ``df``."""
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def trading_days(span: DataFrame, closed: DataFrame, rules: SessionRules) -> DataFrame:
    """Weekdays with a session between ``first_day`` and ``last_day``, less holidays."""
    every_day = span.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("trade_date")
    )
    return every_day.filter(is_session_weekday(F.col("trade_date"), rules)).join(
        closed.select(F.col("date").alias("trade_date")), "trade_date", "left_anti"
    )


def expected_days(
    spark: SparkSession, first: date, last: date, closed: DataFrame, rules: SessionRules
) -> DataFrame:
    span = spark.createDataFrame([(first, last)], "first_day DATE, last_day DATE")
    return trading_days(span, closed, rules)


def is_session_weekday(day: Column, rules: SessionRules) -> Column:
    return F.weekday(day).isin(*rules.weekdays)


def session_table(dates: DataFrame, rules: SessionRules) -> DataFrame:
    """One row per date and window, in seconds of the local day."""
    return dates.select("trade_date", F.posexplode(windows_of(F.col("trade_date"), rules))).select(
        "trade_date", (F.col("pos") + 1).alias("window_no"), "col.start_second", "col.end_second"
    )
