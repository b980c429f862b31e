"""Coverage, validation and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import COVERAGE, DAY_STATS, conform
from tickbars.operators.status import COMPLETE, CONFLICT, MISSING


def coverage(days: DataFrame, stats: DataFrame) -> DataFrame:
    """Status of every day of ``days``; a day without statistics is MISSING/absent.

    Pass the expected trading days for the calendar view, or the days with
    data for the observed view.
    """
    known = stats.select("trade_date", "status", "reason", "minutes_count", "symbols_count")
    joined = days.select("trade_date").distinct().join(known, "trade_date", "left")
    absent = F.col("status").isNull()
    return conform(
        joined.select(
            "trade_date",
            F.date_format("trade_date", "EEEE").alias("day_of_week"),
            F.when(absent, MISSING).otherwise(F.col("status")).alias("status"),
            F.when(absent, "absent").otherwise(F.col("reason")).alias("reason"),
            F.coalesce("minutes_count", F.lit(0)).alias("minutes_count"),
            F.coalesce("symbols_count", F.lit(0)).alias("symbols_count"),
        ),
        COVERAGE,
    )


def coverage_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == COMPLETE).alias("complete"),
        F.count_if(F.col("status") == MISSING).alias("missing"),
        F.count_if(F.col("status") == CONFLICT).alias("conflict"),
    )


def candle_count(candles: DataFrame) -> DataFrame:
    return candles.agg(F.count("*").alias("n_candles"))


def run_summary(report: DataFrame, candles: DataFrame) -> DataFrame:
    """One row: date range, expected and classified days, candles and symbols."""
    totals = coverage_summary(report).withColumns(
        {
            "first_date": report.agg(F.min("trade_date").alias("v")).scalar(),
            "last_date": report.agg(F.max("trade_date").alias("v")).scalar(),
            "n_candles": candles.agg(F.count("*").alias("v")).scalar(),
            "n_symbols": candles.agg(F.count_distinct("symbol").alias("v")).scalar(),
        }
    )
    return totals.select(
        "first_date", "last_date", "total", "complete", "missing", "conflict", "n_candles", "n_symbols"
    )


def validation_report(stats: DataFrame) -> DataFrame:
    return conform(stats, DAY_STATS)
