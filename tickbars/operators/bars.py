"""Bars: ticks to one minute, one minute to N minutes and to days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions.timestamps import floor_minutes, to_local
from tickbars.operators.ticks import KEPT
from tickbars.settings import Settings

OHLCV = ("open", "high", "low", "close", "volume")


def ohlcv_from_ticks(trades: DataFrame, *key: str) -> DataFrame:
    """OHLCV per ``key``; ties on the timestamp go by price, then volume.

    Partial aggregation shrinks a busy minute before the shuffle.
    """
    order = F.struct("ts_utc", "price", "volume")
    return trades.groupBy(*key).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("volume").alias("volume"),
    )


def candles_1m(trades: DataFrame, settings: Settings) -> DataFrame:
    """Sparse one-minute bars of all symbols and days; no trade, no row."""
    minutes = trades.withColumn("ts", floor_minutes(F.col("ts_utc")))
    return _as_candles(ohlcv_from_ticks(minutes, "symbol", "trade_date", "ts"), settings)


def candles_from_slices(slices: DataFrame, settings: Settings) -> DataFrame:
    """The same bars as ``candles_1m``, from the kept ``trade_slices``."""
    minutes = slices.filter(F.col("fate") == KEPT).withColumn("ts", floor_minutes(F.col("first_ts")))
    return _as_candles(minutes.groupBy("symbol", "trade_date", "ts").agg(*_rolled("slice")), settings)


def _as_candles(bars: DataFrame, settings: Settings) -> DataFrame:
    return bars.select(
        "symbol",
        "trade_date",
        "ts",
        to_local(F.col("ts"), settings.timezone).alias("minute_local"),
        *OHLCV,
        F.lit(True).alias("had_trade"),
    )


def rollup(candles: DataFrame, minutes: int, settings: Settings) -> DataFrame:
    """One-minute bars to ``minutes``-wide bars, aligned to the local hour.

    Buckets are instants, so the hour that comes twice when clocks go back
    gives bars of its own each time.
    """
    if minutes < 1 or 60 % minutes:
        raise ValueError(f"minutes must divide 60, got {minutes}")
    past = F.minute("minute_local") % minutes
    buckets = candles.withColumn("bucket", F.timestamp_add("MINUTE", -past, F.col("ts")))
    return (
        buckets.groupBy("symbol", "trade_date", "bucket")
        .agg(*_rolled("ts"))
        .select("symbol", "trade_date", F.col("bucket").alias("ts"), *OHLCV)
    )


def daily_bars(candles: DataFrame) -> DataFrame:
    """One bar per symbol and day. Gate the candles by day status first."""
    return candles.groupBy("symbol", "trade_date").agg(*_rolled("ts"), F.count("*").alias("minutes_count"))


def _rolled(order: str) -> list[Column]:
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
    ]
