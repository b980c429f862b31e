"""Read-time shaping of stored bars.

Bars are never invented for a day that is not COMPLETE. ``had_trade`` tells
real bars from filled ones, ``status`` tells days apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickbars.functions.sessions import session_windows
from tickbars.functions.timestamps import to_local, to_utc
from tickbars.operators.bars import OHLCV, daily_bars
from tickbars.operators.status import COMPLETE, effective_status
from tickbars.settings import Settings


def gated_daily_bars(candles: DataFrame, status: DataFrame) -> DataFrame:
    """Daily bars of the symbol-days whose status is COMPLETE."""
    return effective_status(daily_bars(candles), status).filter(F.col("status") == COMPLETE)


def flat_fill(candles: DataFrame, settings: Settings) -> DataFrame:
    """Add flat bars for the minutes without a trade inside the session.

    Give it candles of COMPLETE days. A filled bar repeats the close before
    it; nothing is filled before the first bar of a symbol's day. The minute
    grid covers only symbol-days that traded, from their first bar on.
    """
    one_minute = F.expr("INTERVAL 1 MINUTE")
    midnight = F.col("trade_date").cast("timestamp_ntz")
    grid = (
        candles.groupBy("symbol", "trade_date")
        .agg(F.min("ts").alias("first_ts"))
        .withColumn("w", F.explode(session_windows(F.col("trade_date"), settings.session)))
        .select(
            "symbol",
            "trade_date",
            F.greatest(
                to_utc(F.timestamp_add("SECOND", F.col("w.start_second"), midnight), settings.timezone), F.col("first_ts")
            ).alias("start"),
            to_utc(F.timestamp_add("SECOND", F.col("w.end_second") - 60, midnight), settings.timezone).alias("stop"),
        )
        .filter(F.col("start") <= F.col("stop"))
        .select("symbol", "trade_date", F.explode(F.sequence("start", "stop", one_minute)).alias("ts"))
    )
    so_far = W.partitionBy("symbol", "trade_date").orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    bars = candles.select("symbol", "trade_date", "ts", *OHLCV)
    key = ["symbol", "trade_date", "ts"]
    # One exchange serves both the merge of a minute and the window over its day.
    slots = bars.unionByName(grid, allowMissingColumns=True).repartition("symbol", "trade_date")
    # Real bar and grid slot of a minute meet here; aggregates skip the nulls.
    merged = slots.groupBy(*key).agg(*(F.max(c).alias(c) for c in OHLCV))
    real = F.col("close").isNotNull()
    return (
        merged.withColumn("carried", F.last("close", ignorenulls=True).over(so_far))
        .filter(F.col("carried").isNotNull())
        .select(
            "symbol",
            "trade_date",
            "ts",
            to_local(F.col("ts"), settings.timezone).alias("minute_local"),
            *(F.coalesce(F.col(c), F.col("carried")).alias(c) for c in OHLCV[:4]),
            F.coalesce(F.col("volume"), F.lit(0)).alias("volume"),
            real.alias("had_trade"),
        )
    )


def carry_close(daily: DataFrame, days: DataFrame, stats: DataFrame) -> DataFrame:
    """Every symbol on every expected day from its first bar on.

    ``mark_close`` carries the last known close over days that are not
    COMPLETE; their OHLCV stays null. ``days`` are the expected days,
    ``stats`` the market status per day, ``daily`` the gated daily bars.
    """
    last_day = days.agg(F.max("trade_date").alias("d")).scalar()
    each_day = F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY")))
    calendar = (
        daily.groupBy("symbol")
        .agg(F.min("trade_date").alias("first_day"))
        .withColumn("last_day", last_day)
        .filter(F.col("first_day") <= F.col("last_day"))
        .select("symbol", each_day.alias("trade_date"))
        .join(F.broadcast(days.select("trade_date")), "trade_date", "left_semi")  # calendar-sized
    )
    known = stats.select("trade_date", F.col("status").alias("day_status"))
    # One row per symbol and calendar day.
    so_far = W.partitionBy("symbol").orderBy("trade_date").rowsBetween(W.unboundedPreceding, 0)
    rows = calendar.join(daily.select("symbol", "trade_date", *OHLCV), ["symbol", "trade_date"], "full_outer")
    return (
        rows.join(F.broadcast(known), "trade_date", "left")  # calendar-sized
        .select(
            "symbol",
            "trade_date",
            F.coalesce("day_status", F.lit("MISSING")).alias("status"),
            *OHLCV,
            F.last("close", ignorenulls=True).over(so_far).alias("mark_close"),
        )
    )
