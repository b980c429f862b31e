"""Minutes of a day that have bars, as bitmaps that can be merged.

A symbol-day is one bitmap with a bit per local minute. Bitmaps of any symbols,
stores or updates merge by OR and are counted afterwards, so minutes are never
counted twice and never listed. Adding up counts of bars, which the day
statistics do, counts a minute once for every symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import MARKET
from tickbars.settings import Settings

BELOW, WITHIN, ABOVE = "below", "within", "above"


def minute_bitmaps(candles: DataFrame) -> DataFrame:
    """(symbol, trade_date, minutes): the local minutes each symbol has a bar in."""
    minute = F.hour("minute_local") * 60 + F.minute("minute_local")
    place = F.bitmap_bit_position((minute + 1).cast("bigint"))
    return candles.groupBy("symbol", "trade_date").agg(F.bitmap_construct_agg(place).alias("minutes"))


def merge_bitmaps(bitmaps: DataFrame, *key: str) -> DataFrame:
    """Bitmaps of the same ``key`` as one."""
    return bitmaps.groupBy(*key).agg(F.bitmap_or_agg("minutes").alias("minutes"))


def _band(minutes: Column, settings: Settings) -> Column:
    most = settings.limits.max_session_minutes
    band = F.when(minutes < settings.limits.min_day_minutes, BELOW)
    return (band if most is None else band.when(minutes > most, ABOVE)).otherwise(WITHIN)


def day_minutes(bitmaps: DataFrame, settings: Settings) -> DataFrame:
    """Distinct minutes of every symbol-day, and of every day over all symbols (symbol ``*``), with their band.

    ``share`` is the part of the market's minutes that the symbol has.
    """
    own = merge_bitmaps(bitmaps, "symbol", "trade_date").withColumn("distinct_minutes", F.bitmap_count("minutes"))
    # A day has a few thousand symbols; their bitmaps merge before the shuffle.
    market = merge_bitmaps(bitmaps, "trade_date").withColumn("market_minutes", F.bitmap_count("minutes")).drop("minutes")
    of_market = F.broadcast(market)  # calendar-sized
    rows = own.select("symbol", "trade_date", "distinct_minutes").join(of_market, "trade_date").unionByName(
        market.select(F.lit(MARKET).alias("symbol"), "trade_date", F.col("market_minutes").alias("distinct_minutes"), "market_minutes")
    )
    return rows.select(
        "symbol",
        "trade_date",
        "distinct_minutes",
        (F.col("distinct_minutes") / F.col("market_minutes")).alias("share"),
        _band(F.col("distinct_minutes"), settings).alias("band"),
    )
