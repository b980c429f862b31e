"""Candle checks, day statistics and integrity checks.

A symbol-day holds at most 1,440 one-minute bars, so windows over
(symbol, trade_date) stay small however busy the symbol is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickbars.functions.sessions import open_micros
from tickbars.schemas import CANDLE_KEY, CANDLE_REQUIRED, DAY_STATS, conform
from tickbars.settings import Settings

MICROS = 1_000_000
CHECKS = ("ohlc_valid", "price_valid", "volume_valid", "minute_boundary")


def check_candles(candles: DataFrame) -> DataFrame:
    """Add the four checks and ``is_valid``, which is false when one is unknown."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    checked = candles.withColumns(
        {
            "ohlc_valid": (h >= F.greatest(o, c)) & (l <= F.least(o, c)) & (h >= l),
            "price_valid": (o > 0) & (h > 0) & (l > 0) & (c > 0),
            "volume_valid": F.col("volume") >= 0,
            "minute_boundary": F.second("ts") == 0,
        }
    )
    everything = F.lit(True)
    for check in CHECKS:
        everything = everything & F.col(check)
    return checked.withColumn("is_valid", F.coalesce(everything, F.lit(False)))


def flag_candle_spikes(candles: DataFrame, settings: Settings) -> DataFrame:
    """Mark bars whose close moves more than ``spike_pct`` from the bar before.

    Invalid bars take part, as the previous bar too.
    """
    before = F.lag("close").over(W.partitionBy("symbol", "trade_date").orderBy("ts"))
    move = F.abs(F.col("close") - F.col("_before")) / F.col("_before") > settings.limits.spike_pct
    return (
        candles.withColumn("_before", before)
        .withColumn("spike_flag", F.coalesce(F.when(F.col("_before") > 0, move), F.lit(False)))
        .drop("_before")
    )


def validate_candles(candles: DataFrame, settings: Settings) -> DataFrame:
    return flag_candle_spikes(check_candles(candles), settings)


def valid_candles(checked: DataFrame) -> DataFrame:
    return checked.filter("is_valid").drop(*CHECKS, "is_valid")


def quarantined_candles(checked: DataFrame) -> DataFrame:
    """Bars that failed a check, with the day they are quarantined for."""
    return (
        checked.filter(~F.col("is_valid"))
        .drop(*CHECKS, "is_valid")
        .withColumn("quarantine_date", F.col("trade_date"))
    )


def _gap(settings: Settings) -> Column:
    """Microseconds since the bar before of the same validity, with or without the scheduled breaks."""
    same = W.partitionBy("symbol", "trade_date", "is_valid").orderBy("ts")
    if settings.limits.gaps_count_breaks:
        return F.timestamp_diff("MICROSECOND", F.lag("ts").over(same), F.col("ts"))
    return open_micros(F.lag("minute_local").over(same), F.col("minute_local"), F.col("trade_date"), settings.session)


def _symbol_days(checked: DataFrame, settings: Settings) -> DataFrame:
    """Counters, valid bars and longest gap of every symbol-day."""

    def failures(check: str) -> Column:
        return F.count_if(~F.col(check)).alias(check)

    return (
        checked.withColumn("gap", _gap(settings))
        .groupBy("symbol", "trade_date")
        .agg(
            F.count("*").alias("bars"),
            F.count_if("is_valid").alias("valid_bars"),
            F.coalesce(F.max(F.when(F.col("is_valid"), F.col("gap"))), F.lit(0)).alias("longest_gap"),
            F.count_if("spike_flag").alias("spikes"),
            *(failures(c) for c in CHECKS),
        )
    )


def _busiest(value: str) -> Column:
    """Value of the symbol with most valid bars; ties go to the first name."""
    return F.min_by(value, F.struct(-F.col("valid_bars"), F.col("symbol")))


def day_stats(checked: DataFrame, settings: Settings) -> DataFrame:
    """Status and counters of every day that has candles.

    ``minutes_count`` counts (symbol, minute) pairs over the whole market.
    """
    limits = settings.limits
    minutes, busiest = F.col("minutes_count"), F.col("busiest_minutes")
    too_few = (minutes < limits.min_session_minutes) & (busiest < limits.min_symbol_minutes)
    few_reason = F.concat(
        F.lit("insufficient_minutes ("), minutes.cast("string"), F.lit(f" < {limits.min_session_minutes})")
    )
    days = (
        _symbol_days(checked, settings)
        .groupBy("trade_date")
        .agg(
            F.sum("valid_bars").alias("minutes_count"),
            F.max("valid_bars").alias("busiest_minutes"),
            F.count_if(F.col("valid_bars") > 0).alias("symbols_count"),
            (F.sum("bars") - F.sum("valid_bars")).alias("quarantined"),
            F.sum("spikes").alias("spikes_flagged"),
            F.sum("ohlc_valid").alias("ohlc_failures"),
            F.sum("price_valid").alias("price_failures"),
            F.sum("volume_valid").alias("volume_failures"),
            F.sum("minute_boundary").alias("boundary_failures"),
            _busiest("longest_gap").alias("gap"),
        )
        .withColumn("status", F.when((minutes == 0) | too_few, "MISSING").otherwise("COMPLETE"))
        .withColumn("reason", F.when(minutes == 0, "no_valid_candles").when(too_few, few_reason))
        .withColumn("gap_flag", F.col("gap") > limits.gap_seconds * MICROS)
    )
    return conform(days, DAY_STATS)


def gap_flags(checked: DataFrame, settings: Settings) -> DataFrame:
    """Busiest symbol of each day and whether its valid bars leave a long gap.

    ``Limits.gaps_count_breaks`` says whether a scheduled break is a part of
    one: with it, bars on both sides of the Friday break leave a gap.
    """
    return (
        _symbol_days(checked, settings)
        .filter(F.col("valid_bars") > 0)
        .groupBy("trade_date")
        .agg(_busiest("symbol").alias("top_symbol"), _busiest("longest_gap").alias("gap"))
        .select(
            "trade_date",
            "top_symbol",
            (F.col("gap") / MICROS).cast("bigint").alias("longest_gap_seconds"),
            (F.col("gap") > settings.limits.gap_seconds * MICROS).alias("gap_flag"),
        )
    )


def top_symbols(candles: DataFrame) -> DataFrame:
    """Symbol with most bars of each day; ties go to the first name."""
    return (
        candles.groupBy("trade_date", "symbol")
        .agg(F.count("*").alias("valid_bars"))
        .groupBy("trade_date")
        .agg(_busiest("symbol").alias("top_symbol"), F.max("valid_bars").alias("minutes_count"))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def constraint_violations(
    df: DataFrame,
    key: Sequence[str] = CANDLE_KEY,
    required: Sequence[str] = CANDLE_REQUIRED,
) -> DataFrame:
    """Breaches of the key and of the not-null rules, one row per kind and key."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in required]
    found = F.array(
        F.when(F.col("_n") > 1, F.struct(F.lit("duplicate_key").alias("violation"), F.col("_n").alias("n_rows"))),
        *(
            F.when(
                F.col(f"_null_{c}") > 0,
                F.struct(F.lit(f"null_{c}").alias("violation"), F.col(f"_null_{c}").alias("n_rows")),
            )
            for c in required
        ),
    )
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("_n"), *nulls)
        .select(*key, F.inline(F.array_compact(found)))
    )
