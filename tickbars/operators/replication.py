"""Whole-day replication audit: are the copies of a day the same bars?

A copy is everything one source file holds for a day, or with ``BY_SYMBOL``
for a symbol on a day: of files with one symbol each, only those of the same
symbol can be copies. All copies are compared in one aggregate, so neither the
number of copies nor the size of one of them matters, and a minute that only
some copies have counts as a disagreement.

Only tables with one row per calendar date are broadcast: at most 3.7 million
short rows, for dates run from year 1 to 9999. Tables by symbol are joined as
Spark sees fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions.timestamps import floor_minutes
from tickbars.operators.bars import OHLCV, ohlcv_from_ticks
from tickbars.operators.ticks import TRADE, drop_invalid

IDENTICAL = "collapsed_identical"
CONFLICT = "CONFLICT"
#: What copies are copies of.
BY_DAY = ("trade_date",)
BY_SYMBOL = ("trade_date", "symbol")


def _small(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return F.broadcast(rows) if by == BY_DAY else rows  # calendar-sized


def duplicate_days(ticks: DataFrame) -> DataFrame:
    """Days that more than one source file holds ticks for."""
    return (
        ticks.filter(F.col("trade_date").isNotNull())
        .groupBy("trade_date")
        .agg(F.count_distinct("source_file").alias("n_copies"))
        .filter(F.col("n_copies") > 1)
    )


def copy_candles(ticks: DataFrame) -> DataFrame:
    """One-minute bars of every copy on its own, from its valid distinct ticks."""
    trades = drop_invalid(ticks).select(*TRADE, "source_file").distinct()
    minutes = trades.withColumn("ts", floor_minutes(F.col("ts_utc")))
    return ohlcv_from_ticks(minutes, "trade_date", "source_file", "symbol", "ts")


def _copies(candles: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Copies of each day, or symbol-day, that has several."""
    return (
        candles.select(*by, "source_file")
        .distinct()
        .groupBy(*by)
        .agg(F.count("*").alias("n_copies"), F.min("source_file").alias("kept_source"))
        .filter(F.col("n_copies") > 1)
    )


def _minutes(candles: DataFrame) -> DataFrame:
    """Each (day, symbol, minute) over the copies, with the spread of its values."""
    spread = F.lit(False)
    for name in OHLCV:
        spread = spread | (F.col(f"min_{name}") != F.col(f"max_{name}"))
    return (
        candles.groupBy("trade_date", "symbol", "ts")
        .agg(
            F.count("*").alias("copies_present"),
            *(F.min(c).alias(f"min_{c}") for c in OHLCV),
            *(F.max(c).alias(f"max_{c}") for c in OHLCV),
        )
        .withColumn("values_differ", spread)
    )


def _disagrees() -> Column:
    return (F.col("copies_present") < F.col("n_copies")) | F.col("values_differ")


def replication_diff(candles: DataFrame, by: tuple[str, ...] = BY_DAY) -> DataFrame:
    """Minutes the copies disagree on; input is ``copy_candles``."""
    copies = _small(_copies(candles, by).select(*by, "n_copies"), by)
    return (
        _minutes(candles)
        .join(copies, list(by))
        .filter(_disagrees())
        .select("trade_date", "symbol", "ts", "n_copies", "copies_present", "values_differ")
    )


def replication_audit(candles: DataFrame, by: tuple[str, ...] = BY_DAY) -> DataFrame:
    """Verdict for every day, or symbol-day, with several copies; input is ``copy_candles``.

    The copy to keep of identical ones is the first by file name.
    """
    copies = _small(_copies(candles, by), by)
    disagreeing = F.count_if(_disagrees())
    return (
        _minutes(candles)
        .join(copies, list(by))
        .groupBy(*by, "n_copies", "kept_source")
        .agg(disagreeing.alias("disagreeing"))
        .select(
            *by,
            "n_copies",
            F.when(F.col("disagreeing") == 0, IDENTICAL).otherwise(CONFLICT).alias("action"),
            F.when(F.col("disagreeing") == 0, "")
            .otherwise(F.concat(F.col("disagreeing").cast("string"), F.lit(" minute(s) disagree")))
            .alias("detail"),
            F.when(F.col("disagreeing") == 0, F.col("kept_source")).alias("kept_source"),
        )
    )


def conflict_dates(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.col("action") == CONFLICT).select("trade_date")


def conflict_symbols(verdicts: DataFrame) -> DataFrame:
    """(symbol, trade_date) whose copies contradict each other, of verdicts by symbol."""
    return verdicts.filter(F.col("action") == CONFLICT).select("symbol", "trade_date")


def drop_conflicts(ticks: DataFrame, verdicts: DataFrame, by: tuple[str, ...] = BY_DAY) -> DataFrame:
    """Ticks of the days, or symbol-days, whose copies do not contradict each other."""
    conflicts = _small(verdicts.filter(F.col("action") == CONFLICT).select(*by), by)
    return ticks.filter(F.col("trade_date").isNotNull()).join(conflicts, list(by), "left_anti")


def collapse_copies(ticks: DataFrame, verdicts: DataFrame, by: tuple[str, ...] = BY_DAY) -> DataFrame:
    """Drop what conflicts and keep one copy of what is identical.

    Ticks without a symbol belong to no copy by symbol and stay.
    """
    kept = _small(verdicts.select(*by, "action", "kept_source"), by)
    keep = F.col("action").isNull() | (
        (F.col("action") == IDENTICAL) & (F.col("source_file") == F.col("kept_source"))
    )
    return (
        ticks.filter(F.col("trade_date").isNotNull())
        .join(kept, list(by), "left")
        .filter(keep)
        .select(*ticks.columns)
    )
