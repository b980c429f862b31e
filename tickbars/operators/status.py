"""Day status rows and the gates that use them.

Only tables with one row per calendar date are broadcast. Dates run from year
1 to 9999, so such a table has at most 3.7 million short rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import DAY_STATS, DAY_STATUS, MARKET, conform

COMPLETE = "COMPLETE"
MISSING = "MISSING"
CONFLICT = "CONFLICT"


def classify_days(days: DataFrame, stats: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """Statistics for every day that has ticks.

    A day whose ticks gave no candle is MISSING/corrupt; a day whose copies
    contradict each other is CONFLICT/conflict. All inputs hold one row per
    date.
    """
    found = days.select("trade_date").distinct().join(stats, "trade_date", "left")
    status = F.coalesce(F.col("status"), F.lit(MISSING))
    reason = F.when(F.col("status").isNull(), "corrupt").otherwise(F.col("reason"))
    if conflicts is not None:
        marked = conflicts.select("trade_date").distinct().withColumn("_conflict", F.lit(True))
        found = found.join(marked, "trade_date", "left")
        contradicted = F.col("_conflict").isNotNull()
        status = F.when(contradicted, CONFLICT).otherwise(status)
        reason = F.when(contradicted, "conflict").otherwise(reason)
    counters = [f.name for f in DAY_STATS.fields if f.dataType.typeName() == "long"]
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in counters}
    filled["gap_flag"] = F.coalesce(F.col("gap_flag"), F.lit(False))
    # Reason first: it looks at the status before it is filled in.
    return conform(found.withColumn("reason", reason).withColumn("status", status).withColumns(filled), DAY_STATS)


def complete_days(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("status") == COMPLETE).select("trade_date")


def loadable_candles(candles: DataFrame, stats: DataFrame) -> DataFrame:
    """Candles of COMPLETE days."""
    return candles.join(F.broadcast(complete_days(stats)), "trade_date", "left_semi")  # calendar-sized


def symbol_day_status(candles: DataFrame, built_at: Column) -> DataFrame:
    """A COMPLETE row for every symbol and day of the loaded candles."""
    rows = candles.groupBy("symbol", "trade_date").agg(
        F.lit(COMPLETE).alias("status"),
        F.count("*").alias("minutes_count"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    return conform(rows.withColumn("built_at", built_at), DAY_STATUS)


def conflict_symbol_status(symbol_days: DataFrame, built_at: Column) -> DataFrame:
    """A CONFLICT row for every symbol and day whose copies contradict each other."""
    rows = symbol_days.select("symbol", "trade_date").distinct().withColumns(
        {"status": F.lit(CONFLICT), "reason": F.lit("conflict"), "minutes_count": F.lit(0), "built_at": built_at}
    )
    return conform(rows, DAY_STATUS)


def market_day_status(stats: DataFrame, built_at: Column) -> DataFrame:
    """A market-wide row for every day that is not COMPLETE."""
    rows = stats.filter(F.col("status") != COMPLETE).select(
        F.lit(MARKET).alias("symbol"),
        "trade_date",
        "status",
        "reason",
        F.lit(0).alias("minutes_count"),
        built_at.alias("built_at"),
    )
    return conform(rows, DAY_STATUS)


def absent_day_status(expected: DataFrame, landed: DataFrame, archived: DataFrame, built_at: Column) -> DataFrame:
    """Market-wide rows for expected days without ticks.

    ``scrape_failed``: no file came for the day. ``ingest_failed``: a file
    came and gave no ticks.
    """
    came = landed.select("trade_date").distinct().withColumn("_came", F.lit(True))
    rows = (
        expected.select("trade_date")
        .distinct()
        .join(archived.select("trade_date").distinct(), "trade_date", "left_anti")
        .join(came, "trade_date", "left")
        .select(
            F.lit(MARKET).alias("symbol"),
            "trade_date",
            F.lit(MISSING).alias("status"),
            F.when(F.col("_came"), "ingest_failed").otherwise("scrape_failed").alias("reason"),
            F.lit(0).alias("minutes_count"),
            built_at.alias("built_at"),
        )
    )
    return conform(rows, DAY_STATUS)


def effective_status(symbol_days: DataFrame, status: DataFrame) -> DataFrame:
    """Status of each (symbol, trade_date): its own row, else the market's."""
    own = status.filter(F.col("symbol") != MARKET).select("symbol", "trade_date", F.col("status").alias("_own"))
    market = status.filter(F.col("symbol") == MARKET).select("trade_date", F.col("status").alias("_market"))
    return (
        symbol_days.join(own, ["symbol", "trade_date"], "left")
        .join(F.broadcast(market), "trade_date", "left")  # calendar-sized
        .withColumn("status", F.coalesce("_own", "_market"))
        .drop("_own", "_market")
    )


def day_status_summary(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count_distinct("trade_date").alias("n_dates"))
