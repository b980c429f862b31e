"""Raw ticks to clean ticks.

Skew: nothing here partitions by symbol or by day alone. Duplicates are
removed by an aggregate over the whole tick, which combines on the map side;
spike detection works on short time slices of a symbol-day and carries the
last price over from slice to slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from tickbars.functions.fields import (
    coercion_failed,
    file_date,
    lenient_bigint,
    lenient_double,
    lenient_double_text,
    tick_defect,
)
from tickbars.functions.sessions import in_session
from tickbars.functions.timestamps import parse_timestamp, second_of_day, to_local
from tickbars.schemas import ARCHIVED, TICKS, conform
from tickbars.settings import Settings

TRADE = ("symbol", "trade_date", "ts_utc", "price", "volume")
SYMBOL_DAY = ("symbol", "trade_date")


def coerce_ticks(raw: DataFrame) -> DataFrame:
    """Price to double and volume to bigint; what does not fit becomes null."""
    is_text = dict(raw.dtypes)["price"] == "string"
    price = (lenient_double_text if is_text else lenient_double)(F.col("price"))
    return raw.withColumns({"price": price, "volume": lenient_bigint(F.col("volume"))})


def with_local_time(ticks: DataFrame, settings: Settings) -> DataFrame:
    """Exchange wall clock and its date, derived from ``ts_utc``."""
    local = ticks.withColumn("ts_local", to_local(F.col("ts_utc"), settings.timezone))
    return local.withColumn("trade_date", F.to_date("ts_local"))


def normalise_ticks(raw: DataFrame, settings: Settings) -> DataFrame:
    """Raw text ticks of any number of files to typed ticks.

    Rows that fail a cast stay, with nulls, so that they can be counted. The
    path of the file is kept if the rows have it.
    """
    typed = coerce_ticks(raw).withColumn(
        "ts_utc", parse_timestamp(F.col("ts_raw"), settings.timestamp_format, settings.timezone)
    )
    known = T.StructType([f for f in ARCHIVED.fields if f.name in TICKS.fieldNames() or f.name in raw.columns])
    return conform(with_local_time(typed, settings), known)


def merge_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All ticks of several normalised sources, none removed."""
    merged, *others = (conform(f, TICKS) for f in frames)
    for other in others:
        merged = merged.unionByName(other)
    return merged


def ticks_for_dates(ticks: DataFrame, dates: Sequence[date] | None = None) -> DataFrame:
    """Ticks that belong to a day, optionally to the given days only.

    On the archive the filter prunes partitions.
    """
    dated = ticks.filter(F.col("trade_date").isNotNull())
    return dated.filter(F.col("trade_date").isin(*dates)) if dates else dated


def file_date_range(files: DataFrame) -> DataFrame:
    """One row with the earliest and the latest date found in ``source_file``."""
    names = files.select("source_file").distinct()
    return names.select(file_date(F.col("source_file")).alias("d")).agg(
        F.min("d").alias("first_date"), F.max("d").alias("last_date")
    )


def _within(files: DataFrame, before: int | None, after: int | None) -> Column:
    bounds = file_date_range(files)
    day, inside = F.col("trade_date"), F.lit(True)
    if before is not None:
        inside &= day >= F.coalesce(bounds.select(F.date_sub("first_date", before)).scalar(), day)
    if after is not None:
        inside &= day <= F.coalesce(bounds.select(F.date_add("last_date", after)).scalar(), day)
    return inside


def within_file_dates(ticks: DataFrame, files: DataFrame, before: int | None = 7, after: int | None = 1) -> DataFrame:
    """Drop stale days: keep [first file date - ``before``, last file date + ``after``].

    Files without a date in their name set no bound; with none at all, or with
    None for a side, everything stays.
    """
    return ticks.filter(_within(files, before, after))


def outside_file_dates(ticks: DataFrame, files: DataFrame, before: int | None = 7, after: int | None = 1) -> DataFrame:
    """The stale days that ``within_file_dates`` drops."""
    return ticks.filter(~_within(files, before, after))


def _defect() -> Column:
    return tick_defect(F.col("symbol"), F.col("ts_utc"), F.col("price"), F.col("volume"))


def drop_invalid(ticks: DataFrame) -> DataFrame:
    """Keep ticks with all fields, a positive price and a volume of at least 0."""
    return ticks.filter(
        F.col("symbol").isNotNull()
        & F.col("ts_utc").isNotNull()
        & (F.col("price") > 0)
        & ~F.isnan("price")
        & (F.col("volume") >= 0)
    )


def rejected_ticks(ticks: DataFrame) -> DataFrame:
    """The ticks ``drop_invalid`` removes, each with its ``defect``."""
    return ticks.withColumn("defect", _defect()).filter(F.col("defect").isNotNull())


def dedup_ticks(ticks: DataFrame) -> DataFrame:
    """One row per distinct trade. Equal trades merge before the shuffle."""
    return ticks.select(*TRADE).distinct()


def session_filter(ticks: DataFrame, settings: Settings) -> DataFrame:
    return ticks.filter(in_session(F.col("ts_local"), F.col("trade_date"), settings.session))


def session_trades(ticks: DataFrame, settings: Settings) -> DataFrame:
    """Valid, in-session, distinct trades.

    Validity and session depend on the trade alone, so both filters run
    before the shuffle and give the same rows as running after it.
    """
    return dedup_ticks(session_filter(drop_invalid(ticks), settings))


def _moved(now: Column, before: Column, pct: float) -> Column:
    return F.coalesce(F.abs(now - before) / before > pct, F.lit(False))


def _slice(ts: Column, settings: Settings) -> Column:
    """Number of the time slice since 1970; it fixes the trade date as well."""
    day = F.date_diff(F.to_date(ts), F.lit(date(1970, 1, 1))).cast("bigint")
    per_day = 86_400 // settings.limits.slice_seconds
    return day * per_day + F.floor(second_of_day(ts) / settings.limits.slice_seconds)


def _with_neighbours(trades: DataFrame, *slice_key: str) -> DataFrame:
    """Prices before and after each trade within its slice, null at its ends."""
    within = W.partitionBy(*slice_key).orderBy("ts_utc", "price", "volume")
    return trades.withColumns({"before": F.lag("price").over(within), "after": F.lead("price").over(within)})


def flag_spikes(trades: DataFrame, settings: Settings) -> DataFrame:
    """Mark trades that move more than ``spike_pct`` from the one before.

    The previous trade is the one before it in the same symbol and day, by
    (ts, price, volume). A task sorts one time slice at a time; the first
    trade of a slice is compared with the last price of the slice before,
    found on a table of one row per slice (86,400 a symbol-day at most).

    Both branches read ``trades``: give it a stored table, or a plan whose
    shuffle Spark can reuse.
    """
    slice_key = ["symbol", "slice"]
    sliced = trades.select(*TRADE, _slice(F.col("ts_utc"), settings).alias("slice"))
    # The join below would filter one branch only, and the shuffles would differ.
    sliced = sliced.filter(F.col("symbol").isNotNull() & F.col("slice").isNotNull())
    within = _with_neighbours(sliced, *slice_key)
    across = W.partitionBy(*SYMBOL_DAY).orderBy("slice")
    carried = within.filter(F.col("after").isNull()).select(
        *slice_key, F.lag("price").over(across).alias("carried")
    )
    before = F.coalesce(F.col("before"), F.col("carried"))
    return within.join(carried, slice_key).select(
        *TRADE, _moved(F.col("price"), before, settings.limits.spike_pct).alias("spike_flag")
    )


def clean_ticks(
    ticks: DataFrame, settings: Settings, keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Typed ticks of all days to clean ticks with a ``spike_flag``.

    ``keep`` stores the distinct trades and gives them back, so that spike
    detection, which reads them twice, does not work them out twice.
    """
    trades = session_trades(ticks, settings)
    flagged = flag_spikes(keep(trades) if keep else trades, settings)
    return flagged.withColumn("ts_local", to_local(F.col("ts_utc"), settings.timezone))


# What became of a tick, as ``trade_slices`` marks it.
KEPT, OFF_SESSION, UNUSABLE, UNREADABLE = range(4)


def _fate(settings: Settings) -> Column:
    symbol, price, volume = F.col("symbol"), F.col("price"), F.col("volume")
    return (
        F.when(coercion_failed(price, volume, F.col("ts_utc")), UNREADABLE)
        .when(symbol.isNull() | (price <= 0) | (volume < 0), UNUSABLE)
        .when(in_session(F.col("ts_local"), F.col("trade_date"), settings.session), KEPT)
        .otherwise(OFF_SESSION)
    )


def trade_slices(ticks: DataFrame, settings: Settings) -> DataFrame:
    """Time slices of the ticks with their counters and prices, from one pass.

    Both the cleaning counters and the bars can be had from this table, so a
    run shuffles the ticks themselves only once. Rows are marked instead of
    dropped. Equal trades are counted before the shuffle, and unusable rows
    carry no key, so each day has only a few groups of them. A row without a
    timestamp counts for the date of its file.
    """
    usable = F.col("fate") <= OFF_SESSION
    trade = ("symbol", "ts_utc", "price", "volume")
    counted = (
        ticks.withColumn("fate", _fate(settings))
        .select(
            "fate",
            F.coalesce(F.col("trade_date"), file_date(F.col("source_file"))).alias("day"),
            *(F.when(usable, F.col(c)).alias(c) for c in trade),
        )
        .groupBy("fate", "day", *trade)
        .agg(F.count("*").alias("n"))
        # Unusable rows form one slice per day and kind.
        .withColumn("slice", F.coalesce(_slice(F.col("ts_utc"), settings), -F.unix_date("day").cast("bigint")))
    )
    price, before, after = F.col("price"), F.col("before"), F.col("after")
    return (
        _with_neighbours(counted, "fate", "symbol", "slice")
        .groupBy("fate", "symbol", "slice")
        .agg(
            F.min("day").alias("trade_date"),
            F.min("ts_utc").alias("first_ts"),
            F.sum("n").alias("n_ticks"),
            F.count("*").alias("n_trades"),
            F.count_if(_moved(price, before, settings.limits.spike_pct)).alias("n_spikes"),
            F.max(F.when(before.isNull(), price)).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max(F.when(after.isNull(), price)).alias("close"),
            F.sum("volume").alias("volume"),
        )
    )


def slice_stats(slices: DataFrame, settings: Settings) -> DataFrame:
    """Cleaning counters of every day, from ``trade_slices``."""
    across = W.partitionBy("fate", "symbol", "trade_date").orderBy("slice")
    edge = _moved(F.col("open"), F.lag("close").over(across), settings.limits.spike_pct).cast("int")
    fate, n, trades = F.col("fate"), F.col("n_ticks"), F.col("n_trades")

    def total(value: Column, condition: Column | None = None) -> Column:
        chosen = value if condition is None else F.when(condition, value)
        return F.coalesce(F.sum(chosen), F.lit(0)).cast("bigint")

    return (
        slices.withColumn("n_spikes", F.col("n_spikes") + edge)
        .groupBy("trade_date")
        .agg(
            total(n).alias("input_rows"),
            total(n, fate == UNREADABLE).alias("coercion_failures"),
            total(n, fate >= UNUSABLE).alias("invalid_dropped"),
            total(n - trades, fate <= OFF_SESSION).alias("duplicates_dropped"),
            total(trades, fate == OFF_SESSION).alias("out_of_session_dropped"),
            total(F.col("n_spikes"), fate == KEPT).alias("spikes_flagged"),
            total(trades, fate == KEPT).alias("output_rows"),
        )
    )


def clean_stats(ticks: DataFrame, settings: Settings) -> DataFrame:
    """Cleaning counters of every day in one pass over the ticks."""
    return slice_stats(trade_slices(ticks, settings), settings)
