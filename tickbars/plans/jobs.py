"""The backfill and the processing of chosen days.

Each heavy result is written as a table and read back by the steps after it.
That cuts the lineage, computes it once and survives lost executors.
"""

from __future__ import annotations

from contextlib import nullcontext
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.fields import file_date
from tickbars.operators import bars, calendar, quality, replication, reports, status, ticks
from tickbars.schemas import CHECKED_CANDLES, COPY_CANDLES, DATES, DAY_SYMBOLS, MARKET, PROBLEMS, TICKS, TRADE_SLICES, conform
from tickbars.settings import Settings
from tickbars.sources import store as tables
from tickbars.sources.files import list_files, raw_files, read_rows
from tickbars.sources.store import Store

REPLICATION_MODES = ("merge", "audit")
WRITE_MODES = ("replace_day", "upsert")
COVERAGE_MODES = ("calendar", "observed")


def _one_of(value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"expected one of {allowed}, got {value!r}")
    return value


def run_timestamp(built_at: datetime | None = None) -> Column:
    """UTC wall clock of the run; pass one to make a run repeatable."""
    moment = built_at or datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def ingest(spark: SparkSession, path: str | list[str], store: Store, settings: Settings) -> DataFrame:
    """Raw files to the archive; unusable ones to the problems. Returns the days that lost ticks and wait to be worked out.

    Every file is read once: its rows are stored as they are, and ticks and
    problems come from what is stored.
    """
    return ingest_rows(store, read_rows(spark, path, settings), settings, list_files(spark, path, settings))


def ingest_rows(store: Store, rows: DataFrame, settings: Settings, files: DataFrame | None = None) -> DataFrame:
    """The same for rows of ``read_rows``; ``files`` are those that may have had no row."""
    with store.staged(rows, rows.schema) as stored:
        raw = raw_files(stored, settings)
        seen = raw.files if files is None else raw.files.unionByName(files)
        return archive(store, ticks.normalise_ticks(raw.ticks, settings), settings, seen, raw.problems)


def archive(
    store: Store, normalised: DataFrame, settings: Settings, files: DataFrame | None = None, problems: DataFrame | None = None
) -> DataFrame:
    """Ticks to the archive, in place of all that it had of their files, of ``files`` and of those with ``problems``.

    The days that gain or lose ticks are noted before anything changes, so a
    run that stops here is made good by the next one. Returns the days
    (trade_date) that lost ticks and were not worked out since.
    """
    store.archive(normalised, settings.file_layout != "one_per_day", files, problems)
    return emptied_dates(store)


def emptied_dates(store: Store) -> DataFrame:
    return store.read(tables.PENDING).where("emptied").select("trade_date")


def archived_dates(store: Store, settings: Settings) -> DataFrame:
    """Days in the archive that lie in the range of its file dates; the others are listed in STALE."""
    brought, limits = store.read(tables.INGESTED), settings.limits
    window = (limits.stale_days_before, limits.stale_days_after)
    dated = ticks.ticks_for_dates(brought)
    outside = ticks.outside_file_dates(dated, brought, *window).groupBy("trade_date").agg(F.sum("n_ticks").alias("n_rows"))
    inside = ticks.within_file_dates(dated, brought, *window).select("trade_date").distinct()
    with store.staged(outside.withColumn("problem", F.lit("outside the file dates")), PROBLEMS) as skipped:
        store.drop_partitions(tables.STALE, store.read(tables.STALE).join(skipped, "trade_date", "left_anti"))
        store.overwrite_partitions(tables.STALE, skipped)
    return inside


def process_days(
    store: Store,
    settings: Settings,
    dates: DataFrame,
    replication_mode: str = "merge",
    write_mode: str = "replace_day",
    built_at: datetime | None = None,
    csv: bool = True,
) -> None:
    """Recompute ``dates`` from the archive and write every table for them."""
    _one_of(replication_mode, REPLICATION_MODES)
    _one_of(write_mode, WRITE_MODES)
    # Files of one symbol each are no copies of a day, but those of a symbol can be copies of each other.
    by_symbol = settings.file_layout == "one_per_symbol"
    by = replication.BY_SYMBOL if by_symbol else replication.BY_DAY
    now = run_timestamp(built_at)
    with store.staged(dates.select("trade_date").distinct(), DATES) as days:
        feed = conform(store.read(tables.ARCHIVE, days), TICKS)
        undated = _undated_ticks(store)
        _write_rejects(store, feed, undated, days)
        contradicted = contradicted_symbols = None
        if replication_mode == "audit":
            # Copies are told apart by their paths.
            by_path = store.read(tables.ARCHIVE, days).withColumn("source_file", F.col("source_path"))
            feed = conform(by_path, TICKS)
            with store.staged(replication.copy_candles(feed), COPY_CANDLES) as copies:
                verdicts = replication.replication_audit(copies, by)
                store.replace_days(tables.DEDUP_LOG, verdicts if by_symbol else verdicts.withColumn("symbol", F.lit(MARKET)), days)
            verdicts = store.read(tables.DEDUP_LOG, days)
            if by_symbol:
                contradicted_symbols = replication.conflict_symbols(verdicts)
            else:
                contradicted = replication.conflict_dates(verdicts)
            feed = replication.collapse_copies(feed, verdicts, by)
        counted = feed.unionByName(_of_file_dates(undated, days))
        with store.staged(ticks.trade_slices(counted, settings), TRADE_SLICES) as slices:
            store.replace_days(tables.CLEAN_STATS, ticks.slice_stats(slices, settings), days)
            candles = quality.validate_candles(bars.candles_from_slices(slices, settings), settings)
            with store.staged(candles, CHECKED_CANDLES) as checked:
                stats = status.classify_days(days, quality.day_stats(checked, settings), contradicted)
                store.replace_days(tables.VALIDATION, stats, days)
                stats = store.read(tables.VALIDATION, days)
                store.replace_days(tables.QUARANTINE, quality.quarantined_candles(checked), days, stage=False)
                loadable = status.loadable_candles(quality.valid_candles(checked), stats)
                before = store.read(tables.CANDLES, days).select("symbol", "trade_date").distinct()
                with store.staged(before, DAY_SYMBOLS) if csv else nullcontext() as before:
                    _write_candles(store, write_mode, loadable, stats, days, now, contradicted_symbols)
                    if csv:
                        stored = store.read(tables.CANDLES, days).select("symbol", "trade_date").distinct()
                        store.drop_candle_csvs(before.join(stored, ["symbol", "trade_date"], "left_anti"))
                        store.write_candle_csvs(loadable)
        store.drop_partitions(tables.PENDING, store.read(tables.PENDING).join(days, "trade_date", "left_semi"))


def _write_candles(
    store: Store,
    write_mode: str,
    loadable: DataFrame,
    stats: DataFrame,
    days: DataFrame,
    now: Column,
    contradicted_symbols: DataFrame | None = None,
) -> None:
    own = status.symbol_day_status(loadable, now)
    if contradicted_symbols is not None:
        own = own.unionByName(status.conflict_symbol_status(contradicted_symbols, now))
    market = status.market_day_status(stats, now)
    if write_mode == "replace_day":
        store.replace_days(tables.CANDLES, loadable, days, stage=False)
        store.replace_days(tables.DAY_STATUS, own.unionByName(market), days)
        return
    store.upsert(tables.CANDLES, loadable, stage=False)
    store.upsert(tables.DAY_STATUS, own)
    changes = market.select("symbol", "trade_date", "status", "reason", "built_at")
    store.partial_upsert(
        tables.DAY_STATUS, changes, ["status", "reason", "built_at"], {"minutes_count": F.lit(0)}
    )


def _undated_ticks(store: Store) -> DataFrame:
    """Archived ticks without a time."""
    return conform(store.read(tables.ARCHIVE).filter(F.col("trade_date").isNull()), TICKS)


def _of_file_dates(undated: DataFrame, days: DataFrame) -> DataFrame:
    """Those whose file carries one of the dates; they count for it."""
    dated = undated.withColumn("_day", file_date(F.col("source_file")))
    wanted = F.broadcast(days.select(F.col("trade_date").alias("_day")))  # calendar-sized
    return dated.join(wanted, "_day", "left_semi").drop("_day")


def _write_rejects(store: Store, feed: DataFrame, undated: DataFrame, days: DataFrame) -> None:
    """Make the rejects of ``days`` what the archive has for them; ticks without any date have a partition of their own."""
    own = ticks.rejected_ticks(feed).withColumn("reject_date", F.col("trade_date"))
    day = file_date(F.col("source_file"))
    by_file = ticks.rejected_ticks(_of_file_dates(undated, days)).withColumn("reject_date", day)
    lone = ticks.rejected_ticks(undated.filter(day.isNull())).withColumn("reject_date", F.lit(None).cast("date"))
    store.replace_days(tables.REJECTS, own.unionByName(by_file).unionByName(lone), days)
    if lone.isEmpty():
        store.drop_partitions(tables.REJECTS, store.spark.createDataFrame([(None,)], "reject_date DATE"))


def coverage_report(
    store: Store, settings: Settings, mode: str = "calendar", closed: DataFrame | None = None
) -> DataFrame:
    """Coverage of the stored days: all expected ones, or only those with data."""
    stats = store.read(tables.VALIDATION)
    if _one_of(mode, COVERAGE_MODES) == "observed":
        return reports.coverage(stats, stats)
    closed = calendar.holidays(store.spark) if closed is None else closed
    return reports.coverage(calendar.trading_days(calendar.day_range(stats), closed, settings.session), stats)


def backfill(
    spark: SparkSession,
    path: str | list[str],
    store: Store,
    settings: Settings,
    replication_mode: str = "merge",
    write_mode: str = "replace_day",
    coverage_mode: str = "calendar",
    closed: DataFrame | None = None,
    built_at: datetime | None = None,
    csv: bool = True,
) -> DataFrame:
    """All raw files below ``path`` to candles, status and reports, all days in one go.

    Returns the one-row run summary.
    """
    emptied = ingest(spark, path, store, settings)  # also days that an earlier run lost and did not get to
    dates = archived_dates(store, settings).unionByName(emptied).distinct()
    process_days(store, settings, dates, replication_mode, write_mode, built_at, csv)
    store.write_coverage(coverage_report(store, settings, coverage_mode, closed))
    return reports.run_summary(store.read_coverage(), store.read(tables.CANDLES))
