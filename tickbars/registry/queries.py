"""Every registered query: ``name -> callable(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars import schemas
from tickbars.functions.fields import file_date
from tickbars.functions.timestamps import EPOCH, parse_timestamp, to_local
from tickbars.operators import bars, calendar, minutes, quality, replication, reports, shaping, status, ticks
from tickbars.plans.jobs import archive, archived_dates, backfill, process_days
from tickbars.registry import feed
from tickbars.registry.feed import OVERRIDES, SETTINGS
from tickbars.settings import SourceColumns
from tickbars.sources import store as tables
from tickbars.sources.files import map_columns, read_csv_ticks, read_sqlite_ticks
from tickbars.sources.paths import saved, scratch_dir
from tickbars.sources.store import Store
from tickbars.streaming.incremental import incremental_update

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_RUN = datetime(2024, 2, 1)
SECOND_RUN = datetime(2024, 2, 2)
TARGET_DATES = (date(2024, 1, 5), date(2024, 1, 14), date(2024, 1, 23))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def _stamp(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _store(spark: SparkSession, label: str) -> Store:
    return Store(spark, scratch_dir(spark, label))


class Day:
    """Frames that the status, report and shaping queries of one call share.

    What several branches read is stored once and read back.
    """

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf

    @cached_property
    def checked(self) -> DataFrame:
        return saved(quality.validate_candles(feed.candle_feed(self.spark, self.sf), SETTINGS), "checked")

    @property
    def bar_stats(self) -> DataFrame:
        """Statistics of the days with candles; enough to know the COMPLETE ones."""
        return quality.day_stats(self.checked, SETTINGS)

    @cached_property
    def stats(self) -> DataFrame:
        """Statistics of every day with ticks, also of days that gave no candle."""
        fed = ticks.ticks_for_dates(feed.tick_feed(self.spark, self.sf))
        return saved(status.classify_days(fed, self.bar_stats), "stats")

    @property
    def loaded(self) -> DataFrame:
        return status.loadable_candles(quality.valid_candles(self.checked), self.bar_stats)

    @property
    def status(self) -> DataFrame:
        own = status.symbol_day_status(self.loaded, _stamp(FIRST_RUN))
        return own.unionByName(status.market_day_status(self.stats, _stamp(FIRST_RUN)))

    @property
    def expected(self) -> DataFrame:
        """Expected days over the range the events span."""
        dated = ticks.with_local_time(feed.events(self.spark, self.sf).select(F.col("ts").alias("ts_utc")), SETTINGS)
        return calendar.trading_days(
            calendar.day_range(dated), calendar.holidays(self.spark, feed.CLOSED), SETTINGS.session
        )

    @property
    def coverage(self) -> DataFrame:
        return reports.coverage(self.expected, self.stats)


# Timestamps -----------------------------------------------------------------


def _parsed(spark: SparkSession, sf: str, text: Column, fmt: str) -> DataFrame:
    """Events with their time as text, a part of it unusable, parsed again."""
    n = F.col("event_id")
    dirty = F.when(n % 13 == 0, None).when(n % 17 == 0, "").when(n % 19 == 0, "bad").otherwise(text)
    parsed = feed.events(spark, sf).select("event_id", parse_timestamp(dirty, fmt, SETTINGS.timezone).alias("ts_utc"))
    return ticks.with_local_time(parsed, SETTINGS)


def _since_epoch(unit: str) -> Column:
    return F.timestamp_diff(unit, F.expr(EPOCH), F.col("ts")).cast("string")


def _seconds_text(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


@query
def ts_epoch_s(spark, sf):
    return _parsed(spark, sf, _since_epoch("SECOND"), "epoch_s")


@query
def ts_epoch_ms(spark, sf):
    return _parsed(spark, sf, _since_epoch("MILLISECOND"), "epoch_ms")


@query
def ts_naive_utc(spark, sf):
    # A bare date every 11th row: not the expected format, so null.
    text = F.when(F.col("event_id") % 11 == 0, F.substring(F.col("ts").cast("string"), 1, 10)).otherwise(
        _seconds_text(F.col("ts"))
    )
    return _parsed(spark, sf, text, "naive_utc")


@query
def ts_naive_local(spark, sf):
    return _parsed(spark, sf, _seconds_text(to_local(F.col("ts"), SETTINGS.timezone)), "naive_local")


def _iso_variants() -> Column:
    local = F.replace(to_local(F.col("ts"), SETTINGS.timezone).cast("string"), F.lit(" "), F.lit("T"))
    bare = F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T"))
    kind = F.col("event_id") % 3
    return (
        F.when(kind == 0, F.concat(local, F.lit("+05:00")))
        .when(kind == 1, F.concat(bare, F.lit("Z")))
        .otherwise(bare)
    )


@query
def ts_iso(spark, sf):
    return _parsed(spark, sf, _iso_variants(), "iso")


@query
def ts_auto(spark, sf):
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, _since_epoch("SECOND"))
        .when(kind == 1, _since_epoch("MILLISECOND"))
        .when(kind == 2, _seconds_text(F.col("ts")))
        .otherwise(_iso_variants())
    )
    return _parsed(spark, sf, text, "auto")


@query
def tz_selftest(spark, sf):
    """Offset between the UTC and the local clock of every event, per local day."""
    dated = ticks.with_local_time(feed.events(spark, sf).select(F.col("ts").alias("ts_utc")), SETTINGS)
    offset = F.timestamp_diff("SECOND", F.col("ts_utc"), F.col("ts_local"))
    return dated.groupBy("trade_date").agg(
        F.count("*").alias("n_ticks"),
        F.min(offset).alias("min_offset"),
        F.max(offset).alias("max_offset"),
        F.bool_and(offset == 5 * 3600).alias("passed"),
    )


# Sources --------------------------------------------------------------------


@query
def file_date_(spark, sf):
    """Dates in file names built from every event's day."""
    day = F.replace(F.substring(F.col("ts").cast("string"), 1, 10), F.lit("-"), F.lit(""))
    kind = F.col("event_id") % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("/landing/ticks_"), day, F.lit(".db")))
        .when(kind == 1, F.concat(F.lit("1m_"), day, F.lit(".csv")))
        .when(kind == 2, F.concat(F.lit("ticks_"), day, F.lit("_v2.db")))
        .otherwise(F.lit("ticks.csv"))
    )
    return feed.events(spark, sf).select("event_id", name.alias("source_file")).withColumn(
        "file_date", file_date(F.col("source_file"))
    )


def _scanned(raw: DataFrame) -> DataFrame:
    return ticks.normalise_ticks(raw, SETTINGS).drop("source_file", "source_path")


@query
def scan_csv_ticks(spark, sf):
    landing = scratch_dir(spark, "csv")
    feed.write_csv_landing(feed.raw_feed(spark, sf), landing)
    return _scanned(read_csv_ticks(spark, landing, SETTINGS))


@query
def scan_sqlite_ticks(spark, sf):
    landing = scratch_dir(spark, "sqlite")
    feed.write_sqlite_landing(feed.raw_feed(spark, sf), landing)
    return _scanned(read_sqlite_ticks(spark, landing, replace(SETTINGS, source_format="sqlite")))


@query
def normalise_ticks(spark, sf):
    return ticks.normalise_ticks(feed.raw_feed(spark, sf), SETTINGS)


@query
def coerce_ticks(spark, sf):
    """Numeric text, of which some has a unit, a fraction or blanks."""
    n = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    price = F.col("value").cast("string")
    raw = feed.events(spark, sf).select(
        "event_id",
        F.when(n % 7 == 0, F.concat(price, F.lit(" Rs")))
        .when(n % 11 == 0, "NaN")
        .when(n % 13 == 0, F.concat(F.lit(" "), price, F.lit(" ")))
        .otherwise(price)
        .alias("price"),
        F.when(n % 5 == 0, F.concat(k, F.lit(".5"))).when(n % 17 == 0, "many").otherwise(k).alias("volume"),
    )
    return ticks.coerce_ticks(raw)


@query
def merge_sources(spark, sf):
    """A file with canonical columns and one with its own names and zone, as one."""
    raw = feed.raw_feed(spark, sf)
    own = replace(SETTINGS, columns=SourceColumns("ticker", "px", "qty", "stamp"))
    local = F.concat(
        F.replace(F.col("ts_local").cast("string"), F.lit(" "), F.lit("T")), F.lit("+05:00")
    )
    other = (
        feed.tick_feed(spark, sf)
        .filter(F.col("source_file") == "B")
        .select(
            F.col("symbol").alias("ticker"),
            local.alias("stamp"),
            F.col("price").alias("px"),
            F.col("volume").alias("qty"),
            "source_file",
        )
    )
    return ticks.merge_sources(
        [
            ticks.normalise_ticks(raw.filter(F.col("source_file") == "A"), SETTINGS),
            ticks.normalise_ticks(map_columns(other, own), own),
        ]
    )


@query
def ticks_for_dates(spark, sf):
    return ticks.ticks_for_dates(feed.tick_feed(spark, sf), TARGET_DATES)


@query
def date_window(spark, sf):
    named = F.when(F.col("source_file") == "A", "ticks_20240110.csv").otherwise("ticks_20240118.csv")
    dated = feed.tick_feed(spark, sf).withColumn("source_file", named)
    return ticks.within_file_dates(dated, dated)


@query
def stale_days(spark, sf):
    """The days that ``date_window`` drops, with their rows."""
    named = F.when(F.col("source_file") == "A", "ticks_20240110.csv").otherwise("ticks_20240118.csv")
    dated = feed.tick_feed(spark, sf).withColumn("source_file", named)
    outside = ticks.outside_file_dates(ticks.ticks_for_dates(dated), dated)
    return outside.groupBy("trade_date").agg(F.count("*").alias("n_rows"))


@query
def archive_replace(spark, sf):
    """File A lands, and lands again with fewer days; file B stays as it is."""
    store, ticks_ = _store(spark, "replace"), feed.tick_feed(spark, sf)
    archive(store, ticks_, SETTINGS)
    archive(store, ticks_.filter("source_file = 'A' AND day(trade_date) <= 15"), SETTINGS)
    return store.read(tables.ARCHIVE).select(*schemas.TICKS.fieldNames())


@query
def archive_same_name(spark, sf):
    """Files of one name in two folders are two files; that in folder A lands again with fewer days."""
    store = _store(spark, "same-name")
    named = feed.tick_feed(spark, sf).withColumn("source_path", F.concat(F.lit("/landing/"), "source_file", F.lit("/ticks.csv")))
    named = named.withColumn("source_file", F.lit("ticks.csv"))
    archive(store, named, SETTINGS)
    archive(store, named.filter("source_path LIKE '%/A/%' AND day(trade_date) <= 15"), SETTINGS)
    return store.read(tables.ARCHIVE).drop("bucket")


@query
def replay_after_stop(spark, sf):
    """Candles after file A landed again with fewer days, the run stopped behind the archive, and was repeated."""
    store, ticks_ = _store(spark, "replay"), feed.tick_feed(spark, sf)
    fewer = ticks_.filter("source_file = 'A' AND day(trade_date) <= 15")

    def work_out(emptied):
        dates = archived_dates(store, SETTINGS).unionByName(emptied).distinct()
        process_days(store, SETTINGS, dates, built_at=FIRST_RUN, csv=False)

    work_out(archive(store, ticks_, SETTINGS))
    archive(store, fewer, SETTINGS)  # and nothing after it
    work_out(archive(store, fewer, SETTINGS))
    return store.read(tables.CANDLES)


@query
def archive_roundtrip(spark, sf):
    store = _store(spark, "archive")
    store.archive(feed.tick_feed(spark, sf))
    return store.read(tables.ARCHIVE).select(*schemas.TICKS.fieldNames())


# Cleaning -------------------------------------------------------------------


@query
def drop_invalid(spark, sf):
    return ticks.drop_invalid(feed.tick_feed(spark, sf))


@query
def rejected_ticks(spark, sf):
    return ticks.rejected_ticks(feed.tick_feed(spark, sf))


@query
def dedup_ticks(spark, sf):
    return ticks.dedup_ticks(ticks.drop_invalid(feed.tick_feed(spark, sf)))


@query
def session_filter(spark, sf):
    return ticks.session_filter(ticks.drop_invalid(feed.tick_feed(spark, sf)), OVERRIDES)


@query
def session_windows(spark, sf):
    dates = feed.tick_feed(spark, sf).filter(F.col("trade_date").isNotNull()).select("trade_date").distinct()
    return calendar.session_table(dates, OVERRIDES.session)


@query
def tick_spikes(spark, sf):
    trades = saved(ticks.session_trades(feed.tick_feed(spark, sf), SETTINGS), "trades")
    return ticks.flag_spikes(trades, SETTINGS)


@query
def clean_ticks(spark, sf):
    return ticks.clean_ticks(feed.tick_feed(spark, sf), OVERRIDES, keep=lambda df: saved(df, "trades"))


@query
def clean_stats(spark, sf):
    return ticks.clean_stats(feed.tick_feed(spark, sf), SETTINGS)


# Bars -----------------------------------------------------------------------


@query
def candles_1m(spark, sf):
    return feed.candle_feed(spark, sf)


@query
def bars_5m(spark, sf):
    return bars.rollup(feed.candle_feed(spark, sf), 5, SETTINGS)


@query
def bars_15m(spark, sf):
    return bars.rollup(feed.candle_feed(spark, sf), 15, SETTINGS)


@query
def bars_5m_dst(spark, sf):
    """Bars around the night the clocks of New York go back; the local hour from one comes twice."""
    own = replace(SETTINGS, timezone="America/New_York")
    moved = feed.events(spark, sf).select(
        F.col("event_type").alias("symbol"),
        (F.col("ts") + F.expr("INTERVAL 300 DAYS")).alias("ts_utc"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )
    return bars.rollup(bars.candles_1m(ticks.with_local_time(moved, own), own), 5, own)


@query
def daily_bars(spark, sf):
    day = Day(spark, sf)
    return shaping.gated_daily_bars(quality.valid_candles(day.checked), day.status)


@query
def flat_fill(spark, sf):
    return shaping.flat_fill(Day(spark, sf).loaded, SETTINGS)


@query
def carry_close(spark, sf):
    day = Day(spark, sf)
    stats = saved(day.bar_stats, "bar-stats")  # read by two branches
    loaded = status.loadable_candles(quality.valid_candles(day.checked), stats)
    return shaping.carry_close(bars.daily_bars(loaded), day.expected, stats)


# Validation -----------------------------------------------------------------


@query
def validate_candles(spark, sf):
    return quality.validate_candles(feed.imported_bars(spark, sf), SETTINGS)


@query
def candle_spikes(spark, sf):
    return quality.flag_candle_spikes(feed.candle_feed(spark, sf), SETTINGS)


@query
def quarantine(spark, sf):
    return quality.quarantined_candles(quality.validate_candles(feed.imported_bars(spark, sf), SETTINGS))


@query
def day_stats(spark, sf):
    return quality.day_stats(quality.validate_candles(feed.imported_bars(spark, sf), SETTINGS), SETTINGS)


@query
def gap_flag(spark, sf):
    return quality.gap_flags(quality.validate_candles(feed.imported_bars(spark, sf), SETTINGS), SETTINGS)


@query
def gap_flag_sessions(spark, sf):
    """The same without the scheduled breaks: the Friday break is no gap."""
    own = replace(SETTINGS, limits=replace(SETTINGS.limits, gaps_count_breaks=False))
    return quality.gap_flags(quality.validate_candles(feed.imported_bars(spark, sf), own), own)


@query
def day_minutes(spark, sf):
    """Distinct minutes by symbol and over the market; bitmaps of two halves of the bars are merged."""
    own = replace(SETTINGS, limits=replace(SETTINGS.limits, min_day_minutes=40, max_session_minutes=60))
    bars_ = saved(feed.candle_feed(spark, sf), "bars")
    halves = [minutes.minute_bitmaps(bars_.filter(F.minute("ts") % 2 == k)) for k in (0, 1)]
    return minutes.day_minutes(halves[0].unionByName(halves[1]), own)


@query
def top_symbol(spark, sf):
    return quality.top_symbols(feed.candle_feed(spark, sf))


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(feed.repeated_bars(spark, sf))


@query
def constraint_violations(spark, sf):
    return quality.constraint_violations(feed.repeated_bars(spark, sf))


@query
def validation_report(spark, sf):
    """Day statistics written as a report and read back."""
    store = _store(spark, "report")
    stats = Day(spark, sf).stats
    store.replace_days(tables.VALIDATION, reports.validation_report(stats), stats)
    return store.read(tables.VALIDATION)


# Copies of a day ------------------------------------------------------------


def _copies(spark: SparkSession, sf: str) -> DataFrame:
    return saved(replication.copy_candles(feed.tick_feed(spark, sf)), "copies")


@query
def duplicate_days(spark, sf):
    return replication.duplicate_days(feed.tick_feed(spark, sf))


@query
def replication_diff(spark, sf):
    return replication.replication_diff(_copies(spark, sf))


@query
def replication_audit(spark, sf):
    return replication.replication_audit(_copies(spark, sf))


@query
def replication_audit_symbols(spark, sf):
    """Verdicts by symbol and day, as for files of one symbol each."""
    return replication.replication_audit(_copies(spark, sf), replication.BY_SYMBOL)


@query
def collapse_copies_symbols(spark, sf):
    verdicts = replication.replication_audit(_copies(spark, sf), replication.BY_SYMBOL)
    return replication.collapse_copies(feed.tick_feed(spark, sf), verdicts, replication.BY_SYMBOL)


@query
def drop_conflicts(spark, sf):
    verdicts = replication.replication_audit(_copies(spark, sf))
    return replication.drop_conflicts(feed.tick_feed(spark, sf), verdicts).select(*schemas.TICKS.fieldNames())


@query
def collapse_copies(spark, sf):
    verdicts = replication.replication_audit(_copies(spark, sf))
    return replication.collapse_copies(feed.tick_feed(spark, sf), verdicts)


# Status and reports ---------------------------------------------------------


@query
def loadable_candles(spark, sf):
    return Day(spark, sf).loaded


@query
def symbol_day_status(spark, sf):
    return status.symbol_day_status(Day(spark, sf).loaded, _stamp(FIRST_RUN))


@query
def classified_days(spark, sf):
    """Statistics of all days, those with contradicting copies marked."""
    conflicts = replication.conflict_dates(replication.replication_audit(_copies(spark, sf)))
    day = Day(spark, sf)
    fed = ticks.ticks_for_dates(feed.tick_feed(spark, sf))
    return status.classify_days(fed, day.bar_stats, conflicts)


@query
def expected_days(spark, sf):
    return Day(spark, sf).expected


@query
def coverage(spark, sf):
    return Day(spark, sf).coverage


@query
def coverage_summary(spark, sf):
    return reports.coverage_summary(Day(spark, sf).coverage)


@query
def run_summary(spark, sf):
    day = Day(spark, sf)
    return reports.run_summary(day.coverage, day.loaded)


@query
def candle_count(spark, sf):
    return reports.candle_count(Day(spark, sf).loaded)


@query
def day_status_summary(spark, sf):
    return status.day_status_summary(Day(spark, sf).status)


@query
def absent_days(spark, sf):
    """Expected days against files of every second day and ticks of every third."""
    day = Day(spark, sf)
    came = day.stats.filter(F.day("trade_date") % 2 == 0)
    archived = day.stats.filter(F.day("trade_date") % 3 == 0)
    return status.absent_day_status(day.expected, came, archived, _stamp(FIRST_RUN))


# Stores ---------------------------------------------------------------------


def _bars_with_flag(spark: SparkSession, sf: str) -> DataFrame:
    return saved(quality.flag_candle_spikes(feed.candle_feed(spark, sf), SETTINGS), "bars")


@query
def upsert_last_wins(spark, sf):
    """A batch with two rows per key of even minutes; that with the larger volume stays."""
    store, candles = _store(spark, "last_wins"), _bars_with_flag(spark, sf)
    again = candles.filter(F.minute("ts") % 2 == 0).withColumn("volume", F.col("volume") + 1)
    store.upsert(tables.CANDLES, candles.unionByName(again), newest=["volume"])
    return store.read(tables.CANDLES)


@query
def upsert_candles(spark, sf):
    """Later bars of days from the 8th on over stored bars up to the 20th."""
    store = _store(spark, "upsert")
    day, volume = F.day("trade_date"), F.col("volume")
    candles = _bars_with_flag(spark, sf)
    store.upsert(tables.CANDLES, candles.filter(day <= 20).withColumn("volume", F.when(day <= 10, volume + 1).otherwise(volume)))
    store.upsert(tables.CANDLES, candles.filter(day >= 8))
    return store.read(tables.CANDLES)


@query
def guarded_upsert(spark, sf):
    """Bars of which some have no volume, break a rule or come twice: what is stored, and what was set aside."""
    store = _store(spark, "guarded")
    given = feed.repeated_bars(spark, sf).withColumns(
        {"volume": F.when(F.minute("ts") % 11 != 0, F.col("volume")), "spike_flag": F.lit(False)}
    )
    store.guarded_upsert(tables.CANDLES, given)
    stored = store.read(tables.CANDLES).withColumn("rule", F.lit(None).cast("string"))
    aside = store.read(tables.BREACHES).select("rule", F.from_json("row", schemas.CANDLES, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("bar"))
    return stored.unionByName(aside.select("bar.*", "rule")).drop("spike_flag")


def _stored_status(spark: SparkSession, sf: str) -> Store:
    store = _store(spark, "status")
    first = status.symbol_day_status(feed.candle_feed(spark, sf), _stamp(FIRST_RUN)).filter(F.day("trade_date") <= 20)
    store.upsert(tables.DAY_STATUS, first.withColumn("minutes_count", F.lit(5)))
    return store


@query
def upsert_day_status(spark, sf):
    store = _stored_status(spark, sf)
    second = status.symbol_day_status(feed.candle_feed(spark, sf), _stamp(SECOND_RUN)).filter(F.day("trade_date") >= 8)
    store.upsert(tables.DAY_STATUS, second)
    return store.read(tables.DAY_STATUS)


@query
def upsert_partial(spark, sf):
    """Only status, reason and time change on rows already there."""
    store = _stored_status(spark, sf)
    late = status.symbol_day_status(feed.candle_feed(spark, sf), _stamp(SECOND_RUN)).filter(F.day("trade_date") >= 15)
    changes = late.select(
        "symbol", "trade_date", F.lit("MISSING").alias("status"), F.lit("corrupt").alias("reason"), "built_at"
    )
    store.partial_upsert(
        tables.DAY_STATUS, changes, ["status", "reason", "built_at"], {"minutes_count": F.lit(0)}
    )
    return store.read(tables.DAY_STATUS)


@query
def candle_csv_roundtrip(spark, sf):
    store = _store(spark, "csv")
    store.write_candle_csvs(Day(spark, sf).loaded)
    return store.read_candle_csvs()


@query
def coverage_csv(spark, sf):
    store = _store(spark, "coverage")
    store.write_coverage(Day(spark, sf).coverage)
    return store.read_coverage()


# Whole runs -----------------------------------------------------------------


def _landed(spark: SparkSession, sf: str) -> str:
    landing = scratch_dir(spark, "landing")
    feed.write_csv_landing(feed.raw_feed(spark, sf), landing)
    return landing


@query
def backfill_candles(spark, sf):
    """Raw files to stored candles in one run over all days."""
    store = _store(spark, "backfill")
    backfill(
        spark, _landed(spark, sf), store, SETTINGS,
        closed=calendar.holidays(spark, feed.CLOSED), built_at=FIRST_RUN, csv=False,
    )
    return store.read(tables.CANDLES)


@query
def incremental_update_(spark, sf):
    """Day status after the streaming update took in the same files."""
    store = _store(spark, "incremental")
    incremental_update(
        spark, _landed(spark, sf), store, scratch_dir(spark, "progress"), SETTINGS, built_at=FIRST_RUN, csv=False
    )
    return store.read(tables.DAY_STATUS)
