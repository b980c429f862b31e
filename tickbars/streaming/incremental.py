"""The daily update as a stream over the landing folder.

Each micro-batch archives the new files and recomputes the days they touch
from the whole archive, so late or repeated files give the same tables as one
backfill. The stream's checkpoint remembers which files were taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators import status
from tickbars.plans.jobs import archived_dates, emptied_dates, ingest_rows, process_days, run_timestamp
from tickbars.settings import Settings
from tickbars.sources import store as tables
from tickbars.sources.files import csv_cells, csv_schema, landed_files, numbered, sqlite_files
from tickbars.sources.paths import make_dir
from tickbars.sources.sqlite import read_sqlite
from tickbars.sources.store import Store

# Columns of Spark's binary file source.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _landing_stream(spark: SparkSession, landing: str, settings: Settings, files_per_batch: int | None) -> DataFrame:
    """The rows of new CSV files, or the paths of new SQLite files."""
    # Files may come late with an old modification time; none is too old.
    reader = spark.readStream.option("pathGlobFilter", settings.glob).option("maxFileAge", "36500d")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if settings.source_format == "sqlite":
        # Only the paths are used; the file content is never loaded here.
        return reader.format("binaryFile").schema(BINARY_FILE).load(landing).select("path")
    return csv_cells(reader.schema(csv_schema()).option("header", False).csv(landing))


def incremental_update(
    spark: SparkSession,
    landing: str,
    store: Store,
    checkpoint: str,
    settings: Settings,
    replication_mode: str = "merge",
    write_mode: str = "replace_day",
    built_at: datetime | None = None,
    csv: bool = True,
    files_per_batch: int | None = None,
    target_dates: Sequence[date] | None = None,
    expected: DataFrame | None = None,
) -> None:
    """Take in the files that are new since the last call, then stop.

    With ``target_dates`` only these days are worked out; the others stay
    pending for later calls, also without new files, and also if they were
    worked out before. Of ``expected`` days those that brought nothing are
    recorded (see ``record_absent_days``). A call that stops anywhere is made
    good by the next one.
    """
    make_dir(spark, landing)

    def due() -> DataFrame:
        in_range, noted = archived_dates(store, settings), store.read(tables.PENDING)
        done = store.read(tables.VALIDATION).select("trade_date")
        # A later file can widen the range, so days not done yet count too.
        pending = in_range.join(done, "trade_date", "left_anti")
        dates = in_range.join(noted, "trade_date", "left_semi").unionByName(pending).unionByName(emptied_dates(store))
        return dates.filter(F.col("trade_date").isin(*target_dates)) if target_dates else dates

    def work_out(dates: DataFrame) -> None:
        process_days(store, settings, dates, replication_mode, write_mode, built_at, csv)

    def take(batch: DataFrame, batch_id: int) -> None:
        # The frames of a batch belong to its own session.
        if settings.source_format == "sqlite":
            files = sqlite_files(batch)
            ingest_rows(store, read_sqlite(files, settings), settings, files)
        else:
            ingest_rows(store, numbered(batch), settings)
        work_out(due())

    query = (
        _landing_stream(spark, landing, settings, files_per_batch)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Without new files there is no batch, but an earlier call may have left work, or days that are wanted now.
    store.recover()
    left = due()
    if not left.isEmpty():
        work_out(left)
    if expected is not None:
        record_absent_days(spark, landing, store, expected, settings, built_at)


def record_absent_days(
    spark: SparkSession,
    landing: str,
    store: Store,
    expected: DataFrame,
    settings: Settings,
    built_at: datetime | None = None,
) -> None:
    """Write MISSING rows for expected days that brought no file or no ticks."""
    archived = store.read(tables.INGESTED)
    rows = status.absent_day_status(
        expected, landed_files(spark, landing, settings), archived, run_timestamp(built_at)
    )
    store.upsert(tables.DAY_STATUS, rows)
