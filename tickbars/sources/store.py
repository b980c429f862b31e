"""Partitioned Parquet tables of one data set.

Every table is rewritten by partition with dynamic overwrite, so a task or an
executor can fail and rerun, and repeating a whole job gives the same tables.
One writer at a time: the overwrite is not atomic across partitions.

The archive is laid out by day and by a bucket of the file's path, so a day has
``buckets`` folders at most, however many files it comes from. A manifest
(``INGESTED``) lists which days each path brought, and in which bucket. When a
file comes again, the folders it touches are written anew with the rows of the
other files in them. That work is written down first, with all the rows it
needs, in a folder of ``_intents``; a call that finds one there finishes it
before it does anything else. The days that gain or lose ticks are noted in
``PENDING`` before any folder changes and leave it when they are worked out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars import schemas
from tickbars.operators import merge, rules
from tickbars.sources.paths import delete_path, folders_in, path_exists

# Columns of the CSV output.
CSV_COLUMNS = ("symbol", "minute_local", "ts", "open", "high", "low", "close", "volume", "had_trade")


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    partition: tuple[str, ...] = ("trade_date",)
    key: tuple[str, ...] = ()


ARCHIVE = Table("archive", schemas.ARCHIVED, ("trade_date", "bucket"))
INGESTED = Table("ingested", schemas.INGESTED, ("bucket",))
REJECTS = Table("rejects", schemas.REJECTS, ("reject_date",))
PROBLEMS = Table("ingest_problems", schemas.FILE_PROBLEMS, ("bucket",))
STALE = Table("stale_days", schemas.PROBLEMS, ("trade_date",))
PENDING = Table("pending_days", schemas.PENDING_DAYS)
CLEAN_STATS = Table("clean_stats", schemas.CLEAN_STATS)
CANDLES = Table("candles_1m", schemas.CANDLES, key=schemas.CANDLE_KEY)
DAY_STATUS = Table("day_status", schemas.DAY_STATUS, key=schemas.STATUS_KEY)
VALIDATION = Table("validation_report", schemas.DAY_STATS)
QUARANTINE = Table("quarantine", schemas.QUARANTINE, ("quarantine_date",))
DEDUP_LOG = Table("dedup_log", schemas.DEDUP_LOG)
BREACHES = Table("rule_breaches", schemas.BREACHES, ("table_name", "trade_date"))
RULES = {CANDLES.name: rules.CANDLE_RULES, DAY_STATUS.name: rules.STATUS_RULES}


#: Folders of the archive per day, and of the manifest.
BUCKETS = 16


#: Size from which shuffled rows of a write get a task of their own.
OWN_TASK = "16k"


@contextmanager
def _spread(spark: SparkSession) -> Iterator[None]:
    """Writes within keep small shuffle partitions apart, as far as there are cores.

    Merged, a table with a few rows for each of many days goes to one task,
    which opens one file after another.
    """
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    spark.conf.set(key, OWN_TASK)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _always(column: str, schema: T.StructType) -> Column:
    """A comparison that holds for every value that is not null."""
    kind = schema[column].dataType
    lowest = {T.DateType(): F.lit("0000-01-01").cast("date"), T.IntegerType(): F.lit(-(2**31))}.get(kind, F.lit(""))
    return F.col(column) >= lowest


def _same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Equality of columns, nulls being equal."""
    return reduce(and_, (left[c].eqNullSafe(right[c]) for c in columns))


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def exists(self, table: Table) -> bool:
        return path_exists(self.spark, self.path(table))

    def read(self, table: Table, only: DataFrame | None = None) -> DataFrame:
        """The table, or its rows for the values in ``only``.

        ``only`` holds trade dates, or values of another partition column;
        just those partitions are read.
        """
        if not self.exists(table):
            return self.spark.createDataFrame([], table.schema)
        rows = self.spark.read.schema(table.schema).parquet(self.path(table)).select(table.schema.fieldNames())
        if only is None:
            return rows
        column = next((c for c in table.partition if c in only.columns), None)
        wanted = only if column else only.withColumnRenamed("trade_date", table.partition[0])
        column = column or table.partition[0]
        # Spark prunes partitions by a join only if the other side has a filter.
        listed = wanted.select(column).distinct().filter(_always(column, table.schema))
        return rows.join(F.broadcast(listed), column, "left_semi")  # dates or file names

    def overwrite_partitions(self, table: Table, rows: DataFrame, cluster: bool = True) -> None:
        """Replace the partitions ``rows`` has data for.

        ``cluster`` brings the rows of a partition together; the rebalance
        splits a large day over several files again.
        """
        out = schemas.conform(rows, table.schema)
        if cluster:
            out = out.hint("rebalance", *table.partition)
        with _spread(out.sparkSession):
            (
                out.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy(*table.partition)
                .parquet(self.path(table))
            )

    def _bucket(self, path: str) -> Column:
        return F.pmod(F.xxhash64(path), F.lit(self.buckets)).cast("int").alias("bucket")

    def archive(
        self, ticks: DataFrame, cluster: bool = False, files: DataFrame | None = None, problems: DataFrame | None = None
    ) -> None:
        """Make ``ticks`` all that the archive has of their files, and of ``files`` and the files with ``problems``.

        A file is known by ``source_path``, or by ``source_file`` where the
        ticks have no path. Files of one day each need no shuffle. Others do
        (``cluster``), or every task would write a small file for every day.
        """
        self.recover()
        folder = f"{self.root}/_intents/{uuid.uuid4().hex}"
        path = F.coalesce(*(F.col(c) for c in ("source_path", "source_file") if c in ticks.columns), F.lit(""))
        new = ticks.withColumn("source_path", path).withColumn("bucket", self._bucket("source_path"))
        new = self._kept(folder, "ticks", lambda: new, schemas.ARCHIVED)
        key = ["source_path", "source_file", "trade_date", "bucket"]
        brought = self._kept(folder, "brought", lambda: new.groupBy(*key).agg(F.count("*").alias("n_ticks")), schemas.INGESTED)
        listed = brought.select("source_path")
        if problems is not None:
            found = problems.withColumn("bucket", self._bucket("source_path"))
            listed = listed.unionByName(self._kept(folder, "problems", lambda: found, schemas.FILE_PROBLEMS).select("source_path"))
        if files is not None:
            listed = listed.unionByName(files.select("source_path"))
        listed = listed.distinct().withColumn("bucket", self._bucket("source_path"))
        self._kept(folder, "files", lambda: listed, schemas.LISTED)  # with this the intent is complete
        self._carry_out(folder, cluster)

    def recover(self) -> None:
        """Finish what an earlier call wrote down and did not finish; drop what it did not write down to the end."""
        for name in folders_in(self.spark, f"{self.root}/_intents"):
            folder = f"{self.root}/_intents/{name}"
            if path_exists(self.spark, f"{folder}/files/_SUCCESS"):
                self._carry_out(folder, cluster=True)
            else:
                delete_path(self.spark, folder)

    def _kept(self, folder: str, name: str, rows: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
        """A part of an intent, written unless it is there; it must not change once folders of tables do."""
        path = f"{folder}/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            schemas.conform(rows(), schema).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _carry_out(self, folder: str, cluster: bool) -> None:
        """Bring archive, manifest and problems to what the intent says. Every step can be repeated."""

        def part(name: str, schema: T.StructType) -> DataFrame:
            there = path_exists(self.spark, f"{folder}/{name}/_SUCCESS")
            return self.spark.read.schema(schema).parquet(f"{folder}/{name}") if there else self.spark.createDataFrame([], schema)

        new, brought, files = part("ticks", schemas.ARCHIVED), part("brought", schemas.INGESTED), part("files", schemas.LISTED)
        spot = ["trade_date", "bucket"]
        manifest = self.read(INGESTED)
        known = manifest.join(files.select("source_path"), "source_path", "left_semi")
        stale = known.join(brought, _same(known, brought, "source_path", "trade_date"), "left_anti")
        # Days go by the manifest, which changes last: a repeated call finds the same ones.
        self.note_days(brought, stale)
        if not self.exists(INGESTED):  # nothing to keep and nothing to drop
            self.overwrite_partitions(ARCHIVE, new, cluster)
        else:
            spots = self._kept(folder, "spots", lambda: brought.select(*spot).union(known.select(*spot)).distinct(), schemas.SPOTS)
            others = manifest.join(files.select("source_path"), "source_path", "left_anti").select(*spot).distinct()
            shared = self._kept(folder, "shared", lambda: others.join(spots, _same(others, spots, *spot), "left_semi"), schemas.SPOTS)
            kept = self._kept(folder, "kept", lambda: self._rows_at(shared).join(files.select("source_path"), "source_path", "left_anti"), schemas.ARCHIVED)
            self.overwrite_partitions(ARCHIVE, new.unionByName(kept), cluster)
            filled = brought.select(*spot).union(shared).distinct()
            self.drop_partitions(ARCHIVE, spots.join(filled, _same(spots, filled, *spot), "left_anti"))
        self._replace_listed(folder, PROBLEMS, part("problems", schemas.FILE_PROBLEMS), files)
        self._replace_listed(folder, INGESTED, brought, files)
        delete_path(self.spark, folder)

    def _rows_at(self, spots: DataFrame) -> DataFrame:
        """Rows of the archive in some of its folders; only those are read."""
        dated = self.read(ARCHIVE, spots.where("trade_date IS NOT NULL")).join(spots, ["trade_date", "bucket"], "left_semi")
        undated = self.read(ARCHIVE).where("trade_date IS NULL").join(spots.where("trade_date IS NULL").select("bucket"), "bucket", "left_semi")
        return dated.select(*schemas.ARCHIVED.fieldNames()).unionByName(undated.select(*schemas.ARCHIVED.fieldNames()))

    def _replace_listed(self, folder: str, table: Table, rows: DataFrame, files: DataFrame) -> None:
        """Make ``rows`` all that a table by bucket has of ``files``."""
        if not self.exists(table):
            self.overwrite_partitions(table, rows)
            return
        touched = files.select("bucket").distinct()
        old = self.read(table, touched).join(files.select("source_path"), "source_path", "left_anti")
        whole = rows.unionByName(self._kept(folder, f"kept_{table.name}", lambda: old, table.schema))
        self.overwrite_partitions(table, whole)
        self.drop_partitions(table, touched.join(whole.select("bucket").distinct(), "bucket", "left_anti"))

    def note_days(self, touched: DataFrame, emptied: DataFrame) -> None:
        """Add days to PENDING, where they stay until they are worked out; ``emptied`` ones have lost ticks."""
        new = touched.where("trade_date IS NOT NULL").select("trade_date", F.lit(False).alias("emptied"))
        lost = emptied.where("trade_date IS NOT NULL").select("trade_date", F.lit(True).alias("emptied"))
        new = new.unionByName(lost).unionByName(self.read(PENDING))
        with self.staged(new.groupBy("trade_date").agg(F.max("emptied").alias("emptied")), schemas.PENDING_DAYS) as days:
            self.overwrite_partitions(PENDING, days)

    def replace_days(self, table: Table, rows: DataFrame, dates: DataFrame, stage: bool = True) -> None:
        """Make ``rows`` the whole content of ``dates``; days without rows disappear.

        ``rows`` are read twice. ``stage`` stores them first; leave it out for
        rows that come straight from a stored table.
        """
        with self.staged(rows, table.schema) if stage else nullcontext(rows) as new:
            self.overwrite_partitions(table, new)
            day = table.partition[0]
            filled = new.select(F.col(day).alias("trade_date")).distinct()
            emptied = dates.select("trade_date").distinct().join(filled, "trade_date", "left_anti")
            for row in emptied.collect():  # calendar-sized
                delete_path(self.spark, f"{self.path(table)}/{day}={row.trade_date}")

    def upsert(self, table: Table, updates: DataFrame, newest: Sequence[str] = (), stage: bool = True) -> None:
        """Insert or replace rows by key, rewriting the touched days only.

        Keys that occur twice in ``updates`` need ``newest``, the columns
        whose greatest value wins; without it they are an error, and so is a
        null in a key. ``stage=False`` is for updates that come straight from
        a stored table. The merged rows are stored before a partition is
        replaced, so a broken run loses no row.
        """
        with self.staged(updates, table.schema) if stage else nullcontext(schemas.conform(updates, table.schema)) as new:
            if newest:
                new = merge.last_per_key(new, table.key, newest)
            merge.check_keys(new, table.key)
            current = self.read(table, new.select("trade_date"))
            with self.staged(merge.upsert(current, new, table.key), table.schema) as merged:
                self.overwrite_partitions(table, merged)

    def guarded_upsert(self, table: Table, updates: DataFrame) -> None:
        """Upsert of the rows that keep the table's rules, with its defaults; the others go to BREACHES.

        The breaches of a table are those of the last write of each day.
        """
        schema = T.StructType([*table.schema.fields, T.StructField("rule", T.StringType())])
        given = schemas.conform(updates, table.schema)
        with self.staged(rules.judged(given, RULES[table.name]), schema) as judged:
            found = rules.breaches(judged, table.name)
            written = judged.select("trade_date").distinct().withColumn("table_name", F.lit(table.name))
            self.overwrite_partitions(BREACHES, found)
            clean = written.join(broken := found.select("trade_date").distinct(), _same(written, broken, "trade_date"), "left_anti")
            if self.exists(BREACHES):
                self.drop_partitions(BREACHES, clean)
            self.upsert(table, rules.accepted(judged), stage=False)

    def drop_partitions(self, table: Table, gone: DataFrame) -> None:
        """Remove whole partitions; ``gone`` has their values, which the driver walks through."""
        names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for row in gone.select(*table.partition).distinct().toLocalIterator():
            parts = []
            for column, value in zip(table.partition, row):
                text = "__HIVE_DEFAULT_PARTITION__" if value is None else names.escapePathName(str(value))
                parts.append(f"{column}={text}")
            delete_path(self.spark, "/".join([self.path(table), *parts]))

    def partial_upsert(
        self,
        table: Table,
        updates: DataFrame,
        update_columns: Sequence[str],
        defaults: Mapping[str, Column] | None = None,
    ) -> None:
        """Upsert that changes only ``update_columns`` of rows already there."""
        given = T.StructType([f for f in table.schema.fields if f.name in updates.columns])
        with self.staged(updates, given) as new:
            merge.check_keys(new, table.key)
            current = self.read(table, new.select("trade_date"))
            merged = merge.partial_upsert(current, new, table.key, update_columns, defaults)
            with self.staged(merged, table.schema) as whole:
                self.overwrite_partitions(table, whole)

    @contextmanager
    def staged(self, rows: DataFrame, schema: T.StructType) -> Iterator[DataFrame]:
        """``rows`` written once and read back, gone at the end of the block."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        schemas.conform(rows, schema).write.parquet(path)
        try:
            yield self.spark.read.schema(schema).parquet(path)
        finally:
            delete_path(self.spark, path)

    def write_candle_csvs(self, candles: DataFrame) -> None:
        """A CSV per symbol and day, replaced when the day is written again."""
        (
            candles.select(
                *CSV_COLUMNS, F.col("symbol").alias("for_symbol"), F.col("trade_date").alias("for_date")
            )
            .hint("rebalance", "for_symbol", "for_date")
            .sortWithinPartitions("for_symbol", "for_date", "ts")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("for_symbol", "for_date")
            .csv(f"{self.root}/csv", header=True)
        )

    def drop_candle_csvs(self, gone: DataFrame) -> None:
        """Remove the CSVs of the given (symbol, trade_date)."""
        folders = gone.select(F.col("symbol").alias("for_symbol"), F.col("trade_date").alias("for_date"))
        self.drop_partitions(Table("csv", schemas.DATES, ("for_symbol", "for_date")), folders)

    def read_candle_csvs(self) -> DataFrame:
        ddl = {f.name: f.dataType.simpleString() for f in schemas.CANDLES.fields}
        schema = ", ".join(f"{c} {ddl[c]}" for c in CSV_COLUMNS)
        return self.spark.read.schema(schema).csv(f"{self.root}/csv", header=True).select(*CSV_COLUMNS)

    def write_coverage(self, report: DataFrame) -> None:
        """The coverage report as one ordered CSV; it has one row per calendar day."""
        report.coalesce(1).sortWithinPartitions("trade_date").write.mode("overwrite").csv(
            f"{self.root}/coverage", header=True
        )

    def read_coverage(self) -> DataFrame:
        return self.spark.read.schema(schemas.COVERAGE).csv(f"{self.root}/coverage", header=True)
