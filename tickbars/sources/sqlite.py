"""SQLite day files, planned and read by the executors.

A table of paths comes in. Tasks look up the ends of the row ids of their files
and deal out ranges of them as rows; other tasks read the ranges, so a file that
holds most of the rows is read by many. The driver opens no file and holds no
list of them. The files must lie on a path that all executors have mounted.

An error is a row with ``read_error``. Ticks and errors come from one pass over
a file; whether a file is whole is decided on the stored rows.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame

from tickbars.settings import Settings

ROWS_PER_SPLIT = 1_000_000
#: A stored trade takes this many bytes at least; a file has no more ranges than its size allows.
BYTES_PER_ROW = 12
ROWS_PER_BATCH = 20_000
FIELDS = ("symbol", "ts_raw", "price", "volume", "source_file", "source_path", "read_error")
ARROW_SCHEMA = pa.schema([(name, pa.string()) for name in FIELDS])


@dataclass(frozen=True)
class FileRange:
    path: str
    first_row: int | None
    last_row: int | None


def _open(path: str) -> sqlite3.Connection:
    location = path.removeprefix("file://").removeprefix("file:")
    connection = sqlite3.connect(f"file:{quote(location)}?mode=ro", uri=True)
    connection.text_factory = lambda raw: raw.decode("utf-8", "replace")
    return connection


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _text(value: object) -> str | None:
    if value is None or isinstance(value, bytes):
        return None
    return value if isinstance(value, str) else repr(value)


def _whole_text(value: object) -> str | None:
    """Whole numbers stored as REAL come out without their fraction."""
    if isinstance(value, float):
        return str(int(value)) if value == value and abs(value) < 2**63 else None
    return _text(value)


class SqliteReader:
    def __init__(self, options: dict[str, str]) -> None:
        self.table = options.get("table", "intraday_data")
        self.columns = [
            options.get(name, default)
            for name, default in (
                ("symbol", "symbol"),
                ("timestamp", "time"),
                ("price", "price"),
                ("volume", "volume"),
            )
        ]
        self.split = int(options.get("rowspersplit", ROWS_PER_SPLIT))
        self.listed = options.get("files")
        self.folder = options.get("path")
        self.glob = options.get("glob", "*.db")

    def _files(self) -> list[str]:
        if self.listed is not None:
            return sorted(p for p in self.listed.split("\n") if p)
        root = Path((self.folder or "").removeprefix("file://").removeprefix("file:"))
        if root.is_file():
            return [str(root)]
        return sorted(str(p) for p in root.glob(self.glob))

    def partitions(self) -> list[FileRange]:
        ranges: list[FileRange] = []
        for path in self._files():
            ranges.extend(self._ranges(path))
        return ranges or [FileRange("", None, None)]

    def _ranges(self, path: str) -> list[FileRange]:
        # Both ends come from the row-id index: no table scan.
        try:
            connection = _open(path)
            try:
                table = _quoted(self.table)
                (low,) = connection.execute(f"SELECT min(rowid) FROM {table}").fetchone()
                (high,) = connection.execute(f"SELECT max(rowid) FROM {table}").fetchone()
            finally:
                connection.close()
        except sqlite3.Error:
            # No row ids or no such table: one task finds out.
            return [FileRange(path, None, None)]
        if low is None:
            return []
        size = os.path.getsize(path.removeprefix("file://").removeprefix("file:"))
        ranges = min(-(-(high - low + 1) // self.split), max(1, -(-size // (BYTES_PER_ROW * self.split))))
        width = -(-(high - low + 1) // ranges)
        return [FileRange(path, start, min(start + width - 1, high)) for start in range(low, high + 1, width)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        source = partition.path.rsplit("/", 1)[-1]
        query = f"SELECT {', '.join(_quoted(c) for c in self.columns)} FROM {_quoted(self.table)}"
        bounds: tuple[int, ...] = ()
        if partition.first_row is not None:
            query += " WHERE rowid BETWEEN ? AND ?"
            bounds = (partition.first_row, partition.last_row)
        try:
            connection = _open(partition.path)
            try:
                cursor = connection.execute(query, bounds)
                while rows := cursor.fetchmany(ROWS_PER_BATCH):
                    yield self._batch(rows, source, partition.path)
            finally:
                connection.close()
        except sqlite3.Error as error:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.string()) for v in (None, None, None, None, source, partition.path, str(error))], schema=ARROW_SCHEMA
            )

    def _batch(self, rows: list[tuple], source: str, path: str) -> pa.RecordBatch:
        symbol, time, price, volume = zip(*rows)
        columns = [
            [_text(v) for v in symbol],
            [_text(v) for v in time],
            [_text(v) for v in price],
            [_whole_text(v) for v in volume],
            [source] * len(rows),
            [path] * len(rows),
            [None] * len(rows),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], schema=ARROW_SCHEMA)


def read_sqlite(files: DataFrame, settings: Settings) -> DataFrame:
    """Rows of the files in ``source_path``, as text, and errors."""
    names = settings.columns
    reader = SqliteReader(
        {"table": settings.sqlite_table, "symbol": names.symbol, "timestamp": names.timestamp, "price": names.price, "volume": names.volume}
    )
    spark = files.sparkSession
    # A number given here is not lowered by the adaptive execution: these rows are tiny and stand for much work.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("source_path").to_pylist():
                ranges = reader._ranges(path)
                columns = [[path] * len(ranges), [r.first_row for r in ranges], [r.last_row for r in ranges]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["path", "first_row", "last_row"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                yield from reader.read(FileRange(path, first, last))

    ranges = files.select("source_path").repartition(tasks, "source_path").mapInArrow(plan, "path string, first_row long, last_row long")
    return ranges.repartition(tasks, "path", "first_row").mapInArrow(read, ", ".join(f"{name} string" for name in FIELDS))
