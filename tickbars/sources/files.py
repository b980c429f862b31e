"""Raw tick files as text columns: symbol, ts_raw, price, volume, source_file, source_path.

Reading goes in two steps, for folders and for a stream alike. ``read_rows``
gives the rows of all files as they are; the caller stores them once.
``raw_files`` takes the stored rows apart into ticks and problems, so no file
is parsed a second time to find out what was wrong with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions.fields import file_date
from tickbars.schemas import FILE_PROBLEMS, FILES, PROBLEMS, RAW_TICKS, conform
from tickbars.settings import Settings
from tickbars.sources.paths import is_folder, path_exists, saved
from tickbars.sources.sqlite import read_sqlite

#: Columns of a CSV row that are looked at; a file with needed ones further right is a problem, not a loss.
CSV_WIDTH = 48
CELLS = [f"_c{i}" for i in range(CSV_WIDTH)]
BYTE_ORDER_MARK = "\ufeff"
RAW_FILE_TICKS = T.StructType([*RAW_TICKS.fields, T.StructField("source_path", T.StringType())])


@dataclass(frozen=True)
class RawFiles:
    """What stored rows come apart into; ``files`` are those that had any row."""

    ticks: DataFrame
    problems: DataFrame
    files: DataFrame


def map_columns(df: DataFrame, settings: Settings) -> DataFrame:
    """Configured source names to the canonical ones, everything as text."""
    names = settings.columns
    renamed = df.withColumnsRenamed(
        {names.symbol: "symbol", names.timestamp: "ts_raw", names.price: "price", names.volume: "volume"}
    )
    return conform(renamed, RAW_TICKS)


def plain_path(path: Column) -> Column:
    """A path that names a local file in one way, with or without a scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def csv_cells(df: DataFrame) -> DataFrame:
    """Cells of a CSV source read by ``csv_schema``, with the file and the block of every row."""
    return df.select(
        *CELLS,
        plain_path(F.col("_metadata.file_path")).alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def numbered(cells: DataFrame) -> DataFrame:
    """The cells with a number that grows within a block; not for a stream, but for its batches."""
    return cells.withColumn("row", F.monotonically_increasing_id())


def csv_schema() -> T.StructType:
    """Cells by position; what they mean is for the header of each file to say."""
    return T.StructType([T.StructField(c, T.StringType()) for c in CELLS])


def _globbed(reader, spark: SparkSession, path: str | list[str], settings: Settings):
    """The glob is for folders; files that are named are taken whatever their name."""
    first = path if isinstance(path, str) else next(iter(path), "")
    return reader.option("pathGlobFilter", settings.glob) if is_folder(spark, first) else reader


def list_files(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """(source_path, source_file) of the files below ``path``; their content is not read."""
    if isinstance(path, str) and not path_exists(spark, path) or path == []:
        return spark.createDataFrame([], FILES)
    found = _globbed(spark.read.format("binaryFile"), spark, path, settings).load(path)
    if settings.source_format == "csv":
        return found.select(plain_path(F.col("_metadata.file_path")).alias("source_path"), F.col("_metadata.file_name").alias("source_file"))
    return sqlite_files(found)


def sqlite_files(found: DataFrame) -> DataFrame:
    named = found.select(plain_path(F.col("path")).alias("source_path"))
    return named.withColumn("source_file", F.element_at(F.split("source_path", "/"), -1))


def read_rows(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """Rows of all files, for ``raw_files``; a missing folder has none."""
    if settings.source_format == "sqlite":
        return read_sqlite(list_files(spark, path, settings), settings)
    if isinstance(path, str) and not path_exists(spark, path) or path == []:
        return csv_rows_of_nothing(spark)
    reader = _globbed(spark.read.schema(csv_schema()).option("header", False), spark, path, settings)
    return numbered(csv_cells(reader.csv(path)))


def csv_rows_of_nothing(spark: SparkSession) -> DataFrame:
    kinds = ", ".join([*(f"{c} STRING" for c in CELLS), "source_path STRING, source_file STRING, block BIGINT, row BIGINT"])
    return spark.createDataFrame([], kinds)


def raw_files(rows: DataFrame, settings: Settings) -> RawFiles:
    """Ticks, problems and files of stored ``read_rows``."""
    return (_raw_sqlite if settings.source_format == "sqlite" else _raw_csv)(rows, settings)


def _raw_sqlite(rows: DataFrame, settings: Settings) -> RawFiles:
    """Files that could be read to their end give ticks, the others a problem."""
    broken = rows.where("read_error IS NOT NULL").groupBy(*FILES.fieldNames()).agg(F.min("read_error").alias("problem"))
    ticks = rows.where("read_error IS NULL").join(broken.select("source_path"), "source_path", "left_anti")
    return RawFiles(conform(ticks, RAW_FILE_TICKS), _problems(broken), rows.select(*FILES.fieldNames()).distinct())


def _problems(found: DataFrame) -> DataFrame:
    return conform(found.withColumn("trade_date", file_date(F.col("source_file"))), FILE_PROBLEMS).drop("bucket")


def header_index(rows: DataFrame, settings: Settings) -> DataFrame:
    """A row per CSV file: source_path, source_file, the row that is its header, and the places of the four fields.

    A place is null where the header does not have the field.
    """
    first = rows.where("block = 0").groupBy("source_path").agg(F.min("row").alias("header"))
    cells = F.array(*(F.regexp_replace(F.col(c), f"^{BYTE_ORDER_MARK}", "") if c == CELLS[0] else F.col(c) for c in CELLS))
    names = settings.columns
    fields = {"symbol": names.symbol, "ts_raw": names.timestamp, "price": names.price, "volume": names.volume}
    places = [F.nullif(F.array_position(cells, F.lit(name)), F.lit(0)).alias(f"at_{field}") for field, name in fields.items()]
    return rows.join(first.withColumnRenamed("header", "row"), ["source_path", "row"]).select(
        "source_path", "source_file", F.col("row").alias("header"), *places
    )


def _raw_csv(rows: DataFrame, settings: Settings) -> RawFiles:
    """Each file by its own header; one without a needed column gives a problem and no ticks.

    Headers differ in a few ways only, however many files there are: the
    orders of columns that occur become a CASE, and the index of the files is
    what the rows are joined with.
    """
    index = saved(header_index(rows, settings), "headers")
    fields = ("symbol", "ts_raw", "price", "volume")
    places = [f"at_{f}" for f in fields]
    missing = F.array_compact(F.array(*(F.when(F.col(p).isNull(), getattr(settings.columns, "timestamp" if f == "ts_raw" else f)) for f, p in zip(fields, places))))
    good = index.where(F.size(missing) == 0)
    orders = sorted(tuple(r) for r in good.select(*places).distinct().collect())  # orders of columns
    data = rows.select(*CELLS, "source_path", "source_file", "row").join(good.select("source_path", "header", *places), "source_path").where("row <> header")

    def cell(place: str) -> Column:
        value = F.lit(None).cast("string")
        for at in sorted({o[places.index(place)] for o in orders}):
            value = F.when(F.col(place) == at, F.col(CELLS[at - 1])).otherwise(value)
        return value

    ticks = data.select(*(cell(p).alias(f) for f, p in zip(fields, places)), "source_file", "source_path")
    bad = index.where(F.size(missing) > 0).withColumn("problem", F.concat(F.lit("no column "), F.array_join(missing, ", ")))
    lost = rows.select("source_path").join(bad, "source_path").groupBy(*FILES.fieldNames(), "problem").agg((F.count("*") - 1).alias("n_rows"))
    return RawFiles(conform(ticks, RAW_FILE_TICKS), _problems(lost), index.select(*FILES.fieldNames()))


def read_raw_ticks(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """Ticks of all matching files, with the rows stored once in the shared folder."""
    return raw_files(saved(read_rows(spark, path, settings), "rows"), settings).ticks


def read_csv_ticks(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """All matching CSV files, each by its own header; large files are split by Spark."""
    return raw_files(saved(read_rows(spark, path, settings), "rows"), settings).ticks


def read_sqlite_ticks(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """Ticks of SQLite files; one that breaks off anywhere gives none (see ``read_problems``)."""
    return raw_files(saved(read_rows(spark, path, settings), "rows"), settings).ticks


def sqlite_read_errors(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """Files that could not be read, with the error."""
    failed = read_rows(spark, path, settings).filter(F.col("read_error").isNotNull())
    return failed.select("source_file", "read_error")


def read_problems(spark: SparkSession, path: str | list[str], settings: Settings) -> DataFrame:
    """One row per unusable file: source_file, trade_date in its name, problem, n_rows."""
    return conform(raw_files(saved(read_rows(spark, path, settings), "rows"), settings).problems, PROBLEMS)


def landed_files(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    """File names below ``path`` that match the glob, with the date in the name."""
    return list_files(spark, path, settings).select("source_file").withColumn("trade_date", file_date(F.col("source_file")))
