"""Relations of the library and their key and not-null rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema of ``name TYPE, ...``; needs no session, unlike the DDL parser."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the tables that the library reads and writes.

RAW_TICKS = _schema("symbol STRING, ts_raw STRING, price STRING, volume STRING, source_file STRING")

TICKS = _schema(
    "symbol STRING, ts_utc TIMESTAMP_NTZ, ts_local TIMESTAMP_NTZ, trade_date DATE, "
    "price DOUBLE, volume BIGINT, source_file STRING"
)

CANDLES = _schema(
    "symbol STRING, trade_date DATE, ts TIMESTAMP_NTZ, minute_local TIMESTAMP_NTZ, open DOUBLE, "
    "high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT, had_trade BOOLEAN, spike_flag BOOLEAN"
)

CHECKED_CANDLES = _schema(
    "symbol STRING, trade_date DATE, ts TIMESTAMP_NTZ, minute_local TIMESTAMP_NTZ, open DOUBLE, "
    "high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT, had_trade BOOLEAN, ohlc_valid BOOLEAN, "
    "price_valid BOOLEAN, volume_valid BOOLEAN, minute_boundary BOOLEAN, is_valid BOOLEAN, spike_flag BOOLEAN"
)

DAY_STATUS = _schema(
    "symbol STRING, trade_date DATE, status STRING, reason STRING, minutes_count BIGINT, "
    "first_ts TIMESTAMP_NTZ, last_ts TIMESTAMP_NTZ, built_at TIMESTAMP_NTZ"
)

DAY_STATS = _schema(
    "trade_date DATE, status STRING, reason STRING, minutes_count BIGINT, symbols_count BIGINT, "
    "quarantined BIGINT, spikes_flagged BIGINT, ohlc_failures BIGINT, price_failures BIGINT, "
    "volume_failures BIGINT, boundary_failures BIGINT, gap_flag BOOLEAN"
)

CLEAN_STATS = _schema(
    "trade_date DATE, input_rows BIGINT, coercion_failures BIGINT, invalid_dropped BIGINT, "
    "duplicates_dropped BIGINT, out_of_session_dropped BIGINT, spikes_flagged BIGINT, output_rows BIGINT"
)

REJECTS = _schema(
    "symbol STRING, ts_utc TIMESTAMP_NTZ, ts_local TIMESTAMP_NTZ, trade_date DATE, price DOUBLE, "
    "volume BIGINT, source_file STRING, defect STRING, reject_date DATE"
)

DEDUP_LOG = _schema("trade_date DATE, symbol STRING, n_copies BIGINT, action STRING, detail STRING, kept_source STRING")

COVERAGE = _schema(
    "trade_date DATE, day_of_week STRING, status STRING, reason STRING, minutes_count BIGINT, symbols_count BIGINT"
)

QUARANTINE = _schema(
    "symbol STRING, trade_date DATE, ts TIMESTAMP_NTZ, minute_local TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, "
    "low DOUBLE, close DOUBLE, volume BIGINT, had_trade BOOLEAN, spike_flag BOOLEAN, quarantine_date DATE"
)

BREACHES = _schema("table_name STRING, trade_date DATE, rule STRING, row STRING")

DATES = _schema("trade_date DATE")

PENDING_DAYS = _schema("trade_date DATE, emptied BOOLEAN")

DAY_SYMBOLS = _schema("symbol STRING, trade_date DATE")

# A file is known by its path; its name is for people and for the date in it.
FILES = _schema("source_path STRING, source_file STRING")

ARCHIVED = T.StructType([*TICKS.fields, *_schema("source_path STRING, bucket INT").fields])

INGESTED = _schema("source_path STRING, source_file STRING, trade_date DATE, bucket INT, n_ticks BIGINT")

LISTED = _schema("source_path STRING, bucket INT")

SPOTS = _schema("trade_date DATE, bucket INT")

FILE_PROBLEMS = _schema(
    "source_path STRING, source_file STRING, trade_date DATE, problem STRING, n_rows BIGINT, bucket INT"
)

PROBLEMS = _schema("source_file STRING, trade_date DATE, problem STRING, n_rows BIGINT")

TRADE_SLICES = _schema(
    "fate INT, symbol STRING, slice BIGINT, trade_date DATE, first_ts TIMESTAMP_NTZ, n_ticks BIGINT, "
    "n_trades BIGINT, n_spikes BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT"
)

REPEATED_KEY = "repeated_key"

COPY_CANDLES = _schema(
    "trade_date DATE, source_file STRING, symbol STRING, ts TIMESTAMP_NTZ, "
    "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT"
)

CANDLE_KEY = ("symbol", "ts")
STATUS_KEY = ("symbol", "trade_date")
CANDLE_REQUIRED = ("symbol", "ts", "open", "high", "low", "close", "volume", "had_trade")
STATUS_REQUIRED = ("symbol", "trade_date", "status")
# What a column gets that a row leaves empty.
CANDLE_DEFAULTS = (("volume", 0), ("had_trade", True))
STATUS_DEFAULTS = (("minutes_count", 0),)
MARKET = "*"  # symbol of a market-wide status row


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order and cast; absent ones become null."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
