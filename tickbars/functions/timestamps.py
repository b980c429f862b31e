"""Timestamps: raw text to UTC, UTC to exchange time, flooring.

Everything is TIMESTAMP_NTZ, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickbars.settings import TIMESTAMP_FORMATS

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# Seconds of 0001-01-01 and of 9999-12-31 23:59:59.
MIN_EPOCH_SECOND = -62135596800
MAX_EPOCH_SECOND = 253402300799

# Accepted spellings of a timestamp.
NAIVE_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
UNZONED_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
OFFSET_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$"
NUMBER_PATTERN = r"^[+-]?\d+(\.\d+)?$"
EPOCH_MS_ABOVE = 1e12


def epoch_to_ntz(count: Column, unit: str) -> Column:
    """UTC timestamp ``count`` seconds or milliseconds after 1970; out of range is null."""
    scale = {"SECOND": 1, "MILLISECOND": 1000}[unit]
    whole = count.try_cast("bigint")
    in_range = whole.between(MIN_EPOCH_SECOND * scale, MAX_EPOCH_SECOND * scale + scale - 1)
    return F.when(in_range, F.timestamp_add(unit, whole, F.expr(EPOCH)))


def instant_to_ntz(instant: Column) -> Column:
    """UTC wall clock of a zoned timestamp, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH))


def to_local(ts_utc: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc)


def to_utc(ts_local: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts_local)


def _naive(text: Column) -> Column:
    return F.when(text.rlike(NAIVE_PATTERN), text.try_cast("timestamp_ntz"))


def _iso(text: Column) -> Column:
    zoned = instant_to_ntz(text.try_cast("timestamp"))
    return F.when(text.rlike(OFFSET_PATTERN), zoned).when(text.rlike(UNZONED_PATTERN), text.try_cast("timestamp_ntz"))


def _numeric_text(text: Column) -> Column:
    """Whole number in a numeric string; a fraction is cut off."""
    return F.when(text.rlike(NUMBER_PATTERN), F.regexp_replace(text, r"\.\d+$", ""))


def _auto(text: Column, zone: str) -> Column:
    number = _numeric_text(text)
    is_ms = number.try_cast("double") > EPOCH_MS_ABOVE
    is_iso = text.contains("+") | text.contains("Z") | text.contains("T") | text.rlike(OFFSET_PATTERN)
    return (
        F.when(number.isNotNull() & is_ms, epoch_to_ntz(number, "MILLISECOND"))
        .when(number.isNotNull(), epoch_to_ntz(number, "SECOND"))
        .when(is_iso, _iso(text))
        .otherwise(_naive(text))
    )


def parse_timestamp(raw: Column, fmt: str, zone: str) -> Column:
    """UTC timestamp of a raw value; null when it does not fit ``fmt``.

    ``auto`` decides row by row, so the result does not depend on which row
    a scan happens to read first.
    """
    text = raw.cast("string")
    if fmt == "epoch_s":
        return epoch_to_ntz(_numeric_text(text), "SECOND")
    if fmt == "epoch_ms":
        return epoch_to_ntz(_numeric_text(text), "MILLISECOND")
    if fmt == "naive_utc":
        return _naive(text)
    if fmt == "naive_local":
        return to_utc(_naive(text), zone)
    if fmt == "iso":
        return _iso(text)
    if fmt == "auto":
        return _auto(text, zone)
    raise ValueError(f"unknown timestamp format {fmt!r}, expected one of {TIMESTAMP_FORMATS}")


def floor_minutes(ts: Column, minutes: int = 1) -> Column:
    """Start of the ``minutes``-wide bucket; NTZ in, NTZ out.

    Spark drops rows whose ``ts`` is null here, so use it on clean rows only.
    """
    return F.window(ts, f"{minutes} minutes").getField("start")


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
