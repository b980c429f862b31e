"""Lenient casts, file-name dates and tick defects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted as a number ("12d" and hexadecimal floats are not).
DECIMAL_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# A file name less its extension, and the date digits at its end.
STEM_PATTERN = r"([^/]+?)(?:\.[^./]*)?$"
LAST_DATE_PATTERN = r"((?!0000)[0-9]{8})$"


def lenient_double(value: Column) -> Column:
    """Double of a number or numeric text, else null; NaN counts as null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def lenient_double_text(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL_PATTERN), lenient_double(text))


def lenient_bigint(value: Column) -> Column:
    """Whole number of a number (cut off) or of integer text, else null."""
    return value.try_cast("bigint")


def file_date(path: Column) -> Column:
    """Date in the last eight digits of a file's stem, else null."""
    stem = F.regexp_extract(path, STEM_PATTERN, 1)
    last_digits = F.regexp_extract(F.regexp_replace(stem, "[^0-9]", ""), LAST_DATE_PATTERN, 1)
    return F.try_to_date(last_digits, "yyyyMMdd")


def coercion_failed(price: Column, volume: Column, ts: Column) -> Column:
    return price.isNull() | F.isnan(price) | volume.isNull() | ts.isNull()


def tick_defect(symbol: Column, ts: Column, price: Column, volume: Column) -> Column:
    """Why a tick cannot be used, or null when it can."""
    return (
        F.when(ts.isNull(), "no_timestamp")
        .when(price.isNull() | F.isnan(price), "no_price")
        .when(volume.isNull(), "no_volume")
        .when(symbol.isNull(), "no_symbol")
        .when(price <= 0, "price_not_positive")
        .when(volume < 0, "volume_negative")
    )
