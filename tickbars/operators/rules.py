"""Key, not-null and default rules of a table, applied to the rows of a write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.schemas import CANDLE_DEFAULTS, CANDLE_KEY, CANDLE_REQUIRED, REPEATED_KEY, STATUS_DEFAULTS, STATUS_KEY, STATUS_REQUIRED


@dataclass(frozen=True)
class Rules:
    """``defaults`` fill nulls first; then ``required`` columns must not be null and a ``key`` must occur once."""

    key: Sequence[str]
    required: Sequence[str] = ()
    defaults: Sequence[tuple[str, object]] = ()


CANDLE_RULES = Rules(CANDLE_KEY, CANDLE_REQUIRED, CANDLE_DEFAULTS)
STATUS_RULES = Rules(STATUS_KEY, STATUS_REQUIRED, STATUS_DEFAULTS)


def judged(rows: DataFrame, rules: Rules) -> DataFrame:
    """``rows`` with defaults filled in and ``rule``, the first rule that a row breaks, or null.

    Of rows that share a key none is better than the others: all break it. A
    key is counted before the shuffle, and only keys that occur twice are
    joined with, so a key with any number of rows is no hot one.
    """
    filled = rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in rules.defaults if c in rows.columns})
    null = F.lit(None).cast("string")
    for column in reversed([*dict.fromkeys([*rules.key, *rules.required])]):
        null = F.when(F.col(column).isNull(), f"null_{column}").otherwise(null)
    named = filled.withColumn("rule", null)
    repeated = named.where("rule IS NULL").groupBy(*rules.key).agg(F.count("*").alias("_n")).where("_n > 1")
    marked = named.join(repeated, list(rules.key), "left")
    rule = F.coalesce("rule", F.when(F.col("_n") > 1, REPEATED_KEY))
    return marked.withColumn("rule", rule).select(*rows.columns, "rule")


def accepted(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where("rule IS NULL").drop("rule")


def breaches(judged_rows: DataFrame, table_name: str) -> DataFrame:
    """The rows that break a rule: table_name, trade_date, rule and the row as JSON."""
    row = F.to_json(F.struct(*(c for c in judged_rows.columns if c != "rule")))
    return judged_rows.where("rule IS NOT NULL").select(F.lit(table_name).alias("table_name"), "trade_date", "rule", row.alias("row"))
