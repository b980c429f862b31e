"""Keyed merge of new rows into existing ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``newest``; combines before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*newest, *(c for c in rest if c not in newest)))
    return rows.groupBy(*key).agg(best.alias("_best")).select(*key, "_best.*").select(*rows.columns)


def check_keys(rows: DataFrame, key: Sequence[str]) -> None:
    """Raise if a key is null or occurs twice."""
    null = reduce(or_, (F.col(c).isNull() for c in key))
    wrong = rows.groupBy(*key).agg(F.count("*").alias("n")).filter(null | (F.col("n") > 1)).take(3)
    if wrong:
        raise ValueError(f"null or repeated keys {tuple(key)}: {[tuple(r) for r in wrong]}")


def upsert(existing: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows, replaced by or joined with ``updates`` on ``key``."""
    kept = existing.join(updates.select(*key), list(key), "left_anti")
    return kept.select(*existing.columns).unionByName(updates.select(*existing.columns))


def partial_upsert(
    existing: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    update_columns: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Like ``upsert``, but on a match only ``update_columns`` change.

    New rows take the columns the updates do not have from ``defaults``.
    """
    defaults = defaults or {}
    new = updates.select(
        *key, *(F.col(c).alias(f"_new_{c}") for c in updates.columns if c not in key), F.lit(True).alias("_new")
    )
    old = existing.withColumn("_old", F.lit(True))

    def merged(name: str) -> Column:
        if name in key:
            return F.col(name)
        fresh = F.col(f"_new_{name}") if name in updates.columns else F.lit(None)
        if name in defaults:
            fresh = F.coalesce(fresh, defaults[name])
        if name in update_columns:
            return F.when(F.col("_new"), fresh).otherwise(F.col(name)).alias(name)
        return F.when(F.col("_old"), F.col(name)).otherwise(fresh).alias(name)

    return old.join(new, list(key), "full_outer").select(*(merged(c) for c in existing.columns))
