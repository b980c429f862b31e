"""Session rules compiled to Column expressions.

The rules are a handful of configuration rows, so they become a CASE over the
date: no join, no shuffle, and the predicate moves down to the scan.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickbars.settings import Hours, SessionRules

FRIDAY = 4


def _branches(trade_date: Column, rules: SessionRules) -> list[tuple[Column, tuple[Hours, ...]]]:
    """(condition, windows) pairs, first match wins; the regular hours come last."""
    friday = [(F.weekday(trade_date) == FRIDAY, rules.friday)] if rules.friday else []
    dated = [(trade_date.between(F.lit(o.first), F.lit(o.last)), (o.hours,)) for o in rules.overrides]
    ranked = dated + friday if rules.overrides_apply_on_friday else friday + dated
    return ranked + [(F.lit(True), (rules.regular,))]


def _case(pairs: list[tuple[Column, Column]]) -> Column:
    (first_if, first_then), *rest = pairs
    expr = F.when(first_if, first_then)
    for condition, value in rest:
        expr = expr.when(condition, value)
    return expr


def in_session(ts_local: Column, trade_date: Column, rules: SessionRules) -> Column:
    """True when the local time lies in a window of its date, both ends included.

    To the microsecond: 15:30:00 passes, 15:30:00.000001 does not. The time is
    read several times, so let it be a stored column rather than a conversion.
    """
    clock = ts_local - trade_date.cast("timestamp_ntz")

    def inside(windows: tuple[Hours, ...]) -> Column:
        test = F.lit(False)
        for w in windows:
            ends = (F.lit(timedelta(seconds=s)) for s in (w.first_second, w.last_second))
            test = test | clock.between(*ends)
        return test

    return _case([(condition, inside(windows)) for condition, windows in _branches(trade_date, rules)])


def _disjoint(windows: tuple[Hours, ...]) -> list[tuple[int, int]]:
    """(first, last) second of the windows in order, those that overlap as one."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted((w.first_second, w.last_second) for w in windows):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def open_micros(start: Column, end: Column, trade_date: Column, rules: SessionRules) -> Column:
    """Microseconds between two local times of a date that lie in its session.

    What is left of the time between them without the closed parts before,
    between and after the windows; 0 where ``end`` is not later.
    """
    midnight = trade_date.cast("timestamp_ntz")
    begin, stop = (F.timestamp_diff("MICROSECOND", midnight, t) for t in (start, end))

    def inside(windows: tuple[Hours, ...]) -> Column:
        total = F.lit(0).cast("bigint")
        for first, last in _disjoint(windows):
            shared = F.least(stop, F.lit(last * 1_000_000)) - F.greatest(begin, F.lit(first * 1_000_000))
            total = total + F.greatest(shared, F.lit(0))
        return F.when(start.isNotNull() & end.isNotNull(), total)

    return _case([(condition, inside(windows)) for condition, windows in _branches(trade_date, rules)])


def session_windows(trade_date: Column, rules: SessionRules) -> Column:
    """Windows of a date as ``array<struct<start_second, end_second>>``."""

    def literal(windows: tuple[Hours, ...]) -> Column:
        return F.array(
            *(
                F.struct(
                    F.lit(w.first_second).alias("start_second"),
                    F.lit(w.last_second).alias("end_second"),
                )
                for w in windows
            )
        )

    return _case([(condition, literal(windows)) for condition, windows in _branches(trade_date, rules)])
