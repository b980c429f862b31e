"""Parameters of a run: zone, session hours, limits, source column names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, time
from typing import Any

TIMESTAMP_FORMATS = ("auto", "epoch_s", "epoch_ms", "iso", "naive_local", "naive_utc")
SOURCE_FORMATS = ("sqlite", "csv")
FILE_LAYOUTS = ("one_per_day", "single_file", "one_per_symbol")

# Exchange closures known for October 2025 to July 2026.
DEFAULT_HOLIDAYS = (
    (date(2025, 10, 27), "Eid Milad-un-Nabi (Rabi-ul-Awal 12)"),
    (date(2025, 11, 9), "Allama Iqbal Day"),
    (date(2025, 12, 25), "Quaid-e-Azam Day / Christmas"),
    (date(2026, 2, 5), "Kashmir Day"),
    (date(2026, 3, 23), "Pakistan Day"),
    (date(2026, 5, 1), "Labour Day"),
    (date(2026, 6, 28), "Eid ul-Adha (estimated, Day 1)"),
    (date(2026, 6, 29), "Eid ul-Adha (estimated, Day 2)"),
    (date(2026, 6, 30), "Eid ul-Adha (estimated, Day 3)"),
)

# Weekday names as written in configuration files, Monday first.
WEEKDAY_NAMES = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")


@dataclass(frozen=True)
class Hours:
    """One trading window of a day, both ends inclusive, to the minute."""

    opens: time
    closes: time

    @property
    def first_second(self) -> int:
        return self.opens.hour * 3600 + self.opens.minute * 60

    @property
    def last_second(self) -> int:
        return self.closes.hour * 3600 + self.closes.minute * 60


@dataclass(frozen=True)
class DatedHours:
    """Hours that replace the regular ones from ``first`` to ``last``, inclusive."""

    first: date
    last: date
    hours: Hours


@dataclass(frozen=True)
class SessionRules:
    """Friday windows win over dated hours, dated hours over the regular ones."""

    regular: Hours = Hours(time(9, 30), time(15, 30))
    weekdays: tuple[int, ...] = (0, 1, 2, 3, 4)  # Monday is 0
    friday: tuple[Hours, ...] = (
        Hours(time(9, 15), time(12, 0)),
        Hours(time(14, 0), time(16, 30)),
    )
    overrides: tuple[DatedHours, ...] = ()
    overrides_apply_on_friday: bool = False


@dataclass(frozen=True)
class Limits:
    spike_pct: float = 0.20
    min_session_minutes: int = 60
    min_symbol_minutes: int = 10
    # Band of distinct minutes that a full day has; None sets no upper end.
    min_day_minutes: int = 60
    max_session_minutes: int | None = None
    gap_seconds: int = 7200
    # Whether the time between two windows of a session counts as a part of a gap.
    gaps_count_breaks: bool = True
    # Days kept before the first and after the last date in the file names; None keeps all.
    stale_days_before: int | None = 7
    stale_days_after: int | None = 1
    # Width of the time slices that spread one symbol-day over many tasks.
    slice_seconds: int = 1

    def __post_init__(self) -> None:
        if self.slice_seconds < 1 or 60 % self.slice_seconds:
            raise ValueError("slice_seconds must divide 60")


@dataclass(frozen=True)
class SourceColumns:
    """Names of the four tick fields in the raw files."""

    symbol: str = "symbol"
    price: str = "price"
    volume: str = "volume"
    timestamp: str = "time"


@dataclass(frozen=True)
class Settings:
    timezone: str = "Asia/Karachi"
    session: SessionRules = field(default_factory=SessionRules)
    limits: Limits = field(default_factory=Limits)
    columns: SourceColumns = field(default_factory=SourceColumns)
    timestamp_format: str = "naive_utc"
    source_format: str = "sqlite"
    # Other layouts than one file per day are gathered by day before archiving.
    file_layout: str = "one_per_day"
    sqlite_table: str = "intraday_data"
    file_glob: str | None = None

    def __post_init__(self) -> None:
        if self.timestamp_format not in TIMESTAMP_FORMATS:
            raise ValueError(f"timestamp_format must be one of {TIMESTAMP_FORMATS}, got {self.timestamp_format!r}")
        if self.source_format not in SOURCE_FORMATS:
            raise ValueError(f"source_format must be one of {SOURCE_FORMATS}, got {self.source_format!r}")
        if self.file_layout not in FILE_LAYOUTS:
            raise ValueError(f"file_layout must be one of {FILE_LAYOUTS}, got {self.file_layout!r}")

    @property
    def glob(self) -> str:
        return self.file_glob or {"sqlite": "*.db", "csv": "*.csv"}[self.source_format]

    @classmethod
    def from_mapping(cls, cfg: Mapping[str, Any], **extra: Any) -> "Settings":
        """Build settings from the nested mapping of a configuration file."""

        def clock(text: str) -> time:
            return time.fromisoformat(text if len(text.split(":")[0]) == 2 else f"0{text}")

        def hours(row: Mapping[str, Any]) -> Hours:
            return Hours(clock(row["start"]), clock(row["end"]))

        def day(value: Any) -> date:
            return value if isinstance(value, date) else date.fromisoformat(value)

        session, limits, names = cfg["session"], cfg.get("thresholds", {}), cfg.get("columns", {})
        return cls(
            timezone=cfg.get("timezone", cls.timezone),
            session=SessionRules(
                regular=hours(session),
                weekdays=tuple(WEEKDAY_NAMES.index(d[:3].lower()) for d in session.get("days", WEEKDAY_NAMES[:5])),
                friday=tuple(hours(w) for w in session.get("friday") or ()),
                overrides=tuple(
                    DatedHours(day(o["from"]), day(o["to"]), hours(o)) for o in session.get("overrides") or ()
                ),
            ),
            limits=Limits(**{k: v for k, v in limits.items() if k in Limits.__dataclass_fields__}),
            columns=SourceColumns(**{k: v for k, v in names.items() if k in SourceColumns.__dataclass_fields__}),
            timestamp_format=cfg.get("timestamp_format", cls.timestamp_format),
            source_format=cfg.get("source_format", cls.source_format),
            file_layout=cfg.get("file_layout", cls.file_layout),
            **extra,
        )
