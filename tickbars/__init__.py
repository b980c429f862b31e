"""Trade ticks to validated one-minute bars, expressed as Spark DataFrames."""

from tickbars.settings import DatedHours, Hours, Limits, SessionRules, Settings, SourceColumns

__all__ = ["DatedHours", "Hours", "Limits", "SessionRules", "Settings", "SourceColumns"]
