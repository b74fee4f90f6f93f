"""Data-quality measurement for event tables, written as PySpark DataFrame jobs."""

from eventgauge.functions.windows import TimeRange, Windows, parse_lookback, parse_range
from eventgauge.settings import Settings
from eventgauge.sources.events import EventSource

__all__ = [
    "EventSource",
    "Settings",
    "TimeRange",
    "Windows",
    "parse_lookback",
    "parse_range",
]
