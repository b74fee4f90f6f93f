"""Which event types have ever been seen, kept from run to run.

A scan reads no further back than the lookback, so a type that stopped before it would leave
no trace.  The names that every run sees are merged into a stored frame with the first and
last day of each; the names a scan does not find are then known without reading history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.functions.windows import Windows
from eventgauge.sources.events import EventSource, measurable, united

SCHEMA = "source string, event_table string, first_day date, last_day date"


def seen_names(sources: Sequence[EventSource], windows: Windows) -> DataFrame:
    """``source, event_table, first_day, last_day`` of all rows since the lookback began.

    One narrow scan with a map-side combine.  A source that stands for one table is listed
    even without rows, with null days.
    """
    parts = []
    for source in measurable(sources):
        day = F.col(source.measured_by or "").cast("date")
        named = source.event_table.alias("event_table")
        rows = source.within(windows, "since_lookback").select(named, day.alias("day"))
        rows = rows.filter("event_table is not null")
        counted = rows.groupBy("event_table").agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day")
        )
        listed = [*source.tables] if source.name is None else [source.name]
        if listed:
            session = source.frame.sparkSession
            known = session.createDataFrame([(name,) for name in listed], "event_table string")
            counted = known.join(counted, "event_table", "full_outer")
        parts.append(counted.select(F.lit(source.label).alias("source"), "event_table", "first_day", "last_day"))
    return united(parts)


def merged_names(stored: DataFrame | None, seen: DataFrame) -> DataFrame:
    """All names known so far; a name keeps its first day and moves its last one."""
    rows = seen if stored is None else stored.select(*seen.columns).unionByName(seen)
    return rows.groupBy("source", "event_table").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )


def stopped_names(known: DataFrame, seen: DataFrame) -> DataFrame:
    """Known names of which the current scan found no row."""
    present = seen.filter("last_day is not null").select("source", "event_table")
    return known.join(present, ["source", "event_table"], "left_anti")
