"""Daily partial results, kept from run to run.

A lookback of weeks would be read again by every run although only its last day is new.  Here
every day is counted once: rows per event type, and rows per parameter and state.  A window or a
lookback is then the sum of its days, and a run scans only the days that are not stored yet.

A day is stored when it lies wholly before the reference time; the running day is counted anew
each time.  Rows that arrive for a day after it was stored are not seen until it is counted
again (``recount`` days back).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventgauge.functions import values as V
from eventgauge.functions.windows import Windows, time_literal
from eventgauge.operators import parameters
from eventgauge.operators.events import with_expected_rows
from eventgauge.settings import Settings
from eventgauge.sources.events import EventSource, measurable, united
from eventgauge.sources.kept import kept
from eventgauge.sources.versions import Conflict, VersionedTable


def whole_days(windows: Windows) -> dict[str, tuple[date, date]]:
    """First day and the day after the last one, of window and lookback.

    Only windows that begin and end at midnight are sums of days.
    """
    spans = {"window": windows.measurement_bounds, "lookback": windows.lookback_bounds}
    if windows.is_aligned or any(b.time() != time.min for span in spans.values() for b in span):
        raise ValueError("daily results answer for whole days only")
    return {name: (low.date(), high.date()) for name, (low, high) in spans.items()}


def within_days(span: tuple[date, date], column: str = "day") -> Column:
    return (F.col(column) >= F.lit(span[0])) & (F.col(column) < F.lit(span[1]))


def since_day(sources: Sequence[EventSource], first: date | None) -> list[EventSource]:
    """The sources from a day on; the bound is a literal on the measured column."""
    if first is None:
        return list(sources)
    out = []
    for source in sources:
        if source.measured_by is not None:
            kind = source.frame.schema[source.measured_by].dataType
            start = time_literal(datetime.combine(first, time.min), kind)
            source = replace(source, frame=source.frame.filter(F.col(source.measured_by) >= start))
        out.append(source)
    return out


def daily_rows(sources: Sequence[EventSource], windows: Windows, first: date | None = None) -> DataFrame:
    """``event_table, day, n_rows`` from one narrow scan of both windows."""
    parts = []
    for source in measurable(since_day(sources, first)):
        day = F.col(source.measured_by or "").cast("date").alias("day")
        rows = source.within(windows, "scope")
        parts.append(rows.select(source.event_table.alias("event_table"), day))
    return united(parts).groupBy("event_table", "day").agg(F.count(F.lit(1)).alias("n_rows"))


def volume_of(days: DataFrame, windows: Windows) -> DataFrame:
    """``operators.events.volume`` as a sum of days."""
    spans = whole_days(windows)
    counted = days.groupBy("event_table").agg(
        V.sum_or_zero(F.when(within_days(spans["window"]), F.col("n_rows"))).alias("rows_in_range"),
        V.sum_or_zero(F.when(within_days(spans["lookback"]), F.col("n_rows"))).alias("lookback_rows"),
    )
    return with_expected_rows(counted.filter("rows_in_range + lookback_rows > 0"), windows)


def daily_states(
    sources: Sequence[EventSource],
    rules: Mapping[int, Sequence[parameters.Rule]],
    windows: Windows,
    settings: Settings,
    first: date | None = None,
) -> DataFrame:
    """``source, event_table, parameter, day, state, n_rows``, states packed as in a run."""
    recent = since_day(sources, first)
    return parameters.state_counts(recent, rules, windows, settings, day=True).groupBy(
        "source", "event_table", "parameter", "day", "state"
    ).agg(F.sum("n_rows").alias("n_rows"))


def parameter_metrics_of(days: DataFrame, windows: Windows) -> DataFrame:
    """``operators.parameters.parameter_metrics`` as a sum of days."""
    spans = whole_days(windows)
    rows = days.withColumns(
        {f"in_{name}": within_days(span) for name, span in spans.items()}
    )
    return parameters.metrics_of_states(rows)


@dataclass(frozen=True)
class History:
    """A stored frame of daily results with a ``day`` column."""

    store: VersionedTable

    def first_new_day(self, stored: DataFrame | None, recount: int = 0) -> date | None:
        if stored is None:
            return None
        last = stored.agg(F.max("day")).first()[0]
        return None if last is None else last + timedelta(days=1 - recount)

    def extended(self, windows: Windows, counted, recount: int = 0) -> DataFrame:
        """Stored days and new ones; ``counted(first)`` gives the days from one day on.

        Stored days of the scope that lie before those already there are not looked for: a
        longer lookback needs a new store.  Whole days of the result are stored.
        """
        while True:
            version = self.store.current()
            stored = self.store.read(version)
            first = self.first_new_day(stored, recount)
            fresh = kept(counted(first))
            days = fresh
            if stored is not None:
                days = stored.filter(F.col("day") < F.lit(first)).unionByName(fresh)
            whole = days.filter(F.col("day") < F.lit(windows.reference.date()))
            grown = fresh.filter(F.col("day") < F.lit(windows.reference.date()))
            try:
                if stored is None or not grown.isEmpty():
                    self.store.write(whole, version)
                return days
            except Conflict:
                continue
