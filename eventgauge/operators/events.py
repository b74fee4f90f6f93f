"""Metrics per event table over the measurement window and its lookback.

Input frames are those of ``sources.events``: ``canonical_events`` (one row per
event of the window, identifiers normalised) and ``event_times`` (table and time).
Every aggregation starts with a map-side combine on its own keys, so a table, an
identifier or a timestamp that holds a large share of all rows arrives at the
shuffle already reduced.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventgauge.functions import values as V
from eventgauge.functions.windows import Windows, between
from eventgauge.operators.ranks import ranked
from eventgauge.settings import Settings

CHECKS = {
    "adid": ("missing_adid", "skip_adid_check"),
    "main_id": ("missing_main_identifier", "skip_main_identifier_check"),
    "session_id": ("missing_session_id", "skip_session_id_check"),
    "event_key": ("missing_event_key", "skip_event_key_check"),
}
GROUP = ("event_table", "event_time", "adid", "event_key")
SECOND = ("event_table", "event_time", "adid")


def base_counts(events: DataFrame) -> DataFrame:
    """Rows, first and last event time, and rows without each identifier."""
    return events.groupBy("event_table").agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"),
        *[
            F.count_if(F.col(column).isNull()).alias(f"{metric}_rows")
            for column, (metric, _) in CHECKS.items()
        ],
    )


def day_counts(events: DataFrame, windows: Windows) -> DataFrame:
    """Rows of the reference day and of the day before, inside the window."""
    today = datetime.combine(windows.reference.date(), datetime.min.time())
    day, kind = timedelta(days=1), events.schema["event_time"].dataType
    time = F.col("event_time")
    return events.groupBy("event_table").agg(
        F.count_if(between(time, today, today + day, kind)).alias("rows_today"),
        F.count_if(between(time, today - day, today, kind)).alias("rows_yesterday"),
    )


def _exempt(settings: Settings, check: str) -> Column:
    """Rows a configured step exception keeps out of a missing count.

    A row without a step cannot be shown to lie outside the excepted steps and is
    kept out too, but only in tables that have exceptions for this check.
    """
    excepted = F.lit(False)
    for table, steps in settings.step_exceptions(check).items():
        step = F.col("step")
        of_table = (F.col("event_table") == table) & F.col("has_step")
        excepted = excepted | (of_table & (step.isNull() | step.isin(steps)))
    return excepted


def missing_identifiers(events: DataFrame, settings: Settings) -> DataFrame:
    """Rows without each identifier, with configured exceptions taken out.

    A check that is switched off for a table yields NULL, not zero.  The ``raw_``
    columns beside them count every row, whatever the configuration excepts.
    """
    counts = []
    for column, (metric, check) in CHECKS.items():
        missing = F.col(column).isNull()
        counts.append(F.count_if(missing & ~_exempt(settings, check)).alias(f"{metric}_rows"))
        counts.append(F.count_if(missing).alias(f"raw_{metric}_rows"))
    counted = events.groupBy("event_table").agg(
        F.count(F.lit(1)).alias("rows_in_range"),
        F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"),
        *counts,
    )
    return counted.withColumns(
        {
            f"{metric}_rows": F.when(
                ~V.any_table("event_table", settings.skipped_tables(check)),
                F.col(f"{metric}_rows"),
            )
            for metric, check in CHECKS.values()
        }
    )


def future_rows(times: DataFrame, windows: Windows, tolerance_minutes: int) -> DataFrame:
    """Rows later than the reference time plus a tolerance, in any window."""
    late = times.filter(windows.after_reference(times, "event_time", tolerance_minutes))
    return late.groupBy("event_table").agg(
        F.count(F.lit(1)).alias("future_event_time_rows"),
        F.max("event_time").alias("max_future_event_time"),
    )


def _keyed(events: DataFrame) -> DataFrame:
    return events.filter(F.col("adid").isNotNull() & F.col("event_key").isNotNull())


def event_groups(events: DataFrame) -> DataFrame:
    """Rows per (table, time, adid, key), where adid and key are both present."""
    return _keyed(events).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_rows"))


def duplicate_rows(events: DataFrame) -> DataFrame:
    """Rows beyond the first of each (time, adid, key)."""
    return event_groups(events).groupBy("event_table").agg(
        V.sum_or_zero(F.col("group_rows") - 1).alias("duplicate_rows")
    )


def replicated_rows(events: DataFrame) -> DataFrame:
    """Distinct (time, adid, key) beyond the first of each key.

    Counting keys goes through groups of (table, key), not a distinct inside the
    table group, so that no task holds all keys of one table.
    """
    keys = event_groups(events).groupBy("event_table", "event_key").agg(
        F.count(F.lit(1)).alias("groups")
    )
    return keys.groupBy("event_table").agg(
        V.sum_or_zero(F.col("groups") - 1).alias("replicated_rows")
    )


def _seconds(groups: DataFrame) -> DataFrame:
    return groups.groupBy(*SECOND).agg(
        F.sum("group_rows").alias("rows_in_second"),
        F.count(F.lit(1)).alias("unique_event_keys"),
    )


def burst_rows(events: DataFrame, threshold: int) -> DataFrame:
    """Rows of each (time, adid) that shows more than ``threshold`` keys."""
    burst = F.when(F.col("unique_event_keys") > threshold, F.col("rows_in_second"))
    return _seconds(event_groups(events)).groupBy("event_table").agg(
        V.sum_or_zero(burst).alias("same_second_burst_rows")
    )


def anomaly_counts(events: DataFrame, threshold: int) -> DataFrame:
    """Duplicates, replicated rows and bursts, each from groups of its own size.

    The (time, adid, key) groups are counted per (time, adid) and from there per table.  The
    distinct keys of a table come from a narrow scan of their own: they are far fewer than
    the groups, and a task that counts groups need not hold each of them once more by its key.
    """
    seconds = _seconds(event_groups(events))
    keys = _keyed(events).select("event_table", "event_key").distinct()
    n_rows, n_groups = F.col("rows_in_second"), F.col("unique_event_keys")
    parts = seconds.groupBy("event_table").agg(
        F.sum(n_rows - n_groups).alias("duplicate_rows"),
        F.sum(n_groups).alias("replicated_rows"),
        V.sum_or_zero(F.when(n_groups > threshold, n_rows)).alias("same_second_burst_rows"),
    )
    zero = F.lit(0).cast("long")
    repeated = keys.groupBy("event_table").agg(
        zero.alias("duplicate_rows"),
        (-F.count(F.lit(1))).alias("replicated_rows"),
        zero.alias("same_second_burst_rows"),
    )
    counts = ("duplicate_rows", "replicated_rows", "same_second_burst_rows")
    return parts.unionByName(repeated).groupBy("event_table").agg(
        *[V.sum_or_zero(F.col(name)).alias(name) for name in counts]
    )


def burst_annotation(events: DataFrame) -> DataFrame:
    """Every (time, adid, key) group with the totals of its second and its number in it.

    One busy second can hold most groups, so numbers and totals come from sorted parts of
    seconds (``ranks``), not from a window or a join on the second.
    """
    numbered = ranked(
        event_groups(events),
        SECOND,
        ["event_key"],
        "row_number",
        {"rows_in_second": F.col("group_rows"), "unique_event_keys": F.lit(1)},
    )
    return numbered.select(
        *GROUP,
        "group_rows",
        "rows_in_second",
        "unique_event_keys",
        "row_number",
        (F.col("row_number") == 1).alias("is_first_key"),
    )


def volume(times: DataFrame, windows: Windows) -> DataFrame:
    """Rows in the window against rows expected from the lookback, in one scan."""
    counted = times.groupBy("event_table").agg(
        F.count_if(windows.in_measurement(times, "event_time")).alias("rows_in_range"),
        F.count_if(windows.in_lookback(times, "event_time")).alias("lookback_rows"),
    )
    return with_expected_rows(counted, windows)


def with_expected_rows(counted: DataFrame, windows: Windows) -> DataFrame:
    expected = F.col("lookback_rows") / F.lit(windows.comparison_windows)
    delta = F.when(
        F.col("expected_rows_from_lookback") > 0,
        V.ratio(
            F.col("rows_in_range") - F.col("expected_rows_from_lookback"),
            F.col("expected_rows_from_lookback"),
        ),
    )
    return counted.withColumn("expected_rows_from_lookback", expected).withColumn(
        "delta_vs_lookback_expected", delta
    )


def history_counts(times: DataFrame, windows: Windows, settings: Settings) -> DataFrame:
    """Lookback rows and future rows from one narrow scan."""
    late = windows.after_reference(times, "event_time", settings.future_tolerance_minutes)
    if not settings.future_check_enabled:
        late = F.lit(False)
    return times.groupBy("event_table").agg(
        F.count_if(windows.in_lookback(times, "event_time")).alias("lookback_rows"),
        F.count_if(late).alias("future_event_time_rows"),
        F.max(F.when(late, F.col("event_time"))).alias("max_future_event_time"),
    )


RATES = {
    "missing_adid": "missing_adid_rows",
    "missing_main_identifier": "missing_main_identifier_rows",
    "missing_session_id": "missing_session_id_rows",
    "missing_event_key": "missing_event_key_rows",
    "duplicate": "duplicate_rows",
    "replicated": "replicated_rows",
    "same_second_burst": "same_second_burst_rows",
}
#: Metrics that configured exceptions change.
EXCEPTED = (*(metric for metric, _ in CHECKS.values()), "same_second_burst")


def raw_rows(metrics: DataFrame, metric: str) -> Column:
    """The count of a metric before exceptions; frames without exceptions have one count."""
    raw = f"raw_{metric}_rows"
    return F.col(raw if raw in metrics.columns else f"{metric}_rows")


def raw_share(metrics: DataFrame, metric: str) -> Column:
    """The share of a metric before exceptions; frames without exceptions have one share."""
    if f"raw_{metric}_rows" in metrics.columns:
        return V.pct(raw_rows(metrics, metric), F.col("rows_in_range"))
    return F.col(f"{metric}_pct")


def with_rates(metrics: DataFrame, rows: str = "rows_in_range") -> DataFrame:
    """A ``<metric>_pct`` share for every counted metric that is present."""
    return metrics.withColumns(
        {
            f"{name}_pct": V.pct(F.col(column), F.col(rows))
            for name, column in RATES.items()
            if column in metrics.columns
        }
    )


def one_profile(profiles: DataFrame) -> DataFrame:
    """One row per event table: what several sources of one table can have is put together."""
    listed = ("measurement_time_column", "session_id_columns", "main_identifier_columns")
    flags = [c for c in profiles.columns if c.startswith("has_")]
    names = [F.array_join(F.array_sort(F.collect_set(F.nullif(c, F.lit("")))), ",").alias(c) for c in listed]
    grouped = profiles.groupBy("event_table", "main_identifier").agg(
        *[F.bool_or(c).alias(c) for c in flags], *names
    )
    time = F.nullif("measurement_time_column", F.lit(""))
    return grouped.withColumn("measurement_time_column", time)


def event_metrics(
    events: DataFrame,
    times: DataFrame,
    profiles: DataFrame,
    windows: Windows,
    settings: Settings,
) -> DataFrame:
    """All event metrics, one row per known table, also for tables without rows.

    Three scans: identifiers of the window for missing counts, the same narrow
    columns for anomalies, and table and time alone for history.  What is joined are
    results with one row per table; adaptive execution broadcasts them when their
    measured size allows.
    """
    missing = missing_identifiers(events, settings)
    anomalies = anomaly_counts(events, settings.burst_threshold)
    history = history_counts(times, windows, settings)
    joined = one_profile(profiles)
    for part in (missing, anomalies, history):
        joined = joined.join(part, "event_table", "left")

    zero = F.lit(0).cast("long")
    counts = {
        name: F.coalesce(F.col(name), zero)
        for name in ("rows_in_range", "lookback_rows", "future_event_time_rows")
    }
    for column, (metric, check) in CHECKS.items():
        off = V.any_table("event_table", settings.skipped_tables(check))
        counts[f"{metric}_rows"] = F.when(
            F.col(f"has_{column}") & ~off, F.coalesce(F.col(f"{metric}_rows"), zero)
        )
        raw = f"raw_{metric}_rows"
        counts[raw] = F.when(F.col(f"has_{column}"), F.coalesce(F.col(raw), zero))
    comparable = F.col("has_adid") & F.col("has_event_key")
    for name in ("duplicate_rows", "replicated_rows"):
        counts[name] = F.when(comparable, F.coalesce(F.col(name), zero))
    bursts_off = V.any_table(
        "event_table", settings.skipped_tables("skip_suspicious_same_second_check")
    )
    counts["raw_same_second_burst_rows"] = F.when(
        comparable, F.coalesce(F.col("same_second_burst_rows"), zero)
    )
    counts["same_second_burst_rows"] = F.when(
        comparable & ~bursts_off, F.coalesce(F.col("same_second_burst_rows"), zero)
    )
    described = joined.withColumns(counts).withColumns(
        {
            "measurement_period": F.lit(windows.measured.description),
            "lookback_description": F.lit(windows.lookback.description),
        }
    )
    return with_rates(with_expected_rows(described, windows))
