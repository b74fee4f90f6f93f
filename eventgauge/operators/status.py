"""Flags, scores and classes derived from metric frames (one row per table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventgauge.functions import values as V
from eventgauge.operators.events import CHECKS, RATES, raw_rows, raw_share
from eventgauge.settings import Settings

# ---------------------------------------------------------------------------
# Flag names and problem texts.
# ---------------------------------------------------------------------------
NO_ROWS = "no_rows_in_range"
RATE_FLAGS = (
    "missing_adid",
    "missing_main_identifier",
    "missing_session_id",
    "duplicate",
    "replicated",
    "same_second_burst",
)
HIGH, LOW = "suspicious_high", "suspicious_low"
SEVERITIES = ("critical", "low", "investigate")
# ---------------------------------------------------------------------------


def flags(*pairs: tuple[Column, str | Column]) -> Column:
    """The names of the conditions that hold, in order; NULL conditions do not."""
    named = [F.when(condition, F.lit(name) if isinstance(name, str) else name)
             for condition, name in pairs]
    return F.array_compact(F.array(*named))


def severity(flag_array: Column) -> Column:
    """The worst prefix among flags: critical, low, investigate or ok."""
    prefixes = F.transform(flag_array, lambda flag: F.split_part(flag, F.lit("_"), F.lit(1)))
    levels = [F.when(F.array_contains(prefixes, level), level) for level in SEVERITIES]
    return F.coalesce(*levels, F.lit("ok"))


def event_status(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Add ``status``: the flags of a table joined by a comma, or ``ok``.

    Shares are compared before rounding.
    """
    rows, delta = F.col("rows_in_range"), F.col("delta_vs_lookback_expected")
    pairs: list[tuple[Column, str | Column]] = [(rows == 0, NO_ROWS)]
    for name in RATE_FLAGS:
        share = V.ratio(F.col(RATES[name]), rows)
        pairs.append((share >= settings.threshold(f"{name}_pct"), f"{name}_high"))
    pairs.append((delta >= settings.threshold("suspicious_high_delta_pct"), HIGH))
    pairs.append((delta <= -settings.threshold("suspicious_low_delta_pct"), LOW))
    found = flags(*pairs)
    text = F.when(F.size(found) == 0, "ok").otherwise(F.array_join(found, ", "))
    return metrics.withColumn("status", text)


def problem_signal(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Add the number and share of rows that show any problem.

    Counts are taken as they are; only three of them are left out, for listed tables.
    """
    def counted(metric: str, allowed: list[str] | None = None) -> Column:
        value = F.coalesce(raw_rows(metrics, metric), F.lit(0).cast("long"))
        if not allowed:
            return value
        return F.when(V.any_table("event_table", allowed), F.lit(0).cast("long")).otherwise(value)

    total = (
        counted("future_event_time")
        + counted("duplicate")
        + counted("missing_adid")
        + counted("missing_main_identifier", settings.scan_skipped("main_id"))
        + counted("missing_session_id", settings.scan_skipped("session_id"))
        + counted("missing_event_key")
        + counted("same_second_burst", sorted(settings.same_second_allowed))
    )
    return metrics.withColumn("problem_signal_rows", total).withColumn(
        "problem_signal_pct", V.pct(F.col("problem_signal_rows"), F.col("rows_total"))
    )


def scan_problems(metrics: DataFrame, settings: Settings) -> DataFrame:
    """Add problem and schema-warning lists and the scan status.

    Needs the counts of ``event_metrics`` and its ``has_*`` columns.
    """
    def some(metric: str, allowed: list[str] | None = None) -> Column:
        found = raw_rows(metrics, metric) > 0
        return found & ~V.any_table("event_table", allowed) if allowed else found

    main_skipped = settings.scan_skipped("main_id")
    session_skipped = settings.scan_skipped("session_id")
    problems = flags(
        (F.col("rows_total") == 0, "No rows in selected period"),
        (some("duplicate"), "Duplicate event_time + adid + event_key rows found"),
        (
            some("same_second_burst", sorted(settings.same_second_allowed)),
            "Same-second event bursts found",
        ),
        (
            some("future_event_time"),
            F.concat(F.lit("Future "), F.col("measurement_time_column"), F.lit(" rows found")),
        ),
        (some("missing_adid"), "Missing adid rows found"),
        (
            some("missing_main_identifier", main_skipped),
            f"Missing {settings.main_identifier} rows found",
        ),
        (some("missing_session_id", session_skipped), "Missing session_id rows found"),
        (some("missing_event_key"), "Missing event_key rows found"),
    )
    accepted = {name: ", ".join(settings.aliases(name)) for name in ("main_id", "session_id")}
    warnings = flags(
        (~F.col("has_adid"), "Missing adid column"),
        (~F.col("has_event_key"), "Missing event_key column"),
        (
            ~F.col("has_main_id") & ~V.any_table("event_table", main_skipped),
            f"Missing main identifier column (accepted: {accepted['main_id']})",
        ),
        (
            ~F.col("has_session_id") & ~V.any_table("event_table", session_skipped),
            f"Missing session identifier column (accepted: {accepted['session_id']})",
        ),
    )
    out = metrics.withColumn("problems", problems).withColumn("schema_warnings", warnings)
    clean = (F.size("problems") == 0) & (F.size("schema_warnings") == 0)
    return out.withColumn("scan_status", F.when(clean, "ok").otherwise("problem"))


# ---------------------------------------------------------------------------
# Classes: confirmed, expected, investigate
# ---------------------------------------------------------------------------
def _finding(
    condition: Column,
    group: str | Column,
    issue: str,
    metric: str,
    value: Column,
    rows: Column,
    level: str = "normal",
) -> Column:
    return F.when(
        condition,
        F.struct(
            (F.lit(group) if isinstance(group, str) else group).alias("classification"),
            F.lit(issue).alias("issue"),
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
            rows.cast("long").alias("rows"),
            F.lit(level).alias("severity"),
        ),
    )


def classified_findings(metrics: DataFrame, settings: Settings) -> DataFrame:
    """One row per finding of a table, sorted into what it means.

    Volume is only judged against a baseline of enough expected rows; activity
    without such a baseline is reported as new.  Both directions are judged.  Missing
    identifiers and bursts are judged by all rows; what the configuration allows is
    then expected.
    """
    rows = F.col("rows_in_range")
    expected = F.col("expected_rows_from_lookback")
    delta = F.col("delta_vs_lookback_expected")
    nothing = F.lit(None)
    baseline = expected >= settings.threshold("suspicious_volume_min_expected_rows")
    has_baseline = F.coalesce(baseline, F.lit(False))

    found = [
        _finding(rows == 0, "confirmed", "no_rows", "rows_in_range", rows, rows, "critical")
    ]
    for name in ("duplicate", "replicated"):
        value = F.col(f"{name}_pct")
        limit = settings.threshold(f"{name}_pct")
        found.append(
            _finding(
                value >= limit, "confirmed", f"{name}_high", f"{name}_pct", value,
                F.col(RATES[name]),
            )
        )
    metric = "delta_vs_lookback_expected"
    too_high = delta >= settings.threshold("suspicious_high_delta_pct")
    too_low = delta <= -settings.threshold("suspicious_low_delta_pct")
    found += [
        _finding(has_baseline & too_high, "investigate", HIGH, metric, delta, rows),
        _finding(has_baseline & too_low, "investigate", LOW, metric, delta, rows),
        _finding(
            ~has_baseline & (rows >= settings.threshold("new_activity_min_rows")),
            "investigate", "new_activity", "expected_rows_from_lookback",
            F.coalesce(expected, F.lit(0.0)), rows,
        ),
    ]
    if settings.future_check_enabled:
        late = F.col("future_event_time_rows")
        found.append(
            _finding(
                late > 0, "confirmed", "future_event_time", "future_event_time_rows", late, late
            )
        )
    else:
        found.append(
            _finding(
                F.lit(True), "expected", "future_event_time_check_disabled",
                "future_event_time_rows", nothing, nothing,
            )
        )
    for name, check in CHECKS.values():
        missing = raw_rows(metrics, name)
        value = raw_share(metrics, name)
        allowed = V.any_table("event_table", settings.skipped_tables(check))
        found.append(
            _finding(
                value >= settings.threshold(f"{name}_pct"),
                F.when(allowed, "expected").otherwise("confirmed"),
                f"{name}_high", f"{name}_pct", value, missing,
            )
        )
    burst_rows = raw_rows(metrics, "same_second_burst")
    burst = raw_share(metrics, "same_second_burst")
    allowed = V.any_table("event_table", sorted(settings.same_second_allowed))
    found.append(
        _finding(
            burst >= settings.threshold("same_second_burst_pct"),
            F.when(allowed, "expected").otherwise("investigate"),
            "same_second_burst_high", "same_second_burst_pct", burst, burst_rows,
        )
    )
    exploded = metrics.select(
        "event_table", F.explode(F.array_compact(F.array(*found))).alias("finding")
    )
    return exploded.select("event_table", "finding.*")


def skipped_tables(profiles: DataFrame) -> DataFrame:
    """Tables that cannot be measured, as expected findings."""
    return profiles.filter(F.col("measurement_time_column").isNull()).select(
        "event_table",
        F.lit("expected").alias("classification"),
        F.lit("skipped_no_time_column").alias("issue"),
        F.lit("measurement_time_column").alias("metric"),
        F.lit(None).cast("double").alias("value"),
        F.lit(None).cast("long").alias("rows"),
        F.lit("normal").alias("severity"),
    )


def coverage(profiles: DataFrame, not_scanned: Sequence[str] = ()) -> DataFrame:
    """``event_table, state`` of every table that was to be measured, and whether all were.

    ``coverage_complete`` stands on every row, so one row answers it.
    """
    measured = F.col("measurement_time_column").isNotNull()
    own = profiles.groupBy("event_table").agg(F.bool_or(measured).alias("measured"))
    states = own.select(
        "event_table",
        F.when(F.col("measured"), "scanned").otherwise("no_time_column").alias("state"),
    )
    session = profiles.sparkSession
    left_out = session.createDataFrame([(t, "not_scanned") for t in not_scanned], states.schema)
    rows = states.join(left_out, "event_table", "left_anti").unionByName(left_out)
    return rows.withColumn("coverage_complete", F.lit(not not_scanned))
