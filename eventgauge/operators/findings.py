"""The findings of a run, ordered inside the sections of a report.

Inputs are metric frames: one row per table, parameter or sample.  All findings are kept;
``short_report`` takes the first ones of each section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventgauge.functions import values as V
from eventgauge.operators.flow import DIAGNOSES, counters, priority_rank
from eventgauge.operators.ranks import ranked
from eventgauge.operators.status import HIGH, LOW, NO_ROWS
from eventgauge.settings import Settings
from eventgauge.sources.events import united
from eventgauge.sources.kept import kept

# ---------------------------------------------------------------------------
# Sections in report order with the rows each may show.
# ---------------------------------------------------------------------------
SECTIONS = (
    ("critical_delivery", 100),
    ("low_delivery", 100),
    ("system_parameters", 25),
    ("value_parameters", 25),
    ("confirmed", 25),
    ("expected", 12),
    ("investigate", 20),
)
UNPOPULATED_PREVIEW = 12
# ---------------------------------------------------------------------------


def _urgency(status: DataFrame) -> DataFrame:
    problem = F.coalesce(F.col("problem"), F.lit(""))
    share = F.coalesce(F.col("missing_pct"), F.lit(0.0))
    return status.filter(F.col("status").isin("problem", "error")).withColumns(
        {
            "priority_rank": priority_rank(),
            "contract_rank": F.when(F.col("profile_schema_parameter"), 0).otherwise(1),
            "schema_rank": F.when(problem.rlike("missing_event|missing_column"), 0).otherwise(1),
            "missing_rank": -share,
        }
    )


URGENCY = (
    "priority_rank", "contract_rank", "schema_rank", "missing_rank", "event_table", "parameter",
)


def prioritized(status: DataFrame) -> DataFrame:
    """Parameter problems, most urgent first."""
    return _urgency(status).orderBy(*URGENCY)


def problem_groups(status: DataFrame, limit: int | None = None) -> DataFrame:
    """Problems of one parameter across tables: their names and affected events.

    Groups are ordered by their most urgent member.  Problem names come from a fixed
    vocabulary, so the gathered set is small whatever the number of tables.
    """
    names = F.split(F.coalesce(F.col("problem"), F.lit("")), ",")
    grouped = (
        _urgency(status)
        .groupBy("priority_rank", "report_priority", "parameter")
        .agg(
            F.array_join(
                F.sort_array(F.array_distinct(F.flatten(F.collect_set(names)))), ","
            ).alias("problems"),
            F.count(F.lit(1)).alias("affected_events"),
            F.min(F.struct(*URGENCY)).alias("urgency"),
            F.min("event_table").alias("first_table"),
            F.max("missing_pct").alias("max_missing_pct"),
        )
    )
    top = grouped.orderBy("urgency")
    return top if limit is None else top.limit(limit)


def unpopulated_groups(status: DataFrame) -> DataFrame:
    """Per table, how many columns never hold a value, with a short preview."""
    empty = status.filter(F.array_contains(F.split("problem", ","), "unpopulated_column"))
    order = W.partitionBy("event_table").orderBy("parameter")
    ranked = empty.withColumn("n", F.row_number().over(order))
    shown = F.when(F.col("n") <= UNPOPULATED_PREVIEW, F.col("parameter"))
    return ranked.groupBy("event_table").agg(
        F.count(F.lit(1)).alias("columns_unpopulated"),
        F.array_join(F.sort_array(F.collect_list(shown)), ", ").alias("preview"),
        F.greatest(F.count(F.lit(1)) - UNPOPULATED_PREVIEW, F.lit(0)).alias("not_shown"),
    )


def missing_id_expectation(rows: DataFrame, settings: Settings) -> DataFrame:
    """Whether missing identifiers per step are allowed; each identifier on its own."""
    found = []
    for name, column in (
        ("main_id", "missing_main_identifier_pct"),
        ("session_id", "missing_session_id_pct"),
    ):
        allowed = V.any_table("event_table", settings.tables_where_missing_is_allowed(name))
        label = settings.main_identifier if name == "main_id" else "session identifier"
        entry = F.struct(
            F.lit(label).alias("identifier"),
            F.when(allowed, "expected").otherwise("unexpected").alias("expectation"),
            F.col(column).alias("missing_pct"),
        )
        found.append(F.when(F.col(column) > 0, entry))
    return rows.select(
        "event_table", "step", "type", "rows_in_range", F.inline(F.array_compact(F.array(*found)))
    )


def run_summary(metrics: DataFrame, status: DataFrame, parameters: DataFrame) -> DataFrame:
    """Counters over the metric frames of a run."""
    problem = F.col("status") == "problem"
    return united(
        [
            counters(
                metrics,
                tables_checked=F.count(F.lit(1)),
                problem_tables=F.count_if(F.col("scan_status") == "problem"),
                rows_in_range=V.sum_or_zero(F.col("rows_in_range")),
            ),
            counters(
                status,
                flagged_tables=F.count_if(F.col("status") != "ok"),
                tables_without_rows=F.count_if(F.col("status").contains(NO_ROWS)),
            ),
            counters(
                parameters,
                parameters_checked=F.count(F.lit(1)),
                parameter_problems=F.count_if(problem),
            ),
        ]
    )


# ---------------------------------------------------------------------------
# Sections
# ---------------------------------------------------------------------------
def _entry(
    section: str | Column,
    source_rank: int,
    order: Column | int,
    issue: str | Column,
    metric: str,
    value: Column,
    rows: Column,
    level: str | Column = "normal",
    parameter: str | Column | None = None,
    step: Column | None = None,
    only: Column | None = None,
) -> Column:
    """One finding as a struct, NULL where its condition does not hold."""
    def column(item: str | int | Column | None) -> Column:
        return item if isinstance(item, Column) else F.lit(item)

    entry = F.struct(
        column(section).alias("section"),
        F.lit(source_rank).alias("source_rank"),
        column(order).cast("double").alias("order_key"),
        column(parameter).cast("string").alias("parameter"),
        column(step).cast("string").alias("step"),
        column(issue).alias("issue"),
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        rows.cast("long").alias("rows"),
        column(level).alias("severity"),
    )
    return entry if only is None else F.when(only, entry)


def _findings(frame: DataFrame, *entries: Column) -> DataFrame:
    """All findings of each row of a frame, from one pass over it."""
    found = F.inline(F.array_compact(F.array(*entries)))
    return frame.select("event_table", found)


def _event_findings(event_status: DataFrame) -> DataFrame:
    """Findings from event status; ``explained`` marks tables with flow evidence."""
    rows, flagged = F.col("rows_in_range"), F.split("status", ", ")

    def rate(section: str, source_rank: int, order: int, metric: str, label: str | None) -> Column:
        return _entry(
            section, source_rank, order, f"{metric}_high", f"{metric}_pct",
            F.col(f"{metric}_pct"), rows, parameter=label,
            only=F.array_contains(flagged, f"{metric}_high"),
        )

    entries = [
        rate("system_parameters", 3, 0, "missing_adid", "adid"),
        _entry(
            "system_parameters", 3, 1, "missing_main_identifier_high",
            "missing_main_identifier_pct", F.col("missing_main_identifier_pct"), rows,
            parameter=F.col("main_identifier"),
            only=F.array_contains(flagged, "missing_main_identifier_high"),
        ),
        rate("system_parameters", 3, 2, "missing_session_id", "session identifier"),
        rate("confirmed", 1, 0, "duplicate", None),
        rate("confirmed", 1, 1, "replicated", None),
        rate("investigate", 1, 0, "same_second_burst", None),
    ]
    for flag in (HIGH, LOW):
        entries.append(
            _entry(
                "investigate", 2, 0, flag, "delta_vs_lookback_expected",
                F.col("delta_vs_lookback_expected"), rows, only=F.array_contains(flagged, flag),
            )
        )
    entries.append(
        _entry(
            "investigate", 3, 0, "no_rows_unclassified", "rows_in_range", F.lit(None), rows,
            only=F.array_contains(flagged, NO_ROWS) & ~F.col("explained"),
        )
    )
    return _findings(event_status, *entries)


def findings_report(
    event_status: DataFrame,
    parameter_status: DataFrame,
    scan: DataFrame,
    missing_ids: DataFrame,
    settings: Settings,
    flows: DataFrame | None = None,
    origins: DataFrame | None = None,
) -> DataFrame:
    """All findings by section, numbered inside their section; ``short_report`` cuts them.

    A table without rows is only classified when flow evidence exists for it.  Every
    input is read a few times: pass results that have been kept.
    """
    rows, zero = F.col("rows_in_range"), F.lit(0).cast("long")
    parts: list[DataFrame] = []
    delivery = F.concat(F.col("severity"), F.lit("_delivery"))
    known = event_status.withColumn("explained", F.lit(False))
    if flows is not None:
        severe = flows.filter(F.col("severity").isin("critical", "low"))
        mark = severe.select("event_table", F.lit(True).alias("explained"))
        known = event_status.join(mark, "event_table", "left").withColumn(
            "explained", F.coalesce("explained", F.lit(False))
        )
        parts.append(
            _findings(
                severe,
                _entry(
                    delivery, 1, 0, F.array_join("status", ","), "raw_rows", F.col("raw_rows"),
                    F.coalesce(F.col("parsed_rows"), zero), F.col("severity"),
                ),
            )
        )
    parts.append(_event_findings(known))
    if origins is not None:
        traced = origins.filter(
            F.col("diagnosis").isin(DIAGNOSES["parser"][0], DIAGNOSES["payload"][0])
        )
        place = F.when(F.col("scope") == "system", "system_parameters").otherwise(
            "value_parameters"
        )
        parts.append(
            _findings(
                traced,
                *[
                    _entry(
                        section, 2, priority_rank(), F.col("diagnosis"), "raw_presence_pct",
                        F.col("raw_presence_pct"), F.col("raw_rows"), F.col("severity"),
                        parameter=F.col("parameter"),
                    )
                    for section in (delivery, place)
                ],
            )
        )
    # One row per parameter with a problem, which is the size of a schema, not of the data.
    groups = problem_groups(parameter_status).withColumn(
        "position", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("urgency"))
    )
    parts.append(
        _findings(
            groups.withColumnRenamed("first_table", "event_table"),
            _entry(
                "value_parameters", 4, F.col("position"), F.col("problems"), "missing_pct",
                F.col("max_missing_pct"), F.col("affected_events"), F.col("report_priority"),
                parameter=F.col("parameter"),
            ),
        )
    )
    late = F.col("future_event_time_rows")
    future = scan.filter(late > 0)
    parts.append(
        _findings(
            future,
            _entry("confirmed", 2, -late, "future_event_time", "future_event_time_rows", late, rows),
        )
    )
    warned = scan.filter(F.size("schema_warnings") > 0)
    parts.append(
        _findings(
            warned,
            _entry(
                "confirmed", 3, 0, F.array_join("schema_warnings", "; "), "schema_warnings",
                F.size("schema_warnings"), rows,
            ),
        )
    )
    expected = F.col("expectation") == "expected"
    parts.append(
        _findings(
            missing_id_expectation(missing_ids, settings),
            _entry(
                F.when(expected, "expected").otherwise("investigate"), 9, -rows,
                F.concat(F.col("expectation"), F.lit("_missing_identifier")), "missing_pct",
                F.col("missing_pct"), rows, parameter=F.col("identifier"), step=F.col("step"),
            ),
        )
    )
    return sectioned(united(parts))


def sectioned(findings: DataFrame) -> DataFrame:
    """Number findings inside their section; a section can be as long as the data has steps."""
    order = ["source_rank", "order_key", "event_table", "parameter", "step", "issue"]
    # Kept, as sorting samples its input first: the sections would be put together twice.
    numbered = ranked(kept(findings), ["section"], order)
    places = F.create_map(
        *[F.lit(p) for i, (name, _) in enumerate(SECTIONS, start=1) for p in (name, i)]
    )
    return numbered.withColumn("section_order", places[F.col("section")]).drop(
        "source_rank", "order_key"
    )


def short_report(findings: DataFrame) -> DataFrame:
    """The first findings of each section, as many as a reader is shown."""
    caps = F.create_map(*[F.lit(part) for section in SECTIONS for part in section])
    return findings.filter(F.col("rank") <= caps[F.col("section")])
