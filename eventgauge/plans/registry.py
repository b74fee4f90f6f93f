"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventgauge.functions import payload as P
from eventgauge.functions import redact
from eventgauge.functions import values as V
from eventgauge.functions.windows import Windows
from eventgauge.operators import contracts, drilldown, findings, flow, history, parameters, status
from eventgauge.operators import events as E
from eventgauge.plans import sample_views as views
from eventgauge.plans.quality_run import prepare_session, special_tables
from eventgauge.settings import AUTO_EXCLUDED_COLUMNS, Settings
from eventgauge.sources import names
from eventgauge.sources import payloads as payload_tables
from eventgauge.sources.catalog import TableEntry, table_inventory
from eventgauge.sources.events import (
    EventSource,
    canonical_events,
    event_times,
    table_columns,
    table_profiles,
    without_blacklisted,
)
from eventgauge.sources.kept import kept

Query = Callable[[SparkSession, str], DataFrame]

CONFIG: dict[str, Any] = {
    "date_range": "2024-01-24 to 2024-01-30",
    "lookback": "14 days",
    "thresholds": {"missing_platform_pct": 0.05},
    "event_groups": {
        "same_second_allowed": {"tables": ["event_click", "event_purchase"]},
        "same_second_strict": {"tables": ["event_purchase"]},
        "missing_main_identifier_allowed": {"tables": ["event_signup"]},
    },
    "event_context": {
        "event_error": {"step_exceptions": {"0": {"skip_session_id_check": True}}},
        "event_view": {"skip_adid_check": True},
    },
    "parameter_quality": {
        "auto_discovery": {"exclude_columns": [*AUTO_EXCLUDED_COLUMNS, "event_id"]},
        "global_parameters": {
            "region": {"required_value": True, "allowed_pattern": "^[A-Z]{2}$"}
        },
        "tables": {
            "event_click": {
                "exclude_parameters": ["legacy_flag"],
                "parameters": {"step": {"min_value": 1, "max_value": 4}},
            }
        },
    },
    "drilldown": {"missing_id_tables": ["event_signup", "event_error"]},
}

CONTRACT: dict[str, Any] = {
    "schema_version": 3,
    "system_parameters": {
        "event_key": ["String", [], "extreme"],
        "session_id": ["String", [], "extreme"],
        "event_name": ["String", [], "high"],
    },
    "common_parameters": {
        "region": ["String", ["US"], "high"],
        "currency": ["String", ["EUR"], "low"],
    },
    "events": {
        "event_click": {
            "parameters": {
                "platform": ["String", ["ios"], "high"],
                "campaign": ["String", ["spring"], "normal"],
                "step": None,
            },
            "system_parameter_exceptions": ["event_name"],
        },
        "event_view": {"parameters": {}},
        "event_ghost": {"parameters": {"level": ["Int64", ["1"], "normal"]}},
        "event_raw_only": {"parameters": {}, "required": False},
    },
}

CONFIGURED_TABLES = ["event_view", "event_order", "event_absent"]
PLACE_RULE = {"allowed_pattern": "^([a-z]+|[A-Z]{2})$"}
REDACTED_PREVIEW = 180


def settings() -> Settings:
    return Settings(CONFIG)


def fixed() -> Windows:
    return Windows.of(CONFIG["date_range"], CONFIG["lookback"], "2024-01-31 00:00:00")


# ---------------------------------------------------------------------------
# Shared inputs
# ---------------------------------------------------------------------------
def order_source(spark: SparkSession, folder: str) -> EventSource:
    """Orders as an event table: other columns, no rows in the window."""
    frame = views.table(spark, folder, "orders").selectExpr(
        "o_orderdate as created_at",
        "cast(o_custkey as string) as adid",
        "o_orderstatus as status",
        "o_orderpriority as priority",
    )
    return EventSource(frame, name="event_order")


def shipment_source(spark: SparkSession, folder: str) -> EventSource:
    """Line items as an event table: every supplier ships many orders on a day."""
    frame = views.table(spark, folder, "lineitem").selectExpr(
        "l_shipdate as event_date",
        "cast(l_suppkey as string) as adid",
        "cast(l_orderkey as string) as event_key",
        "cast(l_partkey as string) as user_id",
        "l_returnflag as step",
        "l_linestatus as type",
    )
    return EventSource(frame, name="event_shipment")


def sources(spark: SparkSession, folder: str) -> list[EventSource]:
    return [views.event_source(spark, folder), order_source(spark, folder)]


def events(spark: SparkSession, folder: str) -> DataFrame:
    return canonical_events([views.event_source(spark, folder)], settings(), fixed())


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    tables = sources(spark, folder)
    return E.event_metrics(
        canonical_events(tables, settings(), fixed()),
        event_times(tables, fixed()),
        table_profiles(tables, settings(), fixed()),
        fixed(),
        settings(),
    )


def _with_total(frame: DataFrame) -> DataFrame:
    return frame.withColumn("rows_total", F.col("rows_in_range"))


def _parameter_parts(spark: SparkSession, folder: str) -> tuple[list, dict, list, Settings]:
    config, tables = settings(), sources(spark, folder)
    special = special_tables(config, None)
    rules = {
        i: parameters.source_rules(source, config, None, special)
        for i, source in enumerate(tables)
    }
    named = [source.name for source in tables if source.name]
    return tables, rules, sorted({*special, *named}), config


def _parameter_status(spark: SparkSession, folder: str) -> DataFrame:
    tables, rules, _, config = _parameter_parts(spark, folder)
    return parameters.parameter_status(
        parameters.parameter_metrics(tables, rules, fixed(), config),
        parameters.rules_frame(spark, rules),
        table_profiles(tables, config, fixed()),
        config,
    )


def _ranked_values(spark: SparkSession, folder: str) -> DataFrame:
    tables, rules, _, config = _parameter_parts(spark, folder)
    histogram = parameters.value_histogram(tables, rules, fixed(), config)
    return parameters.top_values(histogram, config.parameter_defaults["top_values_limit"])


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    return parameters.observed_parameters(
        _parameter_status(spark, folder),
        parameters.top_value_lists(_ranked_values(spark, folder)),
    )


def _source(spark: SparkSession, folder: str, windows: Windows | None = None) -> DataFrame:
    prepare_session(spark)
    table = payload_tables.PayloadTable("source_events", views.payload_view(spark, folder))
    return payload_tables.parsed(table, windows)


def _letters(spark: SparkSession, folder: str, windows: Windows | None = None) -> DataFrame:
    prepare_session(spark)
    found, _ = payload_tables.known_tables(
        {"source_events_dlq": views.dead_letter_view(spark, folder)},
        ["source_events_dlq", "partner_events_dlq"],
    )
    return payload_tables.parsed_dead_letters(found, windows)


def _contract(spark: SparkSession) -> DataFrame:
    return contracts.contract_frame(spark, CONTRACT)


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    """What is counted about the payloads of the window: computed once, parsed once."""
    known = sorted(CONTRACT["events"])
    source = _source(spark, folder, fixed())
    return kept(flow.payload_facts(source, settings(), ~F.col("event_table").isin(known)))


def _flows(
    spark: SparkSession,
    folder: str,
    measured: DataFrame | None = None,
    facts: DataFrame | None = None,
    letters: DataFrame | None = None,
) -> DataFrame:
    source = _source(spark, folder, fixed())
    return flow.reconcile(
        metrics(spark, folder) if measured is None else measured,
        flow.source_summary(source) if facts is None else flow.summary_of(facts),
        flow.dlq_summary(_letters(spark, folder, fixed())) if letters is None else letters,
        settings(),
    )


def _pairs(spark: SparkSession, folder: str, checked: DataFrame | None = None) -> DataFrame:
    found = _parameter_status(spark, folder) if checked is None else checked
    return flow.parameter_pairs(found, _contract(spark), settings())


def _origins(
    spark: SparkSession,
    folder: str,
    checked: DataFrame | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    counted = _facts(spark, folder) if facts is None else facts
    return flow.parameter_origin(
        _pairs(spark, folder, checked),
        flow.presence_of(counted, settings()),
        flow.summary_of(counted),
        settings(),
    )


def _additions(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder)
    return contracts.contract_additions(
        _contract(spark), flow.summary_of(facts), flow.contract_of(facts), settings()
    )


def _missing_ids(spark: SparkSession, folder: str) -> DataFrame:
    return drilldown.missing_id_counts(
        events(spark, folder), settings().drilldown["missing_id_tables"]
    )


def _scan(measured: DataFrame) -> DataFrame:
    return status.scan_problems(
        status.problem_signal(_with_total(measured), settings()), settings()
    )


# ---------------------------------------------------------------------------
# Presentation: plain scalar columns
# ---------------------------------------------------------------------------
def plain(frame: DataFrame, *columns: str, joiner: str = ",") -> DataFrame:
    """Chosen columns with arrays joined, times as text and whole numbers as long."""
    shown = []
    for name in columns or frame.columns:
        kind = frame.schema[name].dataType
        column = F.col(name)
        if isinstance(kind, T.ArrayType):
            column = F.array_join(column, joiner)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        shown.append(column.alias(name))
    return frame.select(*shown)


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
def q_canonical_events(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        events(spark, folder),
        "event_table", "event_time", "adid", "main_id", "session_id", "event_key", "step",
    )


def q_table_inventory(spark: SparkSession, folder: str) -> DataFrame:
    listed = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
    )
    entries = [TableEntry(name, views.table(spark, folder, name)) for name in listed]
    config = Settings({"database_profiles": {"p": {"main_identifier": "user_id"}},
                       "active_database_profile": "p"})
    inventory = table_inventory(
        spark, entries, config, mandatory=["events"], time_candidates=["ts", "o_orderdate"]
    )
    return plain(
        inventory,
        "table_name", "estimated_rows", "column_count", "columns", "measurement_time_column",
        "has_main_id", "has_adid", "is_mandatory",
    )


def q_blacklist_filter(spark: SparkSession, folder: str) -> DataFrame:
    config = Settings({"table_blacklist": ["EVENT_CL*", "event_e?ror"]})
    counted = views.event_view(spark, folder).groupBy("event_table").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return without_blacklisted(counted, config)


WINDOW_FORMS = (
    ("fixed", "2024-01-24..2024-01-30", "14 days", "2024-01-31 00:00:00"),
    ("rolling_days", "last 3 days", "14 days", "2024-01-28T12:30:00Z"),
    ("rolling_hours", "36h", "10 days", "2024-01-28T16:30:00+04:00"),
)
ALIGNED_FORMS = (
    ("afternoon", "2 hours", "28 days", "2024-01-30 18:00:00"),
    ("past_midnight", "2 hours", "28 days", "2024-01-30 00:30:00"),
)


def _window_counts(spark: SparkSession, folder: str, forms: tuple, span: str) -> DataFrame:
    parts = []
    for name, measured, lookback, reference in forms:
        windows = Windows.of(measured, lookback, reference)
        source = views.event_source(spark, folder, "created_at")
        rows = source.within(windows, span).groupBy("event_table").agg(
            F.count(F.lit(1)).alias("n_rows")
        )
        parts.append(rows.select(F.lit(name).alias("form"), "event_table", "n_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_window_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _window_counts(spark, folder, WINDOW_FORMS + ALIGNED_FORMS, "measurement")


def q_lookback_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _window_counts(spark, folder, WINDOW_FORMS, "lookback")


def q_aligned_lookback_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _window_counts(spark, folder, ALIGNED_FORMS, "lookback")


def q_normalized_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    names = ("adid", "user_id", "session_id", "session_uuid", "event_key")
    return views.event_view(spark, folder).select(
        "event_id", *[V.normalized(name).alias(name) for name in names]
    )


def q_identifier_alias_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    frame = views.event_view(spark, folder)
    session, found = V.first_present(settings().aliases("session_id"), frame.columns)
    absent, none = V.first_present(["device_id", "idfv"], frame.columns)
    return frame.select(
        "event_id",
        session.alias("session"),
        F.lit(",".join(found)).alias("session_columns"),
        absent.alias("device"),
        F.lit(",".join(none)).alias("device_columns"),
    )


def q_valid_first_alias(spark: SparkSession, folder: str) -> DataFrame:
    frame = views.event_view(spark, folder)
    invalid = settings().parameter_defaults["invalid_values"]
    place, _ = V.first_valid(["region", "platform"], frame.columns, PLACE_RULE, invalid)
    return frame.select(
        "event_id",
        place.alias("place"),
        F.coalesce(V.is_invalid(place, PLACE_RULE, invalid), F.lit(False)).alias("place_invalid"),
    )


def q_invalid_values(spark: SparkSession, folder: str) -> DataFrame:
    invalid = settings().parameter_defaults["invalid_values"]
    checks = {
        "region": {"allowed_pattern": "^[A-Z]{2}$"},
        "platform": {"allowed_values": "iOS, Android"},
        "event_key": {"min_value": 2, "max_value": 9.5},
        "client_version": {"min_value": 1},
        "session_id": {},
    }
    frame = views.event_view(spark, folder)
    return frame.select(
        "event_id",
        *[
            V.is_invalid(V.normalized(name), rule, invalid).alias(f"{name}_invalid")
            for name, rule in checks.items()
        ],
    )


def q_source_event_names(spark: SparkSession, folder: str) -> DataFrame:
    both = _source(spark, folder).unionByName(_letters(spark, folder))
    return both.groupBy("source_table", "event_table", "raw_type").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def q_json_validity(spark: SparkSession, folder: str) -> DataFrame:
    both = _source(spark, folder).unionByName(_letters(spark, folder))
    return both.groupBy("source_table", "valid").agg(F.count(F.lit(1)).alias("n_rows"))


def q_dlq_shapes(spark: SparkSession, folder: str) -> DataFrame:
    return flow.dead_letter_rows(_letters(spark, folder)).groupBy(
        "dlq_shape", "has_event_parameters"
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def q_payload_parameters(spark: SparkSession, folder: str) -> DataFrame:
    prepare_session(spark)
    frame = views.payload_view(spark, folder)
    wrapped = P.enclosed(F.col("payload"))
    rows = frame.select("row_id", wrapped.alias("wrapped")).select(
        "row_id", F.when(P.is_valid_json(F.col("wrapped")), F.col("wrapped")).alias("body")
    )
    held = rows.select(
        "row_id", F.explode(P.params_map(F.col("body"))).alias("parameter", "value")
    )
    return held.select("row_id", "parameter", P.raw_text(F.col("value")).alias("raw_value"))


def q_raw_parameter_types(spark: SparkSession, folder: str) -> DataFrame:
    return flow.raw_types(_source(spark, folder))


def q_redact_text(spark: SparkSession, folder: str) -> DataFrame:
    documents = views.table(spark, folder, "documents").select("doc_id", "text")
    return redact.redacted(documents, "text", limit=REDACTED_PREVIEW).drop("text")


def q_event_base_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return plain(E.base_counts(events(spark, folder)))


def q_today_yesterday_rows(spark: SparkSession, folder: str) -> DataFrame:
    windows = Windows.of("7 days", "14 days", "2024-01-29 12:00:00")
    rows = canonical_events([views.event_source(spark, folder)], settings(), windows)
    return E.day_counts(rows, windows)


def q_missing_with_step_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    counted = E.missing_identifiers(events(spark, folder), settings())
    return E.with_rates(counted).drop("min_event_time", "max_event_time")


def q_future_event_rows(spark: SparkSession, folder: str) -> DataFrame:
    windows = Windows.of("2 days", "14 days", "2024-01-28 12:00:00")
    times = event_times([views.event_source(spark, folder, "created_at")], windows)
    return plain(E.future_rows(times, windows, settings().future_tolerance_minutes))


def q_duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return E.duplicate_rows(events(spark, folder))


def q_replicated_rows(spark: SparkSession, folder: str) -> DataFrame:
    return E.replicated_rows(events(spark, folder))


def q_same_second_burst_rows(spark: SparkSession, folder: str) -> DataFrame:
    return E.burst_rows(events(spark, folder), settings().burst_threshold)


def shipment_windows() -> Windows:
    return Windows.of("1990-01-01 to 2005-12-31", "30 days", "2006-01-01")


def q_shipment_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    rows = canonical_events([shipment_source(spark, folder)], settings(), shipment_windows())
    return E.anomaly_counts(rows, settings().burst_threshold)


def q_burst_group_annotation(spark: SparkSession, folder: str) -> DataFrame:
    return plain(E.burst_annotation(events(spark, folder)))


def q_volume_vs_lookback(spark: SparkSession, folder: str) -> DataFrame:
    times = event_times([views.event_source(spark, folder)], fixed(), "scope")
    counted = E.volume(times, fixed())
    rounded = {
        name: F.round(name, 6)
        for name in ("expected_rows_from_lookback", "delta_vs_lookback_expected")
    }
    return counted.withColumns(rounded)


def q_rolling_volume(spark: SparkSession, folder: str) -> DataFrame:
    """Volume as a sum of days: those an earlier run counted, and the new ones alone."""
    tables, border = sources(spark, folder), date(2024, 1, 22)
    older = history.daily_rows(tables, fixed()).filter(F.col("day") < F.lit(border))
    newer = history.daily_rows(tables, fixed(), border)
    found = history.volume_of(older.unionByName(newer), fixed())
    return found.select(
        "event_table",
        "rows_in_range",
        "lookback_rows",
        F.round("expected_rows_from_lookback", 6).alias("expected_rows_from_lookback"),
        F.round("delta_vs_lookback_expected", 6).alias("delta_vs_lookback_expected"),
    )


def q_rolling_parameter_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Parameter metrics as a sum of days, the older ones counted by an earlier run."""
    (tables, rules, _, config), border = _parameter_parts(spark, folder), date(2024, 1, 22)
    older = history.daily_states(tables, rules, fixed(), config).filter(F.col("day") < F.lit(border))
    newer = history.daily_states(tables, rules, fixed(), config, border)
    return history.parameter_metrics_of(older.unionByName(newer), fixed()).drop("source")


def q_event_status(spark: SparkSession, folder: str) -> DataFrame:
    flagged = status.event_status(metrics(spark, folder), settings())
    flagged = flagged.withColumn(
        "delta_vs_lookback_expected", F.round("delta_vs_lookback_expected", 6)
    )
    return plain(
        flagged,
        "event_table", "status", "rows_in_range", "missing_adid_rows",
        "missing_main_identifier_rows", "missing_session_id_rows", "missing_event_key_rows",
        "duplicate_rows", "replicated_rows", "same_second_burst_rows", "lookback_rows",
        "missing_adid_pct", "missing_session_id_pct", "duplicate_pct", "replicated_pct",
        "same_second_burst_pct", "delta_vs_lookback_expected", "session_id_columns",
        "main_identifier_columns", "measurement_time_column",
    )


def q_stopped_event_types(spark: SparkSession, folder: str) -> DataFrame:
    """Event types of which an earlier run knew the name: sign-ups end before the lookback."""
    config, whole = settings(), views.event_source(spark, folder)
    rows = whole.frame.filter(
        "event_table <> 'event_signup' or created_at < timestamp_ntz'2024-01-08 00:00:00'"
    )
    source = replace(whole, frame=rows)
    before = replace(whole, frame=rows.filter("created_at < timestamp_ntz'2024-01-10 00:00:00'"))
    earlier = Windows.of("2024-01-03 to 2024-01-09", "2 days", "2024-01-10 00:00:00")
    seen = kept(names.seen_names([source], fixed()))
    known = kept(names.merged_names(names.seen_names([before], earlier), seen))
    measured = kept(
        E.event_metrics(
            canonical_events([source], config, fixed()),
            event_times([source], fixed()),
            table_profiles([source], config, fixed(), known),
            fixed(),
            config,
        )
    )
    flagged = status.event_status(measured, config)
    flows = _flows(spark, folder, measured).select(
        "event_table", F.array_join("status", ",").alias("flow_status")
    )
    gone = names.stopped_names(known, seen).select("event_table", F.lit(True).alias("stopped"))
    found = known.join(flagged, "event_table").join(flows, "event_table").join(gone, "event_table", "left")
    return found.select(
        "event_table",
        F.date_format("first_day", "yyyy-MM-dd").alias("first_day"),
        F.date_format("last_day", "yyyy-MM-dd").alias("last_day"),
        "rows_in_range",
        F.contains("status", F.lit(status.NO_ROWS)).alias("no_rows"),
        F.coalesce("stopped", F.lit(False)).alias("stopped"),
        "flow_status",
    )


def q_problem_signal(spark: SparkSession, folder: str) -> DataFrame:
    scored = status.problem_signal(_with_total(metrics(spark, folder)), settings())
    return scored.select("event_table", "problem_signal_rows", "problem_signal_pct")


def q_scan_problems(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        _scan(metrics(spark, folder)),
        "event_table", "scan_status", "problems", "schema_warnings", joiner="; ",
    )


def q_classified_findings(spark: SparkSession, folder: str) -> DataFrame:
    found = status.classified_findings(metrics(spark, folder), settings())
    return found.withColumn("value", F.round("value", 6))


def q_parameter_metrics(spark: SparkSession, folder: str) -> DataFrame:
    tables, rules, _, config = _parameter_parts(spark, folder)
    return parameters.parameter_metrics(tables, rules, fixed(), config).drop("source")


def q_parameter_top_values(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_ranked_values(spark, folder))


STATUS_COLUMNS = (
    "event_table", "parameter", "status", "problem", "source_columns", "rows_checked",
    "missing_rows", "invalid_rows", "lookback_rows_checked", "lookback_missing_rows",
    "missing_pct", "invalid_pct", "lookback_presence_pct", "expected_present_rows",
    "presence_delta_pct", "inferred_required", "report_priority",
)


def q_sketched_top_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the ten most frequent values, merged from sketches of single days.

    Parameters with more values than a sketch holds are counted.
    """
    tables, rules, _, config = _parameter_parts(spark, folder)
    days = kept(parameters.daily_value_sketches(tables, rules, fixed(), config))
    found = parameters.exact_top_values(
        days, tables, rules, fixed(), config, config.parameter_defaults["top_values_limit"]
    )
    return plain(found, "event_table", "parameter", "period", "rank", "value_rows")


def q_parameter_status(spark: SparkSession, folder: str) -> DataFrame:
    return _parameter_status(spark, folder).select(*STATUS_COLUMNS)


def q_parameters_of_several_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two long tables and a configured one of its own, each with other columns.

    Rules stay in the source that holds a table: one row per table and parameter of it.
    """
    seen, joined = views.event_view(spark, folder), F.col("event_table") == "event_signup"
    few = F.col("event_table").isin("event_click", "event_view")
    common = ("event_table", "created_at", "client_version")
    tables = [
        EventSource(seen.filter(few).select(*common, F.col("region").alias("alpha")), name_column="event_table"),
        EventSource(seen.filter(~few).select(*common, F.col("step").alias("beta")), name_column="event_table"),
        EventSource(seen.filter(joined).select("created_at", F.col("region").alias("gamma")), name="event_joined"),
    ]
    config = Settings(
        {"parameter_quality": {"tables": {"event_joined": {"parameters": {"gamma": {"min_value": 1}}}}}}
    )
    rules = {
        i: parameters.source_rules(source, config, None, special_tables(config, None))
        for i, source in enumerate(tables)
    }
    found = parameters.parameter_status(
        parameters.parameter_metrics(tables, rules, fixed(), config),
        parameters.rules_frame(spark, rules),
        table_profiles(tables, config, fixed()),
        config,
    )
    return found.select(
        "event_table", "parameter", "rows_checked", "missing_rows", "lookback_rows_checked"
    )


def q_prioritized_parameter_problems(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        findings.prioritized(_parameter_status(spark, folder)),
        "event_table", "parameter", "problem", "priority_rank", "contract_rank", "schema_rank",
        "missing_pct",
    )


def q_parameter_problem_groups(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        findings.problem_groups(_parameter_status(spark, folder)),
        "report_priority", "parameter", "problems", "affected_events", "max_missing_pct",
    )


def q_unpopulated_columns(spark: SparkSession, folder: str) -> DataFrame:
    return plain(findings.unpopulated_groups(_parameter_status(spark, folder)))


def q_source_event_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(flow.source_summary(_source(spark, folder)))


def q_source_modes(spark: SparkSession, folder: str) -> DataFrame:
    return flow.source_modes(_source(spark, folder))


def q_payload_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Types, presence and examples of one frame of facts, for the events outside the contract."""
    known = sorted(CONTRACT["events"])
    fresh = ~F.col("event_table").isin(known)
    facts = kept(flow.payload_facts(_source(spark, folder, fixed()), settings(), fresh))
    found = flow.types_of(facts).join(
        flow.presence_of(facts, settings()), ["event_table", "parameter"], "left"
    )
    examples = flow.contract_of(facts).drop("type")
    return plain(found.join(examples, ["event_table", "parameter"], "left"))


def q_dlq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(flow.dlq_summary(_letters(spark, folder)))


def q_dlq_validation_errors(spark: SparkSession, folder: str) -> DataFrame:
    return flow.dlq_errors(_letters(spark, folder))


def q_raw_parameter_profile(spark: SparkSession, folder: str) -> DataFrame:
    return plain(flow.raw_profile(_source(spark, folder)))


def q_raw_parameter_presence(spark: SparkSession, folder: str) -> DataFrame:
    return flow.raw_presence(_source(spark, folder), settings())


def q_event_flow_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_flows(spark, folder))


def q_parameter_problem_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder)


def q_parameter_origin(spark: SparkSession, folder: str) -> DataFrame:
    return _origins(spark, folder)


def q_flow_summary(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder)
    source = flow.summary_of(facts)
    letters = kept(flow.dlq_summary(_letters(spark, folder, fixed())))
    flows = kept(flow.reconcile(metrics(spark, folder), source, letters, settings()))
    origins = kept(_origins(spark, folder, facts=facts))
    return flow.flow_summary(flows, source, letters, origins)


def q_contract_types(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.common_types(table_columns(sources(spark, folder), fixed()), settings())


def q_parameter_scopes(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.parameter_scopes(_parameter_status(spark, folder), settings())


def q_inferred_contract(spark: SparkSession, folder: str) -> DataFrame:
    found = contracts.inferred_contract(
        table_columns(sources(spark, folder), fixed()), _observed(spark, folder), settings()
    )
    return plain(found, "scope", "event_table", "parameter", "type", "examples", "priority")


def q_contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.contract_violations(
        _contract(spark), table_columns(sources(spark, folder), fixed()), settings()
    )


def q_contract_additions(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_additions(spark, folder))


def q_contract_merge(spark: SparkSession, folder: str) -> DataFrame:
    return plain(contracts.merged_contract(_contract(spark), _additions(spark, folder)))


def q_missing_schema_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Event tables of which the raw source knows no parameters."""
    described = flow.events_with_parameters(_source(spark, folder))
    return contracts.missing_schema_tables(views.event_view(spark, folder), described)


def q_drilldown_candidates(spark: SparkSession, folder: str) -> DataFrame:
    found = drilldown.candidates(metrics(spark, folder), settings())
    return found.select("event_table", F.round("score", 6).alias("score"))


def q_drilldown_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The tables a run drills into: scored and flagged ones, as none is configured."""
    measured = kept(metrics(spark, folder))
    return drilldown.chosen_tables(
        measured, status.event_status(measured, settings()), settings()
    )


def q_configured_drilldown_tables(spark: SparkSession, folder: str) -> DataFrame:
    config = Settings(
        {**CONFIG, "drilldown": {**CONFIG["drilldown"], "tables": CONFIGURED_TABLES}}
    )
    measured = metrics(spark, folder)
    return drilldown.chosen_tables(measured, status.event_status(measured, config), config)


def q_flagged_tables(spark: SparkSession, folder: str) -> DataFrame:
    flagged = status.event_status(metrics(spark, folder), settings())
    return drilldown.flagged_tables(flagged, settings())


def q_duplicate_samples(spark: SparkSession, folder: str) -> DataFrame:
    return plain(drilldown.duplicate_samples(events(spark, folder)))


def q_burst_samples(spark: SparkSession, folder: str) -> DataFrame:
    return plain(drilldown.burst_samples(events(spark, folder), settings().burst_threshold))


def q_shipment_burst_samples(spark: SparkSession, folder: str) -> DataFrame:
    rows = canonical_events([shipment_source(spark, folder)], settings(), shipment_windows())
    return plain(drilldown.burst_samples(rows, settings().burst_threshold))


def q_burst_labels(spark: SparkSession, folder: str) -> DataFrame:
    return plain(drilldown.burst_labels(events(spark, folder), settings().burst_threshold))


def q_shipment_burst_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = canonical_events([shipment_source(spark, folder)], settings(), shipment_windows())
    return plain(drilldown.burst_labels(rows, settings().burst_threshold))


def q_missing_ids_by_step(spark: SparkSession, folder: str) -> DataFrame:
    counts = _missing_ids(spark, folder)
    return plain(drilldown.missing_ids_by_step(events(spark, folder), counts=counts))


def q_missing_id_expectation(spark: SparkSession, folder: str) -> DataFrame:
    return findings.missing_id_expectation(_missing_ids(spark, folder), settings())


def q_future_samples(spark: SparkSession, folder: str) -> DataFrame:
    windows = Windows.of("2 days", "14 days", "2024-01-28 12:00:00")
    times = event_times([views.event_source(spark, folder, "created_at")], windows)
    tolerance = settings().future_tolerance_minutes
    return plain(drilldown.future_samples(times, windows, tolerance))


def q_sample_summary(spark: SparkSession, folder: str) -> DataFrame:
    config = settings()
    return drilldown.sample_summary(events(spark, folder), config.burst_threshold, config)


def q_findings_report(spark: SparkSession, folder: str) -> DataFrame:
    measured = kept(metrics(spark, folder))
    checked = kept(_parameter_status(spark, folder))
    facts = _facts(spark, folder)
    report = findings.findings_report(
        status.event_status(measured, settings()),
        checked,
        _scan(measured),
        kept(_missing_ids(spark, folder)),
        settings(),
        kept(_flows(spark, folder, measured, facts)),
        kept(_origins(spark, folder, checked, facts)),
    )
    return plain(report.withColumn("value", F.round("value", 6)))


def q_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    measured = kept(metrics(spark, folder))
    return findings.run_summary(
        _scan(measured),
        status.event_status(measured, settings()),
        kept(_parameter_status(spark, folder)),
    )


def all_queries() -> dict[str, Query]:
    return {
        name.removeprefix("q_"): held
        for name, held in globals().items()
        if name.startswith("q_") and callable(held)
    }
