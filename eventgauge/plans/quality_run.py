"""One complete quality run over a set of event tables.

``run`` declares all result frames.  Results with one row per table, parameter or
event that several others read are computed once, see ``kept``; everything else runs
when it is written or read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventgauge.functions.windows import Windows
from eventgauge.operators import contracts, drilldown, findings, flow, parameters, status
from eventgauge.operators import events as E
from eventgauge.settings import Settings
from eventgauge.sources import payloads as payload_tables
from eventgauge.sources.artifacts import write_run
from eventgauge.sources.catalog import (
    catalog_entries,
    select_event_tables,
    shared_sources,
    table_inventory,
)
from eventgauge.sources.events import (
    EventSource,
    canonical_events,
    event_times,
    table_columns,
    table_profiles,
    without_blacklisted,
)
from eventgauge.sources.kept import kept
from eventgauge.sources.names import merged_names, seen_names, stopped_names
from eventgauge.sources.versions import Conflict, VersionedTable


def prepare_session(spark: SparkSession) -> SparkSession:
    """Session settings the expressions rely on.

    Day and hour arithmetic is done in UTC, and a payload that repeats a key is still
    valid JSON.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def windows_of(settings: Settings, reference: Any = None) -> Windows:
    config = settings.config
    return Windows.of(config.get("date_range"), config.get("lookback"), reference)


def special_tables(settings: Settings, contract: Mapping[str, Any] | None) -> list[str]:
    named = set(settings.table_parameters) | set((contract or {}).get("events", {}))
    named |= set(settings.tables_where_missing_is_allowed("main_id"))
    named |= set(settings.tables_where_missing_is_allowed("session_id"))
    return sorted(named)


def run(
    spark: SparkSession,
    sources: Sequence[EventSource],
    settings: Settings,
    reference: Any = None,
    raw: DataFrame | None = None,
    dead_letters: Mapping[str, DataFrame] | None = None,
    contract: Mapping[str, Any] | None = None,
    known: DataFrame | None = None,
    not_scanned: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All result frames of a run by name.

    ``known`` has the names of earlier runs (``sources.names``), so event types that stopped
    before the lookback are judged too; ``event_names`` is what the next run should be given.
    ``not_scanned`` names tables that a limit left out: coverage is then incomplete.
    """
    prepare_session(spark)
    windows = windows_of(settings, reference)
    seen = kept(seen_names(sources, windows))
    names = seen if known is None else kept(merged_names(known, seen))
    events = without_blacklisted(canonical_events(sources, settings, windows), settings)
    times = without_blacklisted(event_times(sources, windows), settings)
    profiles = kept(without_blacklisted(table_profiles(sources, settings, windows, names), settings))

    metrics = kept(E.event_metrics(events, times, profiles, windows, settings))
    event_status = status.event_status(metrics, settings)
    scan = status.scan_problems(
        status.problem_signal(metrics.withColumn("rows_total", F.col("rows_in_range")), settings),
        settings,
    )
    out = {
        "event_quality": event_status,
        "scan": scan,
        "classified": status.classified_findings(metrics, settings),
        "event_names": names,
        "stopped_event_tables": without_blacklisted(stopped_names(names, seen), settings),
        "coverage": status.coverage(profiles, not_scanned),
    }

    of_contract = contracts.contract_rules(contract, settings) if contract else None
    special = special_tables(settings, contract)
    rules = {
        i: parameters.source_rules(s, settings, of_contract, special)
        for i, s in enumerate(sources)
    }
    counted = parameters.parameter_metrics(sources, rules, windows, settings)
    parameter_status = kept(
        without_blacklisted(
            parameters.parameter_status(
                counted,
                parameters.rules_frame(spark, rules),
                profiles,
                settings,
            ),
            settings,
        )
    )
    limit = settings.parameter_defaults["top_values_limit"]
    observed = kept(
        parameters.top_value_lists(
            parameters.top_values(
                parameters.value_histogram(sources, rules, windows, settings), limit
            )
        )
    )
    out["parameter_quality"] = parameter_status
    observed = parameters.observed_parameters(parameter_status, observed)
    out["parameter_values"] = observed
    if contract is None:
        out["inferred_contract"] = contracts.inferred_contract(
            without_blacklisted(table_columns(sources, windows, names), settings), observed, settings
        )
    out["parameter_problem_groups"] = findings.problem_groups(parameter_status)
    out["unpopulated_columns"] = findings.unpopulated_groups(parameter_status)

    document = contracts.contract_frame(spark, contract) if contract else None
    flows = origins = None
    if raw is not None:
        wanted = settings.flow
        source = payload_tables.parsed(
            payload_tables.PayloadTable(wanted["raw_table"], raw), windows
        )
        source = without_blacklisted(source, settings)
        found, missing = payload_tables.known_tables(dead_letters or {}, wanted["dlq_tables"])
        # One parse of each payload; values are kept for events the contract does not know.
        described = sorted((contract or {}).get("events", {}))
        fresh = ~F.col("event_table").isin(described) if contract else None
        facts = kept(flow.payload_facts(source, settings, fresh))
        summary = flow.summary_of(facts)
        out["source_summary"] = summary
        out["source_modes"] = flow.modes_of(facts)
        if found:
            letters = without_blacklisted(
                payload_tables.parsed_dead_letters(found, windows), settings
            )
            letter_facts = kept(flow.letter_facts(letters))
            rejected = flow.dlq_summary_of(letter_facts)
            out["dlq_errors"] = flow.dlq_errors_of(letter_facts)
        else:
            rejected = spark.createDataFrame(
                [], "event_table string, dlq_source_table string, dlq_shape string, dlq_rows long"
            )
        out["dlq_summary"] = rejected
        out["dlq_tables_missing"] = spark.createDataFrame(
            [(name,) for name in missing], "dlq_table string"
        )
        flows = kept(flow.reconcile(metrics, summary, rejected, settings))
        pairs = kept(flow.parameter_pairs(parameter_status, document, settings))
        presence = flow.presence_of(facts, settings)
        origins = kept(flow.parameter_origin(pairs, presence, summary, settings))
        out["event_flow"] = flows
        out["parameter_pairs"] = pairs
        out["parameter_origin"] = origins
        out["flow_summary"] = flow.flow_summary(flows, summary, rejected, origins)
        if document is not None:
            out["contract_additions"] = contracts.contract_additions(
                document, summary, flow.contract_of(facts), settings
            )

    candidates = kept(drilldown.candidates(metrics, settings))
    tables = kept(drilldown.chosen_tables(metrics, event_status, settings))
    duplicates = drilldown.duplicate_samples(events, tables)
    seconds = drilldown.burst_groups(events, settings.burst_threshold, tables)
    missing_ids = kept(
        drilldown.missing_id_counts(events, settings.drilldown["missing_id_tables"])
    )
    out["drilldown_candidates"] = candidates
    out["sample_summary"] = drilldown.sample_summary(events, settings.burst_threshold, settings)
    out["drilldown_tables"] = tables
    out["skipped_tables"] = status.skipped_tables(profiles)
    out["base_counts"] = E.base_counts(events)
    out["day_counts"] = E.day_counts(events, windows)
    out["duplicate_samples"] = duplicates
    for name in ("burst_samples", "burst_labels"):
        found = getattr(drilldown, name)
        out[name] = found(events, settings.burst_threshold, groups=seconds)
    out["missing_ids_by_step"] = drilldown.missing_ids_by_step(events, counts=missing_ids)
    if settings.future_check_enabled:
        out["future_samples"] = drilldown.future_samples(
            times, windows, settings.future_tolerance_minutes
        )
    out["findings"] = findings.findings_report(
        event_status, parameter_status, scan, missing_ids, settings, flows, origins
    )
    out["short_report"] = findings.short_report(out["findings"])
    out["run_summary"] = findings.run_summary(scan, event_status, parameter_status)
    return out


def run_and_write(
    spark: SparkSession,
    root: str,
    run_id: str,
    fmt: str = "parquet",
    state: str | None = None,
    **arguments: Any,
) -> dict[str, str]:
    """Declare a run, write all of its frames under a folder and commit it.

    ``state`` is a folder kept from run to run: it holds the names of all event types seen,
    and the contract, if one was stored there and none is given.  New events are appended to
    that contract; if it was edited while the run went on, ``Conflict`` is raised after the
    run has been committed, and the edit stays.
    """
    if state is None:
        return write_run(run(spark, **arguments), root, run_id, fmt)
    names = VersionedTable(spark, f"{state}/event_names")
    agreed = VersionedTable(spark, f"{state}/contract")
    version = agreed.current()
    if version and arguments.get("contract") is None:
        arguments["contract"] = contracts.contract_document(agreed.read(version).collect())
    else:
        version = 0
    out = run(spark, known=names.read(), **arguments)
    written = write_run(out, root, run_id, fmt)
    remember(names, out["event_names"])
    if version and "contract_additions" in out:
        contracts.written_back(agreed, version, out["contract_additions"])
    return written


def remember(store: VersionedTable, names: DataFrame) -> int:
    """Merge names into the stored ones; two runs that end together both get theirs in."""
    while True:
        version = store.current()
        try:
            return store.write(merged_names(store.read(version), names), version)
        except Conflict:
            continue


def run_catalog(
    spark: SparkSession,
    database: str,
    settings: Settings,
    limit: int | None = None,
    mandatory: Sequence[str] = (),
    **arguments: Any,
) -> dict[str, DataFrame]:
    """A run over the tables of a catalogue database, from its name alone.

    Also gives the ``inventory``.  Tables that a limit leaves out are listed in ``coverage``.
    """
    entries = catalog_entries(spark, database, settings, mandatory)
    inventory = kept(table_inventory(spark, entries, settings, mandatory=mandatory))
    # One number a table, for the order in which they are taken.
    sizes = {
        row.table_name: row.estimated_rows
        for row in inventory.filter("measurement_time_column is not null")
        .select("table_name", "estimated_rows").collect()
        if row.table_name in {entry.name for entry in entries if entry.is_stored}
    }
    selection = select_event_tables(sizes, settings, limit)
    sources = shared_sources(entries, selection.chosen)
    out = run(spark, sources, settings, not_scanned=selection.not_scanned, **arguments)
    return {"inventory": inventory, **out}
