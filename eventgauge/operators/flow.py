"""From raw payloads and dead letters to parsed tables: what got lost, and where."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventgauge.functions import payload as P
from eventgauge.functions import values as V
from eventgauge.operators import contracts
from eventgauge.operators.status import flags, severity
from eventgauge.settings import PRIORITY_RANKS, Settings
from eventgauge.sources.events import united

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------
PRESENT_SHARE = 0.99
DIAGNOSES = {
    "excluded": (
        "source_comparison_not_applicable",
        "investigate_source_comparison_not_applicable",
        "investigate",
    ),
    "no_rows": (
        "no_source_rows_for_parameter_check",
        "investigate_no_source_rows_for_parameter_check",
        "investigate",
    ),
    "parser": (
        "likely_parser_or_column_mapping_issue",
        "low_target_parameter_missing_but_raw_present",
        "low",
    ),
    "payload": (
        "source_payload_parameter_missing",
        "critical_parameter_missing_in_raw_and_target",
        "critical",
    ),
    "ok": ("source_parameter_present", "ok", "ok"),
}
# ---------------------------------------------------------------------------


# ---------------------------------------------------------------------------
# Payload summaries
# ---------------------------------------------------------------------------
FACT_KEYS = ("event_table", "raw_type", "mode", "parameter", "kind", "filled", "value")


def payload_facts(
    payloads: DataFrame, settings: Settings, examples: Column | None = None
) -> DataFrame:
    """All that is counted about payloads, from one parse of each.

    A payload gives one row for each key of its ``params`` object and one without a key if it
    has none; the first row of a payload also stands for the payload itself.  They are counted
    by ``FACT_KEYS`` with a map-side combine, so what is shuffled has the size of a schema.
    ``value`` is null except for events that ``examples`` (a condition on ``event_table``)
    names: only their distinct values are kept.
    """
    body = F.col("body")
    session = F.lit(False)
    for alias in settings.aliases("session_id"):
        value = P.at(body, "params", alias)
        session = session | (value.isNotNull() & P.is_filled(value))
    wanted = F.lit(False) if examples is None else examples
    rows = payloads.select(
        "event_table", "raw_type", "mode",
        (~F.col("valid")).alias("invalid"),
        (F.col("valid") & P.lacks_params(body)).alias("lacking"),
        F.when(F.col("valid"), session).otherwise(False).alias("in_session"),
        F.posexplode_outer(P.params_map(body)).alias("place", "parameter", "held"),
    )
    filled = F.col("held").isNotNull() & P.is_filled(F.col("held"))
    described = rows.select(
        "event_table", "raw_type", "mode", "invalid", "lacking", "in_session", "parameter",
        (F.coalesce("place", F.lit(0)) == 0).alias("first"),
        # Without what a nested value holds: few texts, which are told apart after counting.
        F.substring_index(F.schema_of_variant("held"), "<", 1).alias("schema"),
        filled.alias("filled"),
        F.when(wanted, P.raw_text(F.col("held"))).alias("value"),
    )
    first = F.col("first")
    counted = described.groupBy(*["schema" if key == "kind" else key for key in FACT_KEYS]).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(first).alias("n_rows"),
        F.count_if(first & F.col("invalid")).alias("n_invalid"),
        F.count_if(first & F.col("lacking")).alias("n_lacking"),
        F.count_if(first & F.col("in_session")).alias("n_session"),
    )
    return counted.withColumn("kind", P.value_kind(F.col("schema"), F.col("filled"))).drop("schema")


def _modes() -> Column:
    """The distinct filled modes, sorted, from rows with one mode each."""
    return F.sort_array(F.collect_set(F.nullif("mode", F.lit("")))).alias("modes")


def summary_of(facts: DataFrame) -> DataFrame:
    """Modes, rows, invalid rows and rows without parameters per event name, from ``payload_facts``."""
    modes = facts.groupBy("event_table", "mode").agg(
        F.min("raw_type").alias("raw_type"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_invalid", "n_lacking")],
    )
    return modes.groupBy("event_table").agg(
        F.min("raw_type").alias("source_type"),
        _modes(),
        F.count_if(F.col("mode") != "").alias("n_modes"),
        F.sum("n_rows").alias("raw_rows"),
        F.sum("n_invalid").alias("invalid_json_rows"),
        F.sum("n_lacking").alias("missing_params_object_rows"),
    )


def modes_of(facts: DataFrame) -> DataFrame:
    """Every mode of every event with its payload rows."""
    counted = facts.groupBy("event_table", "mode").agg(F.sum("n_rows").alias("raw_rows"))
    return counted.filter("mode <> ''")


def types_of(facts: DataFrame) -> DataFrame:
    """The type of each payload parameter, from all its values."""
    kinds = ("bool", "int", "float", "other")
    counted = facts.filter("parameter <> ''").groupBy("event_table", "parameter").agg(
        F.sum("n_keys").alias("raw_rows"),
        V.sum_or_zero(F.when(F.col("kind").isNotNull(), F.col("n_keys"))).alias("typed_rows"),
        *[F.bool_or(F.coalesce(F.col("kind") == k, F.lit(False))).alias(f"{k}_seen") for k in kinds],
    )
    seen = {k: F.col(f"{k}_seen") for k in kinds}
    return counted.select(
        "event_table", "parameter", P.merged_type(seen).alias("type"), "raw_rows", "typed_rows"
    )


def presence_of(facts: DataFrame, settings: Settings) -> DataFrame:
    """Payload rows with a filled value of each parameter; session aliases count once a row."""
    session = settings.aliases("session_id")
    keys = facts.filter((F.col("parameter") != "") & F.col("filled"))
    keys = keys.filter(~F.col("parameter").isin(session))
    own = keys.select("event_table", "parameter", F.col("n_keys").alias("n"))
    pooled = facts.filter("n_session > 0").select(
        "event_table", F.lit("session_id").alias("parameter"), F.col("n_session").alias("n")
    )
    grouped = own.unionByName(pooled).groupBy("event_table", "parameter")
    return grouped.agg(F.sum("n").alias("raw_present_rows"))


def profile_of(facts: DataFrame) -> DataFrame:
    """Up to five distinct raw values per event and parameter, of events whose values are kept."""
    values = facts.filter("parameter <> '' and value is not null")
    return _first_values(values.select("event_table", "parameter", "value").distinct())


def contract_of(facts: DataFrame) -> DataFrame:
    """Type and examples of each parameter of the events whose values are kept."""
    return _with_examples(types_of(facts.filter("value is not null")), profile_of(facts))


def source_summary(payloads: DataFrame) -> DataFrame:
    """Modes, rows, invalid rows and rows without parameters per event name.

    Rows are first counted per (event, written type, mode), which needs only hash
    aggregation; the text minimum and the set of modes are taken over those counts.
    """
    lacking = F.col("valid") & P.lacks_params(F.col("body"))
    return summary_of(
        payloads.groupBy("event_table", "raw_type", "mode").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~F.col("valid")).alias("n_invalid"),
            F.count_if(lacking).alias("n_lacking"),
        )
    )


def source_modes(payloads: DataFrame) -> DataFrame:
    counted = payloads.groupBy("event_table", "mode").agg(F.count(F.lit(1)).alias("n_rows"))
    return modes_of(counted)


def dead_letter_rows(letters: DataFrame) -> DataFrame:
    """Shape and rejection details of every dead-letter row."""
    body, valid = F.col("body"), F.col("valid")
    cut = letters.withColumns(
        {
            "name_value": P.at(body, "event", "name"),
            "rejected_value": P.at(body, "rejectedAt"),
        }
    )
    return cut.select(
        "event_table",
        F.col("source_table").alias("dlq_source_table"),
        "mode",
        P.dlq_shape(valid, body).alias("dlq_shape"),
        P.filled_text(F.col("name_value")).alias("source_event_name"),
        P.has(body, "event", "parameters").alias("has_event_parameters"),
        P.filled_text(F.col("rejected_value")).alias("rejected_at"),
        P.texts_at(body, "validationErrors").alias("validation_errors"),
    )


LETTER_KEYS = ("event_table", "dlq_source_table", "dlq_shape")


def letter_facts(letters: DataFrame) -> DataFrame:
    """All that is counted about dead letters, from one parse of each.

    A letter gives one row for each distinct validation error and one without an error if it
    has none; its first row also stands for the letter.
    """
    rows = dead_letter_rows(letters).select(
        *LETTER_KEYS, "mode", "source_event_name", "has_event_parameters", "rejected_at",
        F.size("validation_errors").alias("n_errors"),
        F.posexplode_outer(F.array_distinct("validation_errors")).alias("place", "validation_error"),
    )
    first = F.coalesce("place", F.lit(0)) == 0
    return rows.groupBy(*LETTER_KEYS, "mode", "validation_error").agg(
        F.count(F.lit(1)).alias("n_letters"),
        F.count_if(first).alias("n_rows"),
        F.count_if(first & F.col("has_event_parameters")).alias("n_parameters"),
        V.sum_or_zero(F.when(first, F.col("n_errors"))).alias("n_errors"),
        F.min("source_event_name").alias("source_event_name"),
        F.min("rejected_at").alias("rejected_at_min"),
        F.max("rejected_at").alias("rejected_at_max"),
    )


def dlq_summary_of(facts: DataFrame) -> DataFrame:
    """Rejected rows and modes per event, dead-letter table and shape, from ``letter_facts``."""
    empty = F.lit("")
    modes = facts.groupBy(*LETTER_KEYS, "mode").agg(
        *[F.min(c).alias(c) for c in ("source_event_name", "rejected_at_min")],
        F.max("rejected_at_max").alias("rejected_at_max"),
        *[F.sum(c).alias(c) for c in ("n_rows", "n_parameters", "n_errors")],
    )
    return modes.groupBy(*LETTER_KEYS).agg(
        F.coalesce(F.min("source_event_name"), empty).alias("source_event_name"),
        _modes(),
        F.count_if(F.col("mode") != "").alias("n_modes"),
        F.sum("n_rows").alias("dlq_rows"),
        F.sum("n_parameters").alias("event_parameters_rows"),
        F.sum("n_errors").cast("long").alias("validation_error_rows"),
        F.coalesce(F.min("rejected_at_min"), empty).alias("rejected_at_min"),
        F.coalesce(F.max("rejected_at_max"), empty).alias("rejected_at_max"),
    )


def dlq_errors_of(facts: DataFrame) -> DataFrame:
    """Every distinct validation error per event and shape, with its rows."""
    errors = facts.filter("validation_error is not null")
    return errors.groupBy(*LETTER_KEYS, "validation_error").agg(F.sum("n_letters").alias("dlq_rows"))


def dlq_summary(letters: DataFrame) -> DataFrame:
    """Rejected rows per event, dead-letter table and payload shape.

    Their error texts are a frame of their own, ``dlq_errors``: the list can be as
    long as the table, so it is rows rather than one cell.
    """
    return dlq_summary_of(
        dead_letter_rows(letters)
        .groupBy(*LETTER_KEYS, "mode")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if("has_event_parameters").alias("n_parameters"),
            F.sum(F.size("validation_errors")).alias("n_errors"),
            F.min("source_event_name").alias("source_event_name"),
            F.min("rejected_at").alias("rejected_at_min"),
            F.max("rejected_at").alias("rejected_at_max"),
        )
    )


def dlq_errors(letters: DataFrame) -> DataFrame:
    """Every distinct validation error per event and shape, with its rows."""
    errors = F.array_distinct("validation_errors")
    return (
        dead_letter_rows(letters)
        .select(*LETTER_KEYS, F.explode(errors).alias("validation_error"))
        .groupBy(*LETTER_KEYS, "validation_error")
        .agg(F.count(F.lit(1)).alias("dlq_rows"))
    )


def payload_parameters(payloads: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per payload row and key of its ``params`` object."""
    held = payloads.select(
        *extra, "event_table", F.explode(P.params_map(F.col("body"))).alias("parameter", "value")
    )
    return held.filter(F.col("parameter") != "")


def events_with_parameters(payloads: DataFrame) -> DataFrame:
    """Events of which at least one row has a named parameter.

    Keys are generated, not tested in a filter: a filter would be pushed below the parsing
    and repeat it.  They never leave the map task.
    """
    return payload_parameters(payloads).select("event_table").distinct()


def _restricted(payloads: DataFrame, events: DataFrame | None) -> DataFrame:
    """Only rows of the given events (a kept frame), before they are taken apart."""
    if events is None:
        return payloads
    names = events.select("event_table").distinct()
    return payloads.join(names, "event_table", "left_semi")


def raw_types(payloads: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """The type of each payload parameter, from all its values."""
    kind = P.value_kind(F.col("schema"), F.col("filled"))
    counted = (
        payload_parameters(_restricted(payloads, events))
        .select(
            "event_table",
            "parameter",
            F.schema_of_variant("value").alias("schema"),
            P.is_filled(F.col("value")).alias("filled"),
        )
        .select("event_table", "parameter", kind.alias("kind"))
        .groupBy("event_table", "parameter")
        .agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count("kind").alias("typed_rows"),
            *[
                F.count_if(F.col("kind") == name).alias(f"{name}_rows")
                for name in ("bool", "int", "float", "other")
            ],
        )
    )
    seen = {name: F.col(f"{name}_rows") > 0 for name in ("bool", "int", "float", "other")}
    return counted.select(
        "event_table", "parameter", P.merged_type(seen).alias("type"), "raw_rows", "typed_rows"
    )


def raw_profile(payloads: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Up to five distinct raw values per event and parameter.

    Equal values combine before the shuffle and spread by value; the rank filter runs
    inside the map tasks, so one parameter never meets in one task.
    """
    values = (
        payload_parameters(_restricted(payloads, events))
        .select("event_table", "parameter", P.raw_text(F.col("value")).alias("value"))
        .distinct()
    )
    return _first_values(values)


def _first_values(values: DataFrame) -> DataFrame:
    keys = ["event_table", "parameter"]
    order = W.partitionBy(*keys).orderBy("value")
    ranked = values.withColumn("rank", F.row_number().over(order))
    listed = F.sort_array(F.collect_list("value"))
    return (
        ranked.filter(F.col("rank") <= contracts.MAX_EXAMPLES)
        .groupBy(*keys)
        .agg(listed.alias("raw_examples"))
    )


def raw_parameter_contract(payloads: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Type and examples of each payload parameter, as contract entries need them."""
    return _with_examples(raw_types(payloads, events), raw_profile(payloads, events))


def _with_examples(types: DataFrame, profile: DataFrame) -> DataFrame:
    shown = F.transform(
        F.filter(F.col("raw_examples"), lambda v: ~v.isin(P.EMPTY_RAW_VALUES)),
        lambda v: F.coalesce(
            F.try_variant_get(F.try_parse_json(v), "$", "string"), v
        ),
    )
    examples = profile.withColumn("examples", shown)
    return types.join(examples, ["event_table", "parameter"]).select(
        "event_table", "parameter", "type", "examples", "raw_examples"
    )


def raw_presence(
    payloads: DataFrame, settings: Settings, events: DataFrame | None = None
) -> DataFrame:
    """Payload rows that carry a filled value of each parameter.

    Aliases of one parameter count once per row.  That is settled inside the row, on
    its own keys, so no row id has to be shuffled.
    """
    filled = F.map_filter(P.params_map(F.col("body")), lambda _, value: P.is_filled(value))
    session = settings.aliases("session_id")
    pooled = F.array_distinct(
        F.transform(
            F.map_keys(filled),
            lambda key: F.when(key.isin(session), "session_id").otherwise(key),
        )
    )
    return (
        _restricted(payloads, events)
        .select("event_table", F.explode(pooled).alias("parameter"))
        .filter(F.col("parameter") != "")
        .groupBy("event_table", "parameter")
        .agg(F.count(F.lit(1)).alias("raw_present_rows"))
    )


# ---------------------------------------------------------------------------
# Reconciliation
# ---------------------------------------------------------------------------
def reconcile(
    parsed: DataFrame, source: DataFrame, rejected: DataFrame, settings: Settings
) -> DataFrame:
    """Parsed, raw and rejected rows of every event, with flags and a severity.

    ``parsed`` has ``event_table, rows_in_range``.  All sides hold one row per event
    and are joined on it; adaptive execution picks the join by measured size.
    """
    zero = F.lit(0).cast("long")
    letters = rejected.groupBy("event_table").agg(
        F.sum("dlq_rows").alias("dlq_rows"),
        F.sort_array(F.collect_set("dlq_shape")).alias("dlq_shapes"),
        F.sort_array(F.collect_set("dlq_source_table")).alias("dlq_source_tables"),
    )
    targets = parsed.select(
        "event_table",
        F.lit(True).alias("is_target"),
        F.coalesce(F.col("rows_in_range"), zero).alias("target_rows"),
    )
    joined = (
        targets.join(source.select("event_table", "raw_rows"), "event_table", "full_outer")
        .join(letters, "event_table", "full_outer")
        .select(
            "event_table",
            F.coalesce("is_target", F.lit(False)).alias("target_table_exists"),
            F.coalesce("raw_rows", zero).alias("raw_rows"),
            F.col("target_rows").alias("parsed_rows"),
            F.coalesce("dlq_rows", zero).alias("dlq_rows"),
            F.coalesce("dlq_shapes", F.array().cast("array<string>")).alias("dlq_shapes"),
            F.coalesce("dlq_source_tables", F.array().cast("array<string>")).alias(
                "dlq_source_tables"
            ),
            V.any_table("event_table", settings.flow["excluded"]).alias(
                "source_comparison_excluded"
            ),
        )
    )
    target, excluded = F.col("target_table_exists"), F.col("source_comparison_excluded")
    has_raw, has_rejected = F.col("raw_rows") > 0, F.col("dlq_rows") > 0
    parsed_rows = F.coalesce(F.col("parsed_rows"), zero)
    unknown = F.col("event_table") == P.UNKNOWN_EVENT
    nothing_parsed, some_parsed = target & (parsed_rows == 0), target & (parsed_rows > 0)
    found = flags(
        (nothing_parsed & excluded, "investigate_source_comparison_not_applicable"),
        (nothing_parsed & ~excluded & has_raw, "low_raw_seen_but_parsed_missing"),
        (
            nothing_parsed & ~excluded & ~has_raw & has_rejected,
            "critical_dlq_seen_but_parsed_missing",
        ),
        (
            nothing_parsed & ~excluded & ~has_raw & ~has_rejected,
            "critical_event_not_received",
        ),
        (~target & has_raw & ~unknown & ~excluded, "low_missing_parsed_table"),
        (has_rejected, "critical_dlq_rows"),
        (some_parsed & (F.col("raw_rows") > parsed_rows), "investigate_raw_to_parsed_count_gap"),
        (some_parsed & ~has_raw & ~excluded, "investigate_parsed_without_source_window_rows"),
        (unknown & has_raw, "critical_source_type_missing"),
    )
    flagged = joined.withColumn("flags", found).withColumn("severity", severity(F.col("flags")))
    shown = F.when(F.size("flags") == 0, F.array(F.lit("ok"))).otherwise(F.col("flags"))
    return flagged.withColumn("status", shown).drop("flags")


# ---------------------------------------------------------------------------
# Parameters that are missing in the target: traced to the payload
# ---------------------------------------------------------------------------
def priority_rank(column: str = "report_priority") -> Column:
    ranks = F.create_map(*[F.lit(p) for item in PRIORITY_RANKS.items() for p in item])
    return F.coalesce(ranks[F.lower(F.col(column))], F.lit(PRIORITY_RANKS["normal"]))


def _allowed_missing(settings: Settings) -> Column:
    main = {"user_id", settings.main_identifier}
    session = {"session_id", *settings.aliases("session_id")}
    parameter = F.col("parameter")
    return (
        parameter.isin(sorted(main))
        & V.any_table("event_table", settings.tables_where_missing_is_allowed("main_id"))
    ) | (
        parameter.isin(sorted(session))
        & V.any_table("event_table", settings.tables_where_missing_is_allowed("session_id"))
    )


def parameter_pairs(
    status: DataFrame, contract: DataFrame | None, settings: Settings, limit: int | None = None
) -> DataFrame:
    """The (table, parameter) pairs to trace, most urgent first.

    Problems about missing values, without those the configuration permits.  Only a
    limit that the caller or the configuration sets leaves pairs out.
    """
    problem = F.coalesce(F.col("problem"), F.lit(""))
    share = F.col("missing_pct")
    about_missing = F.lower(problem).rlike("missing|unpopulated") | (share > 0)
    column_gone = problem.contains("missing_column") | problem.contains("unpopulated_column")
    named = (F.col("parameter") != "*") & (F.col("parameter") != "") & (F.col("event_table") != "")
    candidates = status.filter(
        F.col("status").isin("problem", "error") & about_missing & named & ~_allowed_missing(settings)
    ).select(
        "event_table",
        "parameter",
        F.when(share.isNull() & column_gone, F.lit(1.0)).otherwise(share).alias(
            "target_missing_pct"
        ),
        problem.alias("target_problem"),
        "report_priority",
        priority_rank().alias("priority_rank"),
    )
    once = W.partitionBy("event_table", "parameter").orderBy("priority_rank", "target_problem")
    unique = candidates.withColumn("n", F.row_number().over(once)).filter("n = 1").drop("n")
    most = settings.flow["max_parameter_checks"] if limit is None else limit
    if most is not None:
        unique = unique.orderBy("priority_rank", "event_table", "parameter").limit(most)
    return with_scope(unique, contract).drop("priority_rank")


def with_scope(pairs: DataFrame, contract: DataFrame | None) -> DataFrame:
    """Add where the contract places a parameter."""
    fallback = F.lit("configured_or_discovered")
    if contract is None:
        return pairs.withColumn("scope", fallback)

    def names(scope: str, *keys: str) -> DataFrame:
        rows = contract.filter(F.col("scope") == scope).filter(F.col("parameter").isNotNull())
        return rows.select(*keys).distinct().withColumn(f"in_{scope}", F.lit(True))

    joined = (
        pairs.join(names(contracts.SYSTEM, "parameter"), "parameter", "left")
        .join(names(contracts.COMMON, "parameter"), "parameter", "left")
        .join(
            names(contracts.EVENT, "event_table", "parameter"),
            ["event_table", "parameter"],
            "left",
        )
    )
    scope = F.when(F.col("in_system"), "system").when(F.col("in_common"), "common")
    return joined.withColumn(
        "scope", scope.when(F.col("in_event"), "event").otherwise(fallback)
    ).drop("in_system", "in_common", "in_event")


def parameter_origin(
    pairs: DataFrame, presence: DataFrame, source: DataFrame, settings: Settings
) -> DataFrame:
    """Whether a missing target value was missing in the payload already.

    Each pair looks up the evidence of its pooled aliases, so pairs that share aliases do not starve each
    other.
    """
    session = {"session_id", *settings.aliases("session_id")}
    main = {"user_id", settings.main_identifier}
    canonical = (
        F.when(F.col("parameter").isin(sorted(session)), "session_id")
        .when(F.col("parameter").isin(sorted(main)), settings.main_identifier)
        .otherwise(F.col("parameter"))
    )
    aliases = (
        F.when(F.col("parameter") == "event_name", F.lit("type"))
        .when(F.col("canonical") == "session_id", F.lit(",".join(settings.aliases("session_id"))))
        .otherwise(F.col("canonical"))
    )
    zero = F.lit(0).cast("long")
    evidence = presence.withColumnRenamed("parameter", "canonical")
    joined = (
        pairs.withColumn("canonical", canonical)
        .withColumn("source_aliases", aliases)
        .join(evidence, ["event_table", "canonical"], "left")
        .join(source.select("event_table", "raw_rows"), "event_table", "left")
        .withColumn("raw_rows", F.coalesce("raw_rows", zero))
    )
    counted = F.when(F.col("parameter") == "event_name", F.col("raw_rows")).otherwise(
        F.coalesce(F.col("raw_present_rows"), zero)
    )
    # Totals and evidence may come from reads a moment apart: a share above one is
    # an artifact of that and is capped.
    capped = F.when(F.col("raw_rows") > 0, F.least(counted, F.col("raw_rows"))).otherwise(counted)
    traced = joined.withColumn("raw_present_rows", capped)
    share = V.ratio(F.col("raw_present_rows"), F.col("raw_rows"))
    target_missing = F.coalesce(F.col("target_missing_pct"), F.lit(0.0)) > 0
    case = (
        F.when(V.any_table("event_table", settings.flow["excluded"]), "excluded")
        .when(F.col("raw_rows") == 0, "no_rows")
        .when((share >= PRESENT_SHARE) & target_missing, "parser")
        .when(share < PRESENT_SHARE, "payload")
        .otherwise("ok")
    )

    def outcome(position: int) -> Column:
        entries = [p for name, held in DIAGNOSES.items() for p in (F.lit(name), F.lit(held[position]))]
        return F.create_map(*entries)[F.col("case")]

    return (
        traced.withColumn("raw_presence_pct", F.round(share, 6))
        .withColumn("case", case)
        .withColumn("diagnosis", outcome(0))
        .withColumn("status", outcome(1))
        .withColumn("severity", outcome(2))
        .drop("case", "canonical")
    )


def counters(frame: DataFrame, **named: Column) -> DataFrame:
    """Aggregates of a frame as ``counter, value`` rows."""
    totals = frame.agg(*[value.cast("long").alias(name) for name, value in named.items()])
    return totals.unpivot([], list(named), "counter", "value")


def flow_summary(
    flows: DataFrame, source: DataFrame, letters: DataFrame, origins: DataFrame
) -> DataFrame:
    """Counters of a flow check, one row each."""
    critical = F.exists("status", lambda flag: flag.startswith("critical_"))
    parser, payload = DIAGNOSES["parser"][0], DIAGNOSES["payload"][0]
    parts = [
        counters(source, source_event_types=F.count(F.lit(1))),
        counters(letters, dlq_rows=V.sum_or_zero(F.col("dlq_rows"))),
        counters(
            flows,
            critical_event_flows=F.count_if(critical),
            low_event_flows=F.count_if(F.col("severity") == "low"),
        ),
        counters(
            origins,
            parameter_checks=F.count(F.lit(1)),
            source_parameter_missing=F.count_if(F.col("diagnosis") == payload),
            likely_parser_parameter_issues=F.count_if(F.col("diagnosis") == parser),
            critical_parameter_issues=F.count_if(F.col("severity") == "critical"),
            low_parameter_issues=F.count_if(F.col("severity") == "low"),
        ),
    ]
    return united(parts)
