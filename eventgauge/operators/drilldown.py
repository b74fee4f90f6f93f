"""Samples of the groups behind a finding.

Samples are chosen first, from counts alone and with the limit applied inside the
map tasks, and kept.  Only then are the rows of the chosen groups read again for
their labels, so majority values are never computed for groups nobody will see.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventgauge.functions import values as V
from eventgauge.functions.windows import Windows
from eventgauge.operators import events as E
from eventgauge.operators.status import NO_ROWS
from eventgauge.settings import Settings
from eventgauge.sources.events import without_blacklisted
from eventgauge.sources.kept import kept

SAMPLES_PER_TABLE = 50
STEP_ROWS_PER_TABLE = 100


def _top(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column | str], limit: int
) -> DataFrame:
    ranked = frame.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit)


def candidates(metrics: DataFrame, settings: Settings, limit: int | None = None) -> DataFrame:
    """Tables worth a drill-down, by their largest share of duplicated, burst or
    future rows.  Bursts count only where they are checked."""
    zero = F.lit(0).cast("long")
    burst = F.when(
        V.any_table("event_table", sorted(settings.same_second_allowed)), zero
    ).otherwise(F.coalesce("same_second_burst_rows", zero))
    worst = F.greatest(
        F.coalesce("duplicate_rows", zero), burst, F.coalesce("future_event_time_rows", zero)
    )
    scored = metrics.withColumn(
        "score", V.ratio(worst, F.greatest(F.col("rows_in_range"), F.lit(1).cast("long")))
    )
    chosen = without_blacklisted(scored.filter("score > 0"), settings)
    return _first(chosen.orderBy(F.col("score").desc(), "event_table"), settings, limit)


def flagged_tables(status: DataFrame, settings: Settings, limit: int | None = None) -> DataFrame:
    """Tables whose status names a problem other than having no rows."""
    found = without_blacklisted(
        status.filter(~F.col("status").isin("ok", NO_ROWS)), settings
    ).select("event_table", "status")
    return _first(found.orderBy("event_table"), settings, limit)


def _first(ordered: DataFrame, settings: Settings, limit: int | None) -> DataFrame:
    """All rows, unless the caller or the configuration sets a limit."""
    most = settings.drilldown["max_tables"] if limit is None else limit
    return ordered if most is None else ordered.limit(most)


def chosen_tables(metrics: DataFrame, status: DataFrame, settings: Settings) -> DataFrame:
    """The tables to drill into: those configured, else those scored, else those flagged.

    A table the configuration names is taken whether or not it has a problem.  Flagged
    tables are added to the scored ones, so a table with any flag has its samples.
    """
    configured = settings.drilldown["tables"]
    if configured:
        return metrics.filter(V.any_table("event_table", configured)).select("event_table")
    scored = candidates(metrics, settings).select("event_table")
    return scored.unionByName(flagged_tables(status, settings).select("event_table")).distinct()


def _of_tables(events: DataFrame, tables: DataFrame | None) -> DataFrame:
    """Events of the given tables; the list holds one row per event table."""
    if tables is None:
        return events
    return events.join(tables.select("event_table"), "event_table", "left_semi")


def _label_counts(
    events: DataFrame, chosen: DataFrame, keys: list[str], labels: dict[str, Column]
) -> DataFrame:
    """Rows per chosen group, label column and label.

    ``chosen`` is kept and holds at most the sample limit of rows per table; its
    other columns are carried along.  The rows of one group combine per label on the
    map side, however many there are.
    """
    # New names on the chosen side: it was derived from the same events.
    renamed = chosen.select(
        *[F.col(c).alias(f"chosen_{c}" if c in keys else c) for c in chosen.columns]
    )
    same = [F.col(k) == F.col(f"chosen_{k}") for k in keys]
    rows = events.join(renamed, same).select(
        *chosen.columns, *[expr.alias(name) for name, expr in labels.items()]
    )
    long = rows.unpivot(chosen.columns, list(labels), "label", "value")
    return long.groupBy(*chosen.columns, "label", "value").agg(F.count(F.lit(1)).alias("n"))


def _majority(name: str) -> Column:
    """The most frequent value of a label, the smallest one on a tie."""
    mine = (F.col("label") == name) & F.col("value").isNotNull()
    rank = F.when(mine, F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
    return F.min(rank)["value"]


def _labels(*names: str) -> dict[str, Column]:
    return {name: F.col(f"{name}_label") for name in names}


def duplicate_samples(
    events: DataFrame, tables: DataFrame | None = None, limit: int = SAMPLES_PER_TABLE
) -> DataFrame:
    """The largest groups of equal (time, adid, key) per table, with their labels."""
    keys = list(E.GROUP)
    inside = _of_tables(events, tables)
    groups = E.event_groups(inside).filter(F.col("group_rows") > 1)
    groups = groups.withColumnRenamed("group_rows", "rows_same_event_key_adid_time")
    size = F.col("rows_same_event_key_adid_time")
    chosen = kept(
        _top(groups, ["event_table"], [size.desc(), "event_time", "adid", "event_key"], limit)
    )
    named = ("platform", "region", "server_region", "step", "type")
    counted = _label_counts(
        inside, chosen, keys, {"main_id": F.col("main_id"), **_labels(*named)}
    )
    ids = F.count_if((F.col("label") == "main_id") & F.col("value").isNotNull())
    return counted.groupBy(*chosen.columns).agg(
        ids.alias("unique_main_identifiers"),
        *[_majority(name).alias(f"most_common_{name}") for name in named],
    )


def burst_groups(
    events: DataFrame,
    threshold: int,
    tables: DataFrame | None = None,
    limit: int = SAMPLES_PER_TABLE,
) -> DataFrame:
    """The largest (time, adid) groups with too many keys per table."""
    keys = list(E.SECOND)
    seconds = (
        E.event_groups(_of_tables(events, tables))
        .groupBy(*keys)
        .agg(
            F.sum("group_rows").alias("rows_same_second"),
            F.count(F.lit(1)).alias("unique_event_keys"),
        )
        .filter(F.col("unique_event_keys") > threshold)
    )
    size = F.col("rows_same_second")
    return kept(_top(seconds, ["event_table"], [size.desc(), "event_time", "adid"], limit))


def burst_samples(
    events: DataFrame,
    threshold: int,
    tables: DataFrame | None = None,
    limit: int = SAMPLES_PER_TABLE,
    groups: DataFrame | None = None,
) -> DataFrame:
    """The chosen burst groups with their most frequent labels.

    ``groups`` are those of ``burst_groups`` where they are at hand.  The steps and types
    of a group can be as many as its rows: they are rows of their own, ``burst_labels``.
    """
    chosen = burst_groups(events, threshold, tables, limit) if groups is None else groups
    keyed = events.filter(F.col("event_key").isNotNull())
    named = ("platform", "region", "server_region")
    counted = _label_counts(keyed, chosen, list(E.SECOND), _labels(*named))
    return counted.groupBy(*chosen.columns).agg(
        *[_majority(name).alias(f"most_common_{name}") for name in named]
    )


def burst_labels(
    events: DataFrame,
    threshold: int,
    tables: DataFrame | None = None,
    limit: int = SAMPLES_PER_TABLE,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Every step and type of the chosen burst groups with its rows."""
    chosen = burst_groups(events, threshold, tables, limit) if groups is None else groups
    keyed = events.filter(F.col("event_key").isNotNull())
    short = chosen.select(*E.SECOND, "rank")
    counted = _label_counts(keyed, short, list(E.SECOND), _labels("step", "type"))
    return counted.filter(F.col("value").isNotNull())


def missing_id_counts(events: DataFrame, tables: Sequence[str] | None = None) -> DataFrame:
    """Rows without a main or session identifier per step and type of a table: all of them."""
    if tables is not None:
        events = events.filter(V.any_table("event_table", tables))
    counted = events.groupBy(
        "event_table", F.col("step_label").alias("step"), F.col("type_label").alias("type")
    ).agg(
        F.count(F.lit(1)).alias("rows_in_range"),
        F.count_if(F.col("main_id").isNull()).alias("missing_main_identifier_rows"),
        F.count_if(F.col("session_id").isNull()).alias("missing_session_id_rows"),
    )
    lacking = counted.filter(
        (F.col("missing_main_identifier_rows") > 0) | (F.col("missing_session_id_rows") > 0)
    )
    rows = F.col("rows_in_range")
    return lacking.withColumns(
        {
            "missing_main_identifier_pct": V.pct(F.col("missing_main_identifier_rows"), rows),
            "missing_session_id_pct": V.pct(F.col("missing_session_id_rows"), rows),
        }
    )


def missing_ids_by_step(
    events: DataFrame,
    tables: Sequence[str] | None = None,
    limit: int = STEP_ROWS_PER_TABLE,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The largest of the rows of ``missing_id_counts`` per table, a sample to look at.

    ``counts`` are those of ``missing_id_counts`` where they are at hand.
    """
    lacking = missing_id_counts(events, tables) if counts is None else counts
    top = _top(lacking, ["event_table"], [F.col("rows_in_range").desc(), "step", "type"], limit)
    shares = ["missing_main_identifier_pct", "missing_session_id_pct"]
    return top.select(*[c for c in top.columns if c not in shares], *shares)


def future_samples(
    times: DataFrame, windows: Windows, tolerance_minutes: int, limit: int = SAMPLES_PER_TABLE
) -> DataFrame:
    """The latest times beyond the reference per table, with the time of the check."""
    late = times.filter(windows.after_reference(times, "event_time", tolerance_minutes))
    top = _top(late, ["event_table"], [F.col("event_time").desc()], limit)
    checked = windows.reference.strftime("%Y-%m-%d %H:%M:%S")
    return top.withColumn("checked_at", F.lit(checked))


def sample_summary(events: DataFrame, threshold: int, settings: Settings) -> DataFrame:
    """Duplicate and burst groups per table: how many, the largest, the most distinct ids.

    All groups count, whatever the sample frames show; bursts only where they are checked.
    Main identifiers are grouped before they are counted, so no group is gathered.
    """
    keyed = events.filter(F.col("adid").isNotNull() & F.col("event_key").isNotNull())
    groups = list(E.GROUP)
    named = keyed.groupBy(*groups, "main_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = named.groupBy(*groups).agg(
        F.sum("n").alias("n"), F.count("main_id").alias("unique")
    )
    seconds = E.event_groups(events).groupBy(*E.SECOND).agg(
        F.sum("group_rows").alias("n"), F.count(F.lit(1)).alias("unique")
    )
    checked = ~V.any_table("event_table", sorted(settings.same_second_allowed))

    def summed(found: DataFrame, kind: str) -> DataFrame:
        return found.groupBy("event_table").agg(
            F.count(F.lit(1)).alias("sample_groups"),
            F.max("n").alias("max_rows"),
            F.max("unique").alias("max_unique"),
        ).withColumn("kind", F.lit(kind))

    duplicates = summed(repeated.filter("n > 1"), "duplicate")
    return duplicates.unionByName(
        summed(seconds.filter((F.col("unique") > threshold) & checked), "burst")
    )
