"""Event tables as one long frame.

All tables are measured in one job: each is projected to the same narrow columns
and the projections are united.  A physical table that already holds many event
types names the column that tells them apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventgauge.functions import values as V
from eventgauge.functions.windows import Windows, between
from eventgauge.settings import TIME_COLUMN_CANDIDATES, Settings, glob_to_regex

DIMENSIONS = ("step", "type", "platform", "region", "server_region")
IDENTIFIERS = {
    "adid": "adid",
    "main_id": "user_id",
    "session_id": "session_id",
    "event_key": "event_key",
}


def measurement_time_column(
    schema: T.StructType, candidates: Sequence[str] = TIME_COLUMN_CANDIDATES
) -> str | None:
    """The first candidate that is a timestamp; a plain date does not qualify."""
    types = {field.name: field.dataType for field in schema.fields}
    timestamps = (T.TimestampType, T.TimestampNTZType)
    return next((c for c in candidates if isinstance(types.get(c), timestamps)), None)


@dataclass(frozen=True)
class EventSource:
    """One physical table.

    ``name`` is the event table it stands for, or ``name_column`` the column that
    carries event table names.  ``prune_column`` may name a second column that the
    files are laid out by and that never lies outside a window bound on which the
    measurement column is inside (a partition timestamp, or the exact time next to
    a truncated one): the same bounds are then also put on it.  ``tables`` may list the
    event tables a name column holds, which saves reading them.  ``title`` tells apart
    sources with equal name columns in frames that are kept from run to run.
    """

    frame: DataFrame
    name: str | None = None
    name_column: str | None = None
    time_column: str | None = None
    prune_column: str | None = None
    tables: tuple[str, ...] = ()
    title: str | None = None

    def __post_init__(self) -> None:
        if (self.name is None) == (self.name_column is None):
            raise ValueError("give an event source either a name or a name column")

    @property
    def label(self) -> str:
        """What the source is called in frames kept from run to run."""
        return self.title or self.name or f"{self.name_column} column"

    @property
    def columns(self) -> list[str]:
        return self.frame.columns

    @property
    def measured_by(self) -> str | None:
        return self.time_column or measurement_time_column(self.frame.schema)

    @property
    def event_table(self) -> Column:
        return F.lit(self.name) if self.name_column is None else F.col(self.name_column)

    def within(self, windows: Windows, span: str) -> DataFrame:
        """Rows of the ``measurement``, the ``lookback``, both (``scope``), or all rows
        ``since_lookback`` began."""
        column = self.measured_by
        assert column is not None
        if span == "since_lookback":
            since = windows.since_lookback(self.frame, column)
            if self.prune_column:
                since = since & windows.since_lookback(self.frame, self.prune_column)
            return self.frame.filter(since)
        predicate = {
            "measurement": windows.in_measurement,
            "lookback": windows.in_lookback,
            "scope": windows.in_scope,
        }[span](self.frame, column)
        if self.prune_column:
            bounds = getattr(windows, f"{span}_bounds")
            kind = self.frame.schema[self.prune_column].dataType
            predicate = predicate & between(F.col(self.prune_column), *bounds, kind)
        return self.frame.filter(predicate)


def measurable(sources: Sequence[EventSource]) -> list[EventSource]:
    return [source for source in sources if source.measured_by is not None]


def _identifier(source: EventSource, settings: Settings, logical: str) -> Column:
    return V.first_present(settings.aliases(logical), source.columns)[0]


def canonical_events(
    sources: Sequence[EventSource],
    settings: Settings,
    windows: Windows,
    span: str = "measurement",
) -> DataFrame:
    """Normalised identifiers and drill-down labels of all rows in a window.

    Columns nobody selects afterwards are pruned down to the scan.
    """
    parts = []
    for source in measurable(sources):
        labels = [V.dimension(d, source.columns).alias(f"{d}_label") for d in DIMENSIONS]
        step = V.text("step") if "step" in source.columns else F.lit(None).cast("string")
        rows = source.within(windows, span).select(
            source.event_table.alias("event_table"),
            F.col(source.measured_by or "").alias("event_time"),
            *[
                _identifier(source, settings, logical).alias(name)
                for name, logical in IDENTIFIERS.items()
            ],
            step.alias("step"),
            F.lit("step" in source.columns).alias("has_step"),
            *labels,
        )
        parts.append(rows.filter(F.col("event_time").isNotNull()))
    return united(parts)


def event_times(
    sources: Sequence[EventSource], windows: Windows, span: str = "since_lookback"
) -> DataFrame:
    """Only table name and time: the narrow scan behind volume and future checks."""
    return united(
        [
            source.within(windows, span).select(
                source.event_table.alias("event_table"),
                F.col(source.measured_by or "").alias("event_time"),
            )
            for source in measurable(sources)
        ]
    )


def table_profiles(
    sources: Sequence[EventSource],
    settings: Settings,
    windows: Windows | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """One row per source and event table: time column and which identifiers it can have.

    ``known`` (``sources.names``) lists names with their source; a name column is then not
    read, and event tables without rows since the lookback began are listed as well.
    """
    parts = []
    for index, source in enumerate(sources):
        present = {
            name: V.first_present(settings.aliases(logical), source.columns)[1]
            for name, logical in IDENTIFIERS.items()
        }
        parts.append(
            _event_tables(source, windows, known).select(
                F.lit(index).alias("source"),
                "event_table",
                F.lit(source.measured_by).cast("string").alias("measurement_time_column"),
                *[F.lit(bool(cols)).alias(f"has_{name}") for name, cols in present.items()],
                F.lit(",".join(present["session_id"])).alias("session_id_columns"),
                F.lit(",".join(present["main_id"])).alias("main_identifier_columns"),
                F.lit(settings.main_identifier).alias("main_identifier"),
            )
        )
    return united(parts)


def table_columns(
    sources: Sequence[EventSource], windows: Windows | None = None, known: DataFrame | None = None
) -> DataFrame:
    """``event_table, column_name, type`` for every column of every event table."""
    parts = []
    for source in sources:
        held = [f for f in source.frame.schema.fields if f.name != source.name_column]
        listed = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                )
                for f in held
            ]
        )
        named = _event_tables(source, windows, known)
        parts.append(named.select("event_table", F.inline(listed)))
    return united(parts)


def _event_tables(
    source: EventSource, windows: Windows | None = None, known: DataFrame | None = None
) -> DataFrame:
    """The event tables of a source: those known by name, where such a frame is given.

    A list of names given with the source is taken as it is.  Otherwise names held in a
    column are read with a distinct over that one column, which combines on the map
    side; with windows only rows since the lookback began are read.
    """
    session = source.frame.sparkSession
    if known is not None and source.name_column is not None and source.measured_by is not None:
        return known.filter(F.col("source") == source.label).select("event_table")
    if source.tables:
        return session.createDataFrame([(name,) for name in source.tables], "event_table string")
    named = source.event_table.alias("event_table")
    if source.name_column is None:
        return session.range(1).select(named)
    bounded = windows is not None and source.measured_by is not None
    rows = source.within(windows, "since_lookback") if bounded else source.frame
    return rows.select(named).distinct()


def united(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows; the unions form a balanced tree, so thousands of parts stay shallow."""
    if not parts:
        raise ValueError("there is no event table with a timestamp column to measure")
    level = list(parts)
    while len(level) > 1:
        pairs = zip(level[::2], level[1::2])
        merged = [a.unionByName(b, allowMissingColumns=True) for a, b in pairs]
        level = merged + level[len(merged) * 2 :]
    return level[0]


def without_blacklisted(
    frame: DataFrame, settings: Settings, column: str = "event_table"
) -> DataFrame:
    """Drop rows of black-listed tables; patterns match without regard to case."""
    name = F.lower(F.col(column))
    for pattern in settings.blacklist:
        frame = frame.filter(~name.rlike(glob_to_regex(pattern)))
    return frame
