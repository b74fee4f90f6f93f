"""Which tables exist, what they hold, and which of them are measured."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventgauge.settings import TIME_COLUMN_CANDIDATES, Settings
from eventgauge.sources.events import EventSource, measurement_time_column, united

INVENTORY_FLAGS = ("adid", "main_id", "session_id", "event_key")
NOT_STORED = ("VIEW", "TEMPORARY")
#: The column that names the table of a row when many tables are read as one.
TABLE = "event_table"


@dataclass(frozen=True)
class TableEntry:
    """One known table: how to read it and what kind of object it is.

    ``location`` is the folder of its Parquet files, if it has one of its own that is named
    like it; ``rows`` is the catalogue's statistic, if there is one.
    """

    name: str
    frame: DataFrame
    engine: str = "table"
    location: str | None = None
    rows: int | None = None

    @property
    def is_stored(self) -> bool:
        return self.engine.upper() not in NOT_STORED


def catalog_entries(
    spark: SparkSession, database: str, settings: Settings, mandatory: Sequence[str] = ()
) -> list[TableEntry]:
    """Tables of a catalogue database whose names match the configured prefixes."""
    prefixes = tuple(settings.prefixes)
    described = {
        row.tableName: row.information
        for row in spark.sql(f"show table extended in `{database}` like '*'").collect()
    }
    entries = []
    for table in spark.catalog.listTables(database):
        wanted = not prefixes or table.name.startswith(prefixes) or table.name in mandatory
        if wanted and not table.isTemporary:
            frame = spark.table(f"`{database}`.`{table.name}`")
            facts = described.get(table.name, "")
            entries.append(
                TableEntry(table.name, frame, table.tableType, _own_folder(table.name, facts), _statistic(facts))
            )
    return entries


def _fact(information: str, name: str) -> str | None:
    found = re.search(rf"^{name}: (.*)$", information, re.MULTILINE)
    return found[1].strip() if found else None


def _own_folder(name: str, information: str) -> str | None:
    folder = _fact(information, "Location")
    plain = _fact(information, "Provider") == "parquet" and "Partition Columns" not in information
    return folder if plain and folder and folder.rstrip("/").rsplit("/", 1)[-1] == name else None


def _statistic(information: str) -> int | None:
    found = re.search(r"(\d+) rows", _fact(information, "Statistics") or "")
    return int(found[1]) if found else None


def shared_frames(entries: Sequence[TableEntry]) -> list[tuple[DataFrame, list[str]]]:
    """One frame for all tables of one schema that lie in folders of their own.

    A row is named by the folder of its file, so thousands of tables are one scan and the plan
    does not grow with their number.  Tables that cannot be read together come alone.
    """
    groups: dict[str, list[TableEntry]] = {}
    for entry in entries:
        key = entry.frame.schema.json() if entry.location else f"alone {entry.name}"
        groups.setdefault(key, []).append(entry)
    out = []
    for held in groups.values():
        first = held[0].frame
        if len(held) == 1:
            out.append((first.withColumn(TABLE, F.lit(held[0].name)), [held[0].name]))
            continue
        reader = first.sparkSession.read.schema(first.schema)
        rows = reader.parquet(*[entry.location for entry in held])
        folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
        named = rows.withColumn(TABLE, F.url_decode(folder))
        out.append((named, [entry.name for entry in held]))
    return out


def table_inventory(
    spark: SparkSession,
    entries: Sequence[TableEntry],
    settings: Settings,
    limit: int | None = None,
    mandatory: Iterable[str] = (),
    time_candidates: Sequence[str] = TIME_COLUMN_CANDIDATES,
) -> DataFrame:
    """Name, kind, row count, columns and capability flags of every table.

    Row counts are the catalogue's where it has them.  The others are counted in one job, one
    scan for all tables of a schema (a count needs no column).  Mandatory tables come first and
    are never cut off.
    """
    facts = []
    for entry in entries:
        columns = set(entry.frame.columns)
        facts.append(
            (
                entry.name,
                entry.engine,
                len(entry.frame.columns),
                sorted(columns),
                [(f.name, f.dataType.simpleString()) for f in entry.frame.schema.fields],
                measurement_time_column(entry.frame.schema, time_candidates),
                *[
                    any(alias in columns for alias in settings.aliases(flag))
                    for flag in INVENTORY_FLAGS
                ],
            )
        )
    schema = (
        "table_name string, engine string, column_count long, columns array<string>, "
        "column_types array<struct<name: string, type: string>>, "
        "measurement_time_column string, "
        + ", ".join(f"has_{flag} boolean" for flag in INVENTORY_FLAGS)
    )
    unknown = [entry for entry in entries if entry.rows is None]
    session = spark.createDataFrame(
        [(entry.name, entry.rows) for entry in entries if entry.rows is not None],
        "table_name string, estimated_rows long",
    )
    counted = [
        frame.groupBy(F.col(TABLE).alias("table_name")).agg(F.count(F.lit(1)).alias("estimated_rows"))
        for frame, _ in shared_frames(unknown)
    ]
    counts = united([session, *counted])
    first = F.col("table_name").isin(list(mandatory))
    rows = spark.createDataFrame(facts, schema).join(counts, "table_name", "left")
    rows = rows.withColumn("estimated_rows", F.coalesce("estimated_rows", F.lit(0).cast("long")))
    order = [F.col("is_mandatory").desc(), F.col("estimated_rows").desc(), "table_name"]
    ordered = rows.withColumn("is_mandatory", first).orderBy(*order)
    return ordered if limit is None else ordered.limit(limit + len(list(mandatory)))


@dataclass(frozen=True)
class Selection:
    """Tables to measure, and those a limit leaves out (the run is then degraded)."""

    chosen: list[str]
    origin: str
    not_scanned: list[str]


def select_event_tables(
    sizes: Mapping[str, int], settings: Settings, limit: int | None = None
) -> Selection:
    """Order candidate tables (name to row count) and cut the list at the limit.

    An explicit list wins and is not cut.  Otherwise priority tables come first, in
    their own order, and the rest by size.
    """
    if settings.explicit_tables:
        return Selection(settings.explicit_tables, "configured", [])
    first = [name for name in settings.priority_tables if name in sizes]
    rest = sorted(set(sizes) - set(first), key=lambda name: (-sizes[name], name))
    ordered = [*dict.fromkeys(first), *rest]
    cut = settings.max_event_tables if limit is None else limit
    return Selection(ordered[:cut], "discovered", [] if cut is None else ordered[cut:])


def event_sources(
    entries: Sequence[TableEntry], chosen: Sequence[str]
) -> list[EventSource]:
    """Sources for the chosen tables that are stored and have a time column."""
    by_name = {entry.name: entry for entry in entries}
    sources = [
        EventSource(by_name[name].frame, name=name)
        for name in chosen
        if name in by_name and by_name[name].is_stored
    ]
    return [source for source in sources if source.measured_by is not None]


def shared_sources(entries: Sequence[TableEntry], chosen: Sequence[str]) -> list[EventSource]:
    """Sources for the chosen tables, one for all that have the same schema."""
    wanted = set(chosen)
    held = [
        entry
        for entry in entries
        if entry.name in wanted
        and entry.is_stored
        and measurement_time_column(entry.frame.schema)
        and TABLE not in entry.frame.columns
    ]
    sources = []
    for frame, names in shared_frames(held):
        if len(names) == 1:
            sources.append(EventSource(frame.drop(TABLE), name=names[0]))
        else:
            # Names are remembered by schema, the same from run to run.
            title = f"tables of schema {zlib.crc32(frame.schema.json().encode()):08x}"
            sources.append(EventSource(frame, name_column=TABLE, tables=tuple(names), title=title))
    rest = [n for n in chosen if n in wanted - {name for s in sources for name in (s.tables or (s.name,))}]
    return sources + event_sources(entries, rest)
