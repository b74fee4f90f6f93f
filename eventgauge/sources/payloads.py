"""Raw payload tables and dead-letter tables, parsed once per row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventgauge.functions import payload as P
from eventgauge.functions.windows import Windows
from eventgauge.sources.events import united

REQUIRED_COLUMNS = ("event_time", "payload")


@dataclass(frozen=True)
class PayloadTable:
    name: str
    frame: DataFrame

    def __post_init__(self) -> None:
        lacking = [c for c in REQUIRED_COLUMNS if c not in self.frame.columns]
        if lacking:
            raise ValueError(f"payload table {self.name} lacks {', '.join(lacking)}")


def known_tables(
    frames: Mapping[str, DataFrame], wanted: list[str]
) -> tuple[list[PayloadTable], list[str]]:
    """The wanted tables that exist, and the names of those that do not."""
    found = [PayloadTable(name, frames[name]) for name in wanted if name in frames]
    return found, [name for name in wanted if name not in frames]


def parsed(table: PayloadTable, windows: Windows | None, dead_letter: bool = False) -> DataFrame:
    """Payload rows of the window with their parsed value and event name.

    Columns: ``source_table, raw_type, mode, valid, body, event_table``.  ``body`` is
    the enclosed VARIANT and is NULL unless the payload is one valid JSON value.
    """
    frame = table.frame
    if windows is not None:
        frame = frame.filter(windows.in_measurement(frame, "event_time"))
    wrapped = frame.withColumn("wrapped", P.enclosed(F.col("payload")))
    checked = wrapped.withColumn("valid", P.is_valid_json(F.col("wrapped")))
    body = F.when(F.col("valid"), F.col("wrapped"))
    bodied = checked.withColumn("body", body)

    # Each value is cut out of the body once, in a projection of its own.
    found = {"type_value": P.at(F.col("body"), "type")}
    if dead_letter:
        found["name_value"] = P.at(F.col("body"), "event", "name")
    cut = bodied.withColumns(found)
    names = []
    if "type" in frame.columns:
        names.append(F.nullif(F.col("type").cast("string"), F.lit("")))
    names += [P.filled_text(F.col(column)) for column in found]
    mode = F.col("mode").cast("string") if "mode" in frame.columns else F.lit("")
    return cut.select(
        F.lit(table.name).alias("source_table"),
        F.coalesce(*names, F.lit("")).alias("raw_type"),
        F.coalesce(mode, F.lit("")).alias("mode"),
        "valid",
        "body",
    ).select(
        "*",
        # Generated, not projected: a later filter on the name would otherwise be pushed
        # below the parsing and repeat it for every reference inside the expression.
        F.explode(F.array(P.event_name([F.col("raw_type")]))).alias("event_table"),
    )


def parsed_dead_letters(tables: list[PayloadTable], windows: Windows | None) -> DataFrame:
    return united([parsed(table, windows, dead_letter=True) for table in tables])
