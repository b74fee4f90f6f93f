"""Event, payload and dead-letter views over the given ``events`` table.

The table is clean, so the views put in what the engine looks for, by arithmetic on
the event id: missing and invalid values, repeated keys, broken JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventgauge.sources.events import EventSource

CHANGE_DAY = "2024-01-24 00:00:00"
ZERO_UUID = "00000000-0000-0000-0000-000000000000"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def event_view(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "'event_' || event_type as event_table",
        "ts as created_at",
        "date_trunc('hour', ts) as event_date_ltz",
        "case when event_id % 97 = 0 then null when event_id % 89 = 0 then ''"
        f" when event_id % 83 = 0 then '{ZERO_UUID}'"
        f" when event_id % 79 = 0 then 'NULL' else {_text('user_id % 5')} end as adid",
        "case when event_type = 'signup' and event_id % 3 = 0 then null"
        f" else {_text('user_id')} end as user_id",
        "case when event_id % 5 = 0 then null"
        f" else 's' || {_text('event_id % 400')} end as session_id",
        f"case when event_id % 10 = 5 then 'u' || {_text('event_id % 400')} end as session_uuid",
        f"case when event_id % 71 = 0 then ' ' else {_text('event_id % 13')} end as event_key",
        "case event_id % 4 when 0 then 'ios' when 1 then 'android' when 2 then 'web'"
        " else 'N/A' end as platform",
        "case event_id % 7 when 0 then 'ru' when 1 then 'unknown' when 2 then null"
        " else 'US' end as region",
        f"case when ts >= timestamp_ntz'{CHANGE_DAY}' and event_id % 2 = 0 then null"
        f" else 'v' || {_text('event_id % 3')} end as client_version",
        "cast(null as string) as legacy_flag",
        f"{_text('event_id % 6')} as step",
    ).select(
        "*", F.col("event_date_ltz").cast("timestamp_ntz").alias("event_date")
    ).drop("event_date_ltz")


def event_source(spark: SparkSession, folder: str, time_column: str = "event_date") -> EventSource:
    """The view as a source.  Its hour and its exact time lie on the same side of every
    bound on a full hour, so the exact time, which the file stores, prunes the scan."""
    prune = "created_at" if time_column == "event_date" else None
    return EventSource(
        event_view(spark, folder),
        name_column="event_table",
        time_column=time_column,
        prune_column=prune,
    )


#: The event of a payload; that of errors has no parsed table, and their table no source.
NAMED = "case event_type when 'error' then 'other_' else 'event_' end || event_type"


def payload_view(spark: SparkSession, folder: str) -> DataFrame:
    body = (
        f"'{{\"type\":\"app.ns.' || {NAMED} || '\",\"params\":{{\"k\":'"
        f" || {_text('event_id % 50')} || ',\"session_uuid\":'"
        f" || case when event_id % 9 = 0 then 'null' else '\"s' || {_text('event_id % 400')}"
        " || '\"' end || ',\"region\":\"US\",\"price\":'"
        f" || {_text('event_id % 7')} || '.5,\"vip\":true}}}}'"
    )
    return (
        table(spark, folder, "events")
        .selectExpr(
            "event_id as row_id",
            "ts as event_time",
            "case when event_id % 101 = 0 then 'not json'"
            " when event_id % 103 = 0 then"
            f" '{{\"type\":\"app.ns.' || {NAMED} || '\",\"params\":null}}'"
            " when event_id % 107 = 0 then '{\"params\":{\"k\":1}}'"
            f" else {body} end as payload",
            "case when event_id % 3 = 0 then '' else 'live' end as mode",
        )
    )


def dead_letter_view(spark: SparkSession, folder: str) -> DataFrame:
    legacy = (
        "'{\"event\":{\"name\":\"legacy.event_' || event_type || '\",\"parameters\":{\"k\":1}},"
        "\"validationErrors\":[\"unknown event\",\"code ' "
        f"|| {_text('event_id % 3')} || '\"],\"rejectedAt\":\"2024-01-0'"
        f" || {_text('1 + event_id % 9')} || 'T00:00:00Z\"}}'"
    )
    return (
        table(spark, folder, "events")
        .selectExpr(
            "event_id as row_id",
            "ts as event_time",
            "case when event_id % 500 = 0 then '{broken'"
            " when event_id % 100 = 0 then"
            " '{\"type\":\"app.event_' || event_type || '\",\"params\":{\"k\":1}}'"
            " when event_id % 150 = 0 then '[1,2]'"
            f" else {legacy} end as payload",
        )
    )
