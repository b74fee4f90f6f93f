from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st

from eventgauge import EventSource, Settings, Windows
from eventgauge.operators import events as E
from eventgauge.operators import status
from eventgauge.sources.events import (
    canonical_events,
    event_times,
    measurement_time_column,
    table_profiles,
)

DAY = datetime(2024, 1, 5)
SCHEMA = (
    "event_table string, event_date timestamp_ntz, adid string, user_id string, "
    "session_id string, event_key string, step string"
)


def source(spark, data):
    return EventSource(spark.createDataFrame(data, SCHEMA), name_column="event_table")


def test_time_column_order_and_type(spark):
    def of(schema):
        return measurement_time_column(spark.createDataFrame([], schema).schema)

    assert of("created_at timestamp_ntz, event_date date") == "created_at"
    assert of("loaded_at timestamp, event_date timestamp_ntz") == "event_date"
    assert of("event_date string, ts timestamp") is None


def test_source_needs_one_name(spark):
    with pytest.raises(ValueError):
        EventSource(spark.range(1))
    with pytest.raises(ValueError):
        EventSource(spark.range(1), name="a", name_column="b")


def brute(events):
    """Duplicates, replicated and burst rows, by counting in Python."""
    groups = Counter(
        (t, when, adid, key) for t, when, adid, key in events if adid is not None and key is not None
    )
    duplicates, bursts, keys, totals = Counter(), Counter(), defaultdict(set), Counter()
    seconds = defaultdict(list)
    for (table, when, adid, key), n in groups.items():
        duplicates[table] += n - 1
        keys[table].add(key)
        totals[table] += 1
        seconds[table, when, adid].append(n)
    for (table, _, _), counts in seconds.items():
        bursts[table] += sum(counts) if len(counts) > 3 else 0
    return sorted(
        (t, duplicates[t], totals[t] - len(keys[t]), bursts[t]) for t in totals
    )


@hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]), st.integers(0, 2),
            st.sampled_from(["x", "y", None, ""]), st.sampled_from([*"12345", None, "null"]),
        ),
        min_size=1, max_size=60,
    )
)
def test_anomalies_match_brute_force(spark, drawn):
    data = [(t, DAY + timedelta(hours=h), a, None, None, k, None) for t, h, a, k in drawn]
    windows = Windows.of("7 days", "14 days", "2024-01-08")
    events = canonical_events([source(spark, data)], Settings(), windows)
    expected = brute([
        (t, h, a if a else None, None if k == "null" else k) for t, h, a, k in drawn
    ])
    columns = ("event_table", "duplicate_rows", "replicated_rows", "same_second_burst_rows")
    assert rows(E.anomaly_counts(events, 3), *columns) == expected
    single = E.duplicate_rows(events).join(E.replicated_rows(events), "event_table")
    assert rows(single.join(E.burst_rows(events, 3), "event_table"), *columns) == expected
    firsts = E.burst_annotation(events).filter("is_first_key and unique_event_keys > 3")
    assert sum(r.rows_in_second for r in firsts.collect()) == sum(e[3] for e in expected)


def test_anomalies_hold_a_group_once(spark):
    """Groups are not expanded: a task that counts them has no second copy by their key."""
    seconds = [(DAY + timedelta(seconds=i % 7), f"a{i % 3}", f"k{i % 11}") for i in range(200)]
    data = spark.createDataFrame(seconds, "event_time timestamp_ntz, adid string, event_key string")
    events = data.selectExpr("if(adid = 'a0', 'event_a', 'event_b') as event_table", "*")
    found = E.anomaly_counts(events, 3)
    for single in (E.duplicate_rows(events), E.replicated_rows(events), E.burst_rows(events, 3)):
        assert rows(single) == rows(found, *single.columns)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_one_hot_second_is_counted_whole(spark):
    """A third of all rows in one second of one identifier, most of them one key."""
    hot = [("a", DAY, "bot", "u", "s", str(i % 7), "1") for i in range(700)]
    rest = [("a", DAY + timedelta(minutes=i), f"p{i}", "u", "s", "k", "1") for i in range(1400)]
    windows = Windows.of("7 days", "14 days", "2024-01-08")
    events = canonical_events([source(spark, hot + rest)], Settings(), windows)
    row = E.anomaly_counts(events, 3).first()
    assert (row.duplicate_rows, row.same_second_burst_rows) == (693, 700)
    assert row.replicated_rows == (7 + 1400) - 8


def test_hot_second_is_split_in_the_join(spark):
    hot = [("a", DAY, "bot", "u", "s", f"key number {i}", "1") for i in range(6000)]
    rest = [("a", DAY + timedelta(minutes=i), f"p{i}", "u", "s", "k", "1") for i in range(2000)]
    held = spark.createDataFrame(hot + rest, SCHEMA).repartition(16)
    windows = Windows.of("7 days", "14 days", "2024-01-08")
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        source_of = EventSource(held, name_column="event_table")
        found = E.burst_annotation(canonical_events([source_of], Settings(), windows))
        assert len(found.collect()) == 8000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_step_exceptions_and_skips(spark):
    data = [
        ("a", DAY, None, None, None, "k", "1"), ("a", DAY, None, None, None, "k", "2"),
        ("a", DAY, None, None, None, "k", None), ("b", DAY, None, None, None, "k", None),
    ]
    config = Settings({
        "event_context": {"a": {"step_exceptions": {"1": {"skip_adid_check": True}}}},
        "event_groups": {"missing_main_identifier_allowed": ["b"]},
    })
    windows = Windows.of("7 days", "14 days", "2024-01-08")
    events = canonical_events([source(spark, data)], config, windows)
    got = rows(
        E.missing_identifiers(events, config),
        "event_table", "missing_adid_rows", "missing_main_identifier_rows", "missing_session_id_rows",
    )
    # Steps 1 and NULL are kept out in table a; b has no exceptions.
    assert got == [("a", 1, 3, 3), ("b", 1, None, 1)]


def measured(spark, sources, config, reference="2024-01-08"):
    windows = Windows.of("7 days", "14 days", reference)
    return E.event_metrics(
        canonical_events(sources, config, windows), event_times(sources, windows),
        table_profiles(sources, config), windows, config,
    )


def test_metrics_for_absent_columns_and_empty_tables(spark):
    full = source(spark, [("a", DAY, "x", "u", "s", "k", "1")] * 3)
    bare = EventSource(
        spark.createDataFrame([(DAY, "v")], "created_at timestamp_ntz, value string"), name="bare"
    )
    idle = EventSource(
        spark.createDataFrame([(datetime(2020, 1, 1), "x")], "event_date timestamp, adid string"),
        name="idle",
    )
    metrics = measured(spark, [full, bare, idle], Settings())
    flagged = status.event_status(metrics, Settings())
    got = {r.event_table: r for r in flagged.collect()}
    assert got["a"].duplicate_rows == 2 and "duplicate_high" in got["a"].status
    assert got["bare"].missing_adid_rows is None and got["bare"].duplicate_rows is None
    assert got["idle"].rows_in_range == 0 and got["idle"].status == "no_rows_in_range"
    scanned = status.scan_problems(
        status.problem_signal(metrics.selectExpr("*", "rows_in_range as rows_total"), Settings()),
        Settings(),
    )
    warnings = {r.event_table: r.schema_warnings for r in scanned.collect()}
    assert warnings["bare"] == [
        "Missing adid column", "Missing event_key column",
        "Missing main identifier column (accepted: user_id)",
        "Missing session identifier column (accepted: session_id, session_uuid, sessions_uuid)",
    ]


def test_future_rows_can_be_switched_off(spark):
    late = source(spark, [("a", DAY + timedelta(days=30), "x", "u", "s", "k", "1")])
    on = measured(spark, [late], Settings()).first()
    assert on.future_event_time_rows == 1
    off_settings = Settings({"quality_definitions": {"future_event_time": {"enabled": False}}})
    off = measured(spark, [late], off_settings)
    assert off.first().future_event_time_rows == 0
    issues = {r.issue for r in status.classified_findings(off, off_settings).collect()}
    assert "future_event_time_check_disabled" in issues


METRICS = (
    "event_table string, rows_in_range long, expected_rows_from_lookback double, "
    "delta_vs_lookback_expected double, duplicate_pct double, replicated_pct double, "
    "same_second_burst_pct double, missing_adid_pct double, missing_main_identifier_pct double, "
    "missing_session_id_pct double, missing_event_key_pct double, duplicate_rows long, "
    "replicated_rows long, same_second_burst_rows long, missing_adid_rows long, "
    "missing_main_identifier_rows long, missing_session_id_rows long, missing_event_key_rows long, "
    "future_event_time_rows long"
)


def classified(spark, config=None, **values):
    names = [part.split()[0] for part in METRICS.split(", ")]
    row = tuple({"event_table": "t", "rows_in_range": 1, **values}.get(n) for n in names)
    frame = spark.createDataFrame([row], METRICS)
    return {(r.classification, r.issue) for r in
            status.classified_findings(frame, Settings(config or {})).collect()}


def test_classification_guards(spark):
    tiny = classified(spark, expected_rows_from_lookback=0.033, delta_vs_lookback_expected=29.0)
    assert not tiny
    both = classified(spark, expected_rows_from_lookback=50.0, delta_vs_lookback_expected=-0.5)
    assert both == {("investigate", "suspicious_low")}
    new = classified(spark, rows_in_range=100, expected_rows_from_lookback=2.0)
    assert new == {("investigate", "new_activity")}
    assert classified(spark, rows_in_range=0) == {("confirmed", "no_rows")}
    allowed = {"event_groups": {"missing_session_id_allowed": ["t"]}}
    got = classified(spark, allowed, missing_session_id_pct=0.5, missing_main_identifier_pct=0.5)
    assert got == {
        ("expected", "missing_session_id_high"), ("confirmed", "missing_main_identifier_high"),
    }
