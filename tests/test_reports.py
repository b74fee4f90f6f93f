from datetime import datetime, timedelta

from conftest import rows

from eventgauge import EventSource, Settings, Windows
from eventgauge.operators import drilldown, findings
from eventgauge.plans import quality_run
from eventgauge.sources import artifacts
from eventgauge.sources.catalog import (
    TableEntry,
    catalog_entries,
    event_sources,
    select_event_tables,
    table_inventory,
)
from eventgauge.sources.events import canonical_events, event_times

DAY = datetime(2024, 1, 5)
WINDOWS = Windows.of("7 days", "14 days", "2024-01-08")
SCHEMA = (
    "event_table string, event_date timestamp_ntz, adid string, user_id string, "
    "session_id string, event_key string, platform string, step string"
)


def events(spark, data):
    source = EventSource(spark.createDataFrame(data, SCHEMA), name_column="event_table")
    return canonical_events([source], Settings(), WINDOWS)


# -- drill-downs -------------------------------------------------------------
def test_duplicate_samples_of_a_hot_group(spark):
    hot = [("a", DAY, "x", f"u{i % 300}", "s", "k", "web" if i % 3 else "ios", "1") for i in range(900)]
    tie = [("a", DAY, "y", "u", "s", "k", p, None) for p in ("web", "ios")]
    single = [("a", DAY, "z", "u", "s", "k", "web", "1")]
    got = drilldown.duplicate_samples(events(spark, hot + tie + single)).orderBy("rank").collect()
    assert [(r.adid, r.rows_same_event_key_adid_time, r.unique_main_identifiers) for r in got] == [
        ("x", 900, 300), ("y", 2, 1),
    ]
    assert [(r.most_common_platform, r.most_common_step, r.most_common_region) for r in got] == [
        ("web", "1", "NO_COLUMN"), ("ios", "NULL", "NO_COLUMN"),
    ]


def test_samples_are_cut_per_table_only_at_the_limit(spark):
    data = [
        (t, DAY, f"x{g}", "u", "s", "k", "web", "1") for t in "ab" for g in range(6) for _ in range(2 + g)
    ]
    got = drilldown.duplicate_samples(events(spark, data), limit=4)
    assert rows(got, "event_table", "rows_same_event_key_adid_time") == [
        (t, n) for t in "ab" for n in (4, 5, 6, 7)
    ]


def test_burst_samples(spark):
    data = [("a", DAY, "x", "u", "s", str(k), "web", str(k % 2)) for k in range(5)]
    data += [("a", DAY, "x", "u", None, None, "ios", "9"), ("a", DAY, "q", "u", "s", "1", "web", "1")]
    row = drilldown.burst_samples(events(spark, data), 3).first()
    assert (row.rows_same_second, row.unique_event_keys, row.most_common_platform) == (5, 5, "web")
    # Every step and type is a row with its count; rows without a key do not belong to the group.
    labels = drilldown.burst_labels(events(spark, data), 3)
    assert rows(labels, "label", "value", "n") == [
        ("step", "0", 3), ("step", "1", 2), ("type", "NO_COLUMN", 5),
    ]


def test_missing_ids_and_expectation(spark):
    data = [("a", DAY, "x", None, "s", "k", "web", "1"), ("a", DAY, "x", "u", None, "k", "web", None)]
    data += [("a", DAY, "x", "u", "s", "k", "web", "2"), ("b", DAY, "x", None, None, "k", "web", "2")]
    found = drilldown.missing_ids_by_step(events(spark, data), ["a"])
    assert rows(found, "step", "type", "missing_main_identifier_pct", "missing_session_id_pct") == [
        ("1", "NO_COLUMN", 1.0, 0.0), ("NULL", "NO_COLUMN", 0.0, 1.0),
    ]
    # One allowance does not hide the other identifier.
    settings = Settings({"event_groups": {"missing_main_identifier_allowed": ["a"]}})
    assert rows(findings.missing_id_expectation(found, settings), "identifier", "expectation") == [
        ("session identifier", "unexpected"), ("user_id", "expected"),
    ]


def test_findings_hold_every_step_that_lacks_identifiers(spark):
    data = [("a", DAY, "x", None, "s", "k", "web", f"{i:03}") for i in range(130)]
    source = EventSource(spark.createDataFrame(data, SCHEMA), name_column="event_table")
    settings = Settings(
        {"date_range": "7 days", "lookback": "14 days", "drilldown": {"missing_id_tables": ["a"]}}
    )
    out = quality_run.run(spark, [source], settings, reference="2024-01-08")
    steps = out["findings"].filter("issue like '%_missing_identifier' and step is not null")
    assert rows(steps, "step") == [(f"{i:03}",) for i in range(130)]
    # The drill-down shows the largest ones.
    assert out["missing_ids_by_step"].count() == 100


def test_future_samples(spark):
    data = [("a", DAY + timedelta(days=30, hours=h), "x", "u", "s", "k", "web", "1") for h in range(5)]
    source = EventSource(spark.createDataFrame(data, SCHEMA), name_column="event_table")
    got = drilldown.future_samples(event_times([source], WINDOWS), WINDOWS, 10, limit=2)
    assert rows(got, "event_time", "checked_at") == [
        (DAY + timedelta(days=30, hours=h), "2024-01-08 00:00:00") for h in (3, 4)
    ]


METRICS = (
    "event_table string, rows_in_range long, duplicate_rows long, same_second_burst_rows long, "
    "future_event_time_rows long, status string"
)


def test_candidates(spark):
    metrics = spark.createDataFrame(
        [
            ("a", 100, 1, 50, 0, "x"), ("b", 100, 2, 0, 0, "ok"), ("c", 0, None, None, 3, "no_rows_in_range"),
            ("d", 100, 0, 0, 0, "y"), ("debug_e", 1, 1, 0, 0, "x"),
        ],
        METRICS,
    )
    settings = Settings({"event_groups": {"same_second_allowed": ["a"]}, "table_blacklist": ["DEBUG_*"]})
    got = drilldown.candidates(metrics, settings).collect()
    assert [(r.event_table, r.score) for r in got] == [("c", 3.0), ("b", 0.02), ("a", 0.01)]
    assert rows(drilldown.flagged_tables(metrics, settings)) == [("a", "x"), ("d", "y")]


# -- findings ----------------------------------------------------------------
PARAMETERS = (
    "event_table string, parameter string, status string, problem string, missing_pct double, "
    "report_priority string, profile_schema_parameter boolean"
)


def test_priority_is_not_hidden_by_order(spark):
    normal = [(f"event_{i:02d}", "optional", "problem", "missing_values", 1.0, "normal", False) for i in range(30)]
    urgent = [("event_show", "event_name", "problem", "missing_values", 0.0484, "extreme", True)]
    status = spark.createDataFrame(normal + urgent, PARAMETERS)
    assert findings.prioritized(status).first().parameter == "event_name"
    groups = findings.problem_groups(status).collect()
    assert [(g.parameter, g.affected_events, g.problems) for g in groups] == [
        ("event_name", 1, "missing_values"), ("optional", 30, "missing_values"),
    ]
    assert findings.problem_groups(status, 1).count() == 1


def test_unpopulated_columns_are_grouped(spark):
    names = [f"p{i:02d}" for i in range(14)]
    status = spark.createDataFrame(
        [("a", n, "problem", "unpopulated_column,invalid_values", 1.0, "normal", False) for n in names], PARAMETERS
    )
    row = findings.unpopulated_groups(status).first()
    assert (row.columns_unpopulated, row.not_shown) == (14, 2)
    assert row.preview == ", ".join(names[:12])


def run(spark, data, config, **more):
    source = EventSource(spark.createDataFrame(data, SCHEMA), name_column="event_table")
    idle = EventSource(spark.createDataFrame([], "event_date timestamp_ntz, adid string"), name="event_revenue")
    return quality_run.run(spark, [source, idle], Settings(config), "2024-01-08", **more)


CONFIG = {"date_range": "7 days", "lookback": "14 days"}


def test_no_rows_without_flow_evidence_is_not_guessed(spark):
    data = [("event_a", DAY, "x", "u", "s", str(i), "web", "1") for i in range(10)]
    report = run(spark, data, CONFIG)["findings"].collect()
    idle = [r for r in report if r.event_table == "event_revenue" and r.issue.startswith("no_rows")]
    assert [(r.section, r.severity) for r in idle] == [("investigate", "normal")]
    assert not [r for r in report if r.section == "critical_delivery"]


def test_flow_evidence_explains_missing_events(spark, tmp_path):
    data = [("event_a", DAY, "x", "u", "s", str(i), "web", "1") for i in range(10)]
    raw = spark.createDataFrame(
        [(DAY, '{"type":"x.event_revenue","params":{"price":1.5}}')] * 3, "event_time timestamp_ntz, payload string"
    )
    out = run(spark, data, CONFIG, raw=raw, contract={"schema_version": 3, "events": {}})
    report = out["findings"].collect()
    delivery = [(r.section, r.issue, r.severity) for r in report if r.event_table == "event_revenue" and r.rank]
    assert ("low_delivery", "low_raw_seen_but_parsed_missing", "low") in delivery
    assert not [d for d in delivery if d[1] == "no_rows_unclassified"]
    assert rows(out["dlq_tables_missing"]) == [("source_events_dlq",)]
    assert rows(out["contract_additions"], "event_table", "parameter", "type") == [
        ("event_revenue", "price", "Float64")
    ]
    written = artifacts.write_run(out, str(tmp_path), "20240108_000000")
    for name, path in written.items():
        back = artifacts.read_artifact(spark, str(tmp_path), name)
        assert back.drop("run_id").count() == out[name].count(), (name, path)


def test_sections_are_ordered_and_capped(spark):
    schema = (
        "event_table string, section string, source_rank int, order_key double, parameter string, "
        "step string, issue string, metric string, value double, rows long, severity string"
    )
    data = [(f"t{i:03d}", "expected", 1, float(-i), None, None, "x", "m", None, 1, "normal") for i in range(40)]
    whole = findings.sectioned(spark.createDataFrame(data, schema))
    assert whole.count() == 40
    got = findings.short_report(whole).orderBy("rank").collect()
    assert [r.event_table for r in got] == [f"t{i:03d}" for i in range(39, 27, -1)]


# -- inventory and artifacts ---------------------------------------------------
def test_inventory(spark):
    entries = [
        TableEntry("event_a", spark.range(3).selectExpr("id", "timestamp'2024-01-01' event_date", "'x' adid")),
        TableEntry("event_b", spark.range(5).selectExpr("date'2024-01-01' event_date", "'x' session_uuid")),
        TableEntry("event_c", spark.range(9).selectExpr("timestamp'2024-01-01' created_at"), engine="VIEW"),
        TableEntry("must", spark.range(1).toDF("id")),
    ]
    got = table_inventory(spark, entries, Settings(), limit=2, mandatory=["must"]).collect()
    assert [(r.table_name, r.estimated_rows, r.measurement_time_column) for r in got] == [
        ("must", 1, None), ("event_c", 9, "created_at"), ("event_b", 5, None),
    ]
    assert got[2].has_session_id and not got[2].has_adid
    assert [s.name for s in event_sources(entries, ["event_a", "event_b", "event_c", "gone"])] == ["event_a"]


def test_catalogue_to_run(spark):
    spark.sql("create database if not exists quality_test")
    data = [("event_a", DAY, "x", "u", "s", str(i), "web", "1") for i in range(4)]
    frame = spark.createDataFrame(data, SCHEMA).drop("event_table")
    for name in ("event_a", "event_debug_b", "other"):
        frame.write.mode("overwrite").saveAsTable(f"quality_test.{name}")
    spark.sql("create or replace view quality_test.event_view as select * from quality_test.event_a")
    settings = Settings({**CONFIG, "table_blacklist": ["EVENT_DEBUG_*"]})
    entries = catalog_entries(spark, "quality_test", settings)
    assert sorted(e.name for e in entries) == ["event_a", "event_debug_b", "event_view"]
    sizes = {r.table_name: r.estimated_rows for r in table_inventory(spark, entries, settings).collect()}
    chosen = select_event_tables(sizes, settings).chosen
    sources = event_sources(entries, chosen)
    assert sorted(s.name for s in sources) == ["event_a", "event_debug_b"]
    out = quality_run.run(spark, sources, settings, "2024-01-08")
    assert rows(out["event_quality"], "event_table", "rows_in_range") == [("event_a", 4)]
    assert {r.event_table for r in out["parameter_quality"].collect()} == {"event_a"}
    assert "inferred_contract" in out


def test_artifacts_replace_one_run_and_keep_others(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([("a", ["x"], 1)], "event_table string, tags array<string>, n long")
    for fmt in artifacts.FORMATS:
        name = f"quality_{fmt}"
        artifacts.write_artifact(frame, root, name, "20240101_000000", fmt)
        artifacts.write_artifact(frame.union(frame), root, name, "20240102_000000", fmt)
        artifacts.write_artifact(frame, root, name, "20240102_000000", fmt)
        assert artifacts.read_artifact(spark, root, name, fmt=fmt).count() == 1
        first = artifacts.read_artifact(spark, root, name, "20240101_000000", fmt)
        assert [r.run_id for r in first.collect()] == ["20240101_000000"]
    path = f"{root}/contract"
    artifacts.create_once(frame, path)
    artifacts.create_once(frame.union(frame), path)
    assert spark.read.json(path).count() == 1
