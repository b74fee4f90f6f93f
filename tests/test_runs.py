"""What lives from run to run: names, versions, contracts, committed runs; ranks and facts."""

from datetime import date, datetime, timedelta

import pytest
from conftest import rows

from eventgauge import EventSource, Settings, Windows
from eventgauge.operators import contracts, flow, history, parameters
from eventgauge.operators import events as E
from eventgauge.operators.ranks import ranked
from eventgauge.plans import quality_run
from eventgauge.sources import artifacts, names, payloads
from eventgauge.sources import events as events_mod
from eventgauge.sources.catalog import TableEntry, shared_sources, table_inventory
from eventgauge.sources.events import canonical_events, table_profiles, united
from eventgauge.sources.versions import Conflict, VersionedTable

DAY = datetime(2024, 1, 5)
SCHEMA = (
    "event_table string, event_date timestamp_ntz, adid string, user_id string, "
    "session_id string, event_key string"
)
CONFIG = {"date_range": "2 days", "lookback": "7 days"}


def source(spark, data, **more):
    return EventSource(spark.createDataFrame(data, SCHEMA), name_column="event_table", **more)


def event(table, when, key="1"):
    return (table, when, "a", "u", "s", key)


# -- stopped event types ---------------------------------------------------------
def test_names_merge_and_stop(spark):
    old = [event("event_dead", DAY - timedelta(days=60)), event("event_a", DAY - timedelta(days=50))]
    new = [event("event_a", DAY), (None, DAY, "a", "u", "s", "1")]
    before = Windows.of("2 days", "7 days", DAY - timedelta(days=49))
    now = Windows.of("2 days", "7 days", DAY + timedelta(hours=1))
    known = names.seen_names([source(spark, old)], Windows.of("2 days", "30 days", DAY - timedelta(days=49)))
    seen = names.seen_names([source(spark, old + new)], now)
    assert rows(seen, "event_table", "last_day") == [("event_a", date(2024, 1, 5))]
    merged = names.merged_names(known, seen)
    assert rows(merged, "event_table", "first_day", "last_day") == [
        ("event_a", date(2023, 11, 16), date(2024, 1, 5)), ("event_dead", date(2023, 11, 6), date(2023, 11, 6)),
    ]
    assert rows(names.stopped_names(merged, seen), "event_table") == [("event_dead",)]
    assert rows(names.merged_names(None, seen), "event_table") == [("event_a",)]
    assert before.lookback  # the earlier windows are of the same kind


def test_a_listed_table_without_rows_is_known(spark):
    listed = source(spark, [], tables=("event_x",))
    single = EventSource(spark.createDataFrame([], SCHEMA).drop("event_table"), name="event_y")
    found = names.seen_names([listed, single], Windows.of("2 days", "7 days", DAY))
    assert rows(found, "event_table", "last_day") == [("event_x", None), ("event_y", None)]


def test_stopped_types_are_judged_from_run_to_run(spark, tmp_path):
    state, root = str(tmp_path / "state"), str(tmp_path / "out")
    data = [event("event_a", DAY, str(i)) for i in range(4)]
    data += [event("event_dead", DAY - timedelta(days=40))]
    settings = Settings(CONFIG)

    def finish(run_id, reference):
        upto = [r for r in data if r[1] < reference]
        quality_run.run_and_write(
            spark, root, run_id, state=state, sources=[source(spark, upto)], settings=settings, reference=reference
        )

    finish("r1", DAY - timedelta(days=39))
    finish("r2", DAY + timedelta(hours=1))
    found = artifacts.read_artifact(spark, root, "event_quality")
    got = {r.event_table: r for r in found.collect()}
    assert "no_rows_in_range" in got["event_dead"].status and got["event_dead"].rows_in_range == 0
    assert got["event_a"].rows_in_range == 4 and got["event_a"].run_id == "r2"
    assert rows(artifacts.read_artifact(spark, root, "stopped_event_tables"), "event_table") == [("event_dead",)]
    # A third run still knows it, though its own scan does not.
    finish("r3", DAY + timedelta(hours=2))
    assert rows(artifacts.read_artifact(spark, root, "stopped_event_tables"), "event_table") == [("event_dead",)]


def test_one_table_in_two_sources_is_one_row(spark):
    a = EventSource(spark.createDataFrame([event("event_a", DAY)], SCHEMA).drop("event_table"), name="event_a")
    b = EventSource(
        spark.createDataFrame([(DAY, "k")], "created_at timestamp_ntz, event_key string"), name="event_a"
    )
    windows, settings = Windows.of("2 days", "7 days", DAY + timedelta(hours=1)), Settings(CONFIG)
    from eventgauge.sources.events import event_times

    found = E.event_metrics(
        canonical_events([a, b], settings, windows), event_times([a, b], windows),
        table_profiles([a, b], settings, windows), windows, settings,
    ).collect()
    assert [(r.event_table, r.rows_in_range, r.has_adid, r.measurement_time_column) for r in found] == [
        ("event_a", 2, True, "created_at,event_date")
    ]


# -- versions --------------------------------------------------------------------
def test_versions_refuse_a_second_writer(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    assert one.current() == 0 and one.read() is None
    assert one.write(spark.range(2), 0) == 1
    assert two.write(spark.range(3), two.current()) == 2
    with pytest.raises(Conflict):
        one.write(spark.range(9), 1)
    # Both have read the same version, and the other one gets there first.
    current = one.current
    one.current = lambda: 1
    with pytest.raises(Conflict):
        one.write(spark.range(9), 1)
    one.current = current
    assert one.read().count() == 3 and one.read(1).count() == 2
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert not [p for p in (tmp_path / "t" / "versions").iterdir() if p.name.startswith("_")]


def test_contract_write_back(spark, tmp_path):
    document = {"schema_version": 3, "events": {"event_a": {"parameters": {"k": ["Int64", ["1"], "high"]}}}}
    store = VersionedTable(spark, str(tmp_path / "contract"))
    contract = contracts.contract_frame(spark, document)
    assert store.write(contract, 0) == 1

    def additions(*tables):
        return spark.createDataFrame(
            [("event", t, "p", "String", ["x"], "normal", False, False) for t in tables], contracts.CONTRACT_SCHEMA
        )

    assert contracts.written_back(store, 1, additions("event_a")) == 1
    assert contracts.written_back(store, 1, additions("event_new", "event_a")) == 2
    held = contracts.contract_document(store.read().collect())
    assert held["events"]["event_a"]["parameters"] == {"k": ["Int64", ["1"], "high"]}
    assert held["events"]["event_new"] == {"parameters": {"p": ["String", ["x"], "normal"]}, "required": False}
    edited = dict(document, events={**document["events"], "event_hand": {"parameters": {}}})
    assert store.write(contracts.contract_frame(spark, edited), 2) == 3
    with pytest.raises(Conflict):
        contracts.written_back(store, 2, additions("event_late"))
    assert "event_hand" in contracts.contract_document(store.read().collect())["events"]
    with pytest.raises(ValueError):
        contracts.written_back(VersionedTable(spark, str(tmp_path / "none")), 0, additions("x"))


def test_a_run_extends_the_stored_contract(spark, tmp_path):
    state = str(tmp_path / "state")
    store = VersionedTable(spark, f"{state}/contract")
    store.write(contracts.contract_frame(spark, {"schema_version": 3, "events": {"event_a": {"parameters": {}}}}), 0)
    raw = spark.createDataFrame(
        [(DAY, '{"type":"event_new","params":{"price":2}}')], "event_time timestamp_ntz, payload string"
    )
    for run_id in ("r1", "r2"):
        quality_run.run_and_write(
            spark, str(tmp_path / "out"), run_id, state=state, raw=raw, settings=Settings(CONFIG),
            sources=[source(spark, [event("event_a", DAY)])], reference=DAY + timedelta(hours=1),
        )
    assert store.current() == 2
    held = contracts.contract_document(store.read().collect())
    assert held["events"]["event_new"] == {"parameters": {"price": ["Int64", ["2"], "normal"]}, "required": False}


def test_a_run_that_dies_is_never_the_latest(spark, tmp_path):
    root, frame = str(tmp_path), spark.range(1)
    broken = frame.selectExpr("assert_true(id < 0) as x")
    artifacts.write_run({"a": frame, "b": frame}, root, "1")
    with pytest.raises(Exception):
        artifacts.write_run({"a": frame.union(frame), "b": broken}, root, "2")
    assert artifacts.read_artifact(spark, root, "a").count() == 1
    assert artifacts.latest_run(spark, root, "a") == "1"
    artifacts.write_run({"a": frame.union(frame)}, root, "2")
    assert artifacts.read_artifact(spark, root, "a").count() == 2
    assert artifacts.latest_run(spark, root, "b") == "1"
    # Writing a committed run again takes it back until it is whole.
    with pytest.raises(Exception):
        artifacts.write_run({"a": broken}, root, "2")
    assert artifacts.latest_run(spark, root, "a") == "1"
    with pytest.raises(FileNotFoundError):
        artifacts.read_artifact(spark, root, "c")


# -- ranks -----------------------------------------------------------------------
def test_ranks_of_a_group_that_fills_many_partitions(spark):
    adaptive, parts = (spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        data = [("hot", i, None) for i in range(3000)] + [("cold", i, "x") for i in range(5)] + [(None, 1, "x"), (None, 0, "x")]
        frame = spark.createDataFrame(data, "g string, n long, note string").repartition(7)
        found = ranked(frame, ["g"], ["n"], "rank", {"total": frame["n"]}).collect()
        want = {g: sorted(n for h, n, _ in data if h == g) for g in ("hot", "cold", None)}
        assert len(found) == len(data)
        for r in found:
            assert want[r.g][r.rank - 1] == r.n and r.total == sum(want[r.g])
        busy = [("e", DAY, "a", "u", "s", f"{i % 2000:05d}") for i in range(5000)]
        spread = E.burst_annotation(canonical_events([source(spark, busy)], Settings(), Windows.of("2 days", "7 days", DAY + timedelta(hours=1))))
        got = spread.collect()
        assert sorted((r.row_number, r.event_key) for r in got) == [(i + 1, f"{i:05d}") for i in range(2000)]
        assert {(r.rows_in_second, r.unique_event_keys) for r in got} == {(5000, 2000)}
        # No partition of the sorted groups, and so no task of the second phase, holds the hot second.
        plan = spread._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan.split("SortMergeJoin")[0].split("BroadcastHashJoin")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


# -- facts -----------------------------------------------------------------------
TEXTS = [
    '{"type":"e","params":{"session_id":"a","session_uuid":"b","k":1,"t":"x"}}', '{"type":"e","params":{"k":null,"t":""}}',
    '{"type":"e","params":{"sessions_uuid":0,"k":2.5,"":3}}', '{"type":"e","params":{}}', '{"type":"e","params":[1]}',
    '{"type":"e","params":null}', '{"type":"f"}', "broken", '{"type":"f","params":{"k":true,"o":{"a":[1]}}}',
]


def payload_frame(spark, texts, **more):
    data = [(DAY, t, "live" if i % 2 else "") for i, t in enumerate(texts)]
    table = payloads.PayloadTable("raw", spark.createDataFrame(data, "event_time timestamp_ntz, payload string, mode string"))
    return payloads.parsed(table, None, **more)


def test_facts_give_what_single_operators_give(spark):
    frame, settings = payload_frame(spark, TEXTS), Settings()
    facts = flow.payload_facts(frame, settings, frame["event_table"].isNotNull())
    assert rows(flow.summary_of(facts)) == rows(flow.source_summary(frame))
    assert rows(flow.modes_of(facts)) == rows(flow.source_modes(frame))
    columns = ["event_table", "parameter", "type", "raw_rows", "typed_rows"]
    assert rows(flow.types_of(facts), *columns) == rows(flow.raw_types(frame), *columns)
    assert rows(flow.presence_of(facts, settings)) == rows(flow.raw_presence(frame, settings))
    assert rows(flow.profile_of(facts)) == rows(flow.raw_profile(frame))
    assert rows(flow.contract_of(facts)) == rows(flow.raw_parameter_contract(frame))
    assert rows(flow.profile_of(flow.payload_facts(frame, settings))) == []
    assert rows(flow.payload_facts(payload_frame(spark, []), settings)) == []


def test_letter_facts_give_what_single_operators_give(spark):
    letters = payload_frame(
        spark,
        ['{"event":{"name":"p","parameters":{}},"validationErrors":["a","b","a"],"rejectedAt":"2"}',
         '{"event":{"name":"p"},"validationErrors":["b"],"rejectedAt":"1"}', '{"event":{"name":"p"}}', "{", "[1]"],
        dead_letter=True,
    )
    facts = flow.letter_facts(letters)
    assert rows(flow.dlq_errors_of(facts)) == rows(flow.dlq_errors(letters))
    got = rows(flow.dlq_summary_of(facts), "event_table", "dlq_shape", "n_modes", "dlq_rows", "event_parameters_rows",
               "validation_error_rows", "rejected_at_min", "rejected_at_max")
    assert got == [
        ("__UNKNOWN__", "invalid_json", 1, 1, 0, 0, "", ""), ("__UNKNOWN__", "unknown_json_shape", 0, 1, 0, 0, "", ""),
        ("p", "legacy_event_envelope", 1, 3, 1, 4, "1", "2"),
    ]


def test_a_run_parses_each_payload_once(spark, monkeypatch):
    """Every frame of a run that reads payloads stands on two kept frames of facts."""
    made = []
    keep = quality_run.kept

    def counted(frame):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        made.append(plan.count("parseJson") + plan.count("parse_json"))
        return keep(frame)

    monkeypatch.setattr(quality_run, "kept", counted)
    schema = "event_time timestamp_ntz, payload string"
    raw = spark.createDataFrame([(DAY, t) for t in TEXTS], schema)
    dlq = spark.createDataFrame([(DAY, '{"event":{"name":"p"},"validationErrors":["b"]}')], schema)
    out = quality_run.run(
        spark, [source(spark, [event("event_a", DAY)])], Settings(CONFIG), DAY + timedelta(hours=1), raw=raw,
        dead_letters={"source_events_dlq": dlq}, contract={"schema_version": 3, "events": {"event_a": {"parameters": {}}}},
    )
    assert sorted(n for n in made if n) == [1, 1]
    for name, frame in out.items():
        assert frame.count() >= 0, name
    for name in ("source_summary", "source_modes", "dlq_summary", "dlq_errors", "event_flow", "parameter_origin"):
        plan = out[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in plan or "parseJson" not in plan, name
    assert {r.event_table for r in out["contract_additions"].collect()} == {"e", "f"}


# -- catalogue -------------------------------------------------------------------
def test_catalogue_run_lists_what_was_left_out(spark):
    spark.sql("create database if not exists coverage_test")
    frame = spark.createDataFrame([event("x", DAY, str(i)) for i in range(4)], SCHEMA).drop("event_table")
    for name, n in (("event_a", 4), ("event_b", 2), ("event_c", 1)):
        frame.limit(n).write.mode("overwrite").saveAsTable(f"coverage_test.{name}")
    spark.range(3).write.mode("overwrite").saveAsTable("coverage_test.event_timeless")
    out = quality_run.run_catalog(spark, "coverage_test", Settings(CONFIG), limit=2, reference=DAY + timedelta(hours=1))
    assert rows(out["coverage"]) == [
        ("event_a", "scanned", False), ("event_b", "scanned", False), ("event_c", "not_scanned", False),
    ]
    assert rows(out["event_quality"], "event_table", "rows_in_range") == [("event_a", 4), ("event_b", 2)]
    assert out["inventory"].count() == 4
    whole = quality_run.run_catalog(spark, "coverage_test", Settings(CONFIG), reference=DAY + timedelta(hours=1))
    assert {r.coverage_complete for r in whole["coverage"].collect()} == {True}


def test_union_of_very_many_parts_is_shallow(spark):
    parts = [spark.range(1).selectExpr(f"{i} as n") for i in range(300)]
    assert united(parts).count() == 300


def test_five_hundred_tables_are_one_scan(spark, tmp_path):
    root = tmp_path / "tables"
    names_of = [f"event_{i:03d}" for i in range(500)]
    data = [event(name, DAY, str(k)) for i, name in enumerate(names_of) for k in range(1 + i % 3)]
    frame = spark.createDataFrame(data, SCHEMA)
    frame.withColumn("folder", frame["event_table"]).drop("event_table").repartition(4).write.partitionBy("folder").parquet(str(root))
    for path in root.glob("folder=*"):
        path.rename(root / path.name.removeprefix("folder="))
    schema = frame.drop("event_table").schema
    empty = spark.createDataFrame([], schema)
    entries = [TableEntry(n, empty, location=f"{root}/{n}") for n in names_of]
    other = spark.createDataFrame([(DAY,)] * 9, "created_at timestamp_ntz")
    entries += [TableEntry("event_other", other), TableEntry("event_known", other, rows=77)]
    small, large = (shared_sources(entries, chosen) for chosen in (names_of[:2], names_of))
    windows, settings = Windows.of("2 days", "7 days", DAY + timedelta(hours=1)), Settings(CONFIG)
    plans = [
        canonical_events(s, settings, windows)._jdf.queryExecution().optimizedPlan().toString().count("\n")
        for s in (small, large)
    ]
    assert len(large) == 1 and plans[0] == plans[1]
    counted = E.base_counts(canonical_events(large, settings, windows))
    assert {r.event_table: r.rows_total for r in counted.collect()} == {n: 1 + i % 3 for i, n in enumerate(names_of)}
    inventory = table_inventory(spark, entries, settings)
    got = {r.table_name: r.estimated_rows for r in inventory.collect()}
    assert got == {n: 1 + i % 3 for i, n in enumerate(names_of)} | {"event_other": 9, "event_known": 77}
    mixed = shared_sources(entries, [*names_of[:3], "event_other"])
    assert sorted((s.name or "", s.tables) for s in mixed) == [("", tuple(names_of[:3])), ("event_other", ())]


# -- sketches --------------------------------------------------------------------
def test_sketched_top_values(spark):
    config = Settings({**CONFIG, "date_range": "2024-01-04 to 2024-01-05"})
    windows = Windows.of("2024-01-04 to 2024-01-05", "7 days", "2024-01-06")
    data = [
        (DAY - timedelta(days=d, hours=1), f"p{min(int(1000 / (1 + i)), 40) if i % 2 else i}")
        for d in range(8) for i in range(300)
    ]
    frame = spark.createDataFrame(data, "event_date timestamp_ntz, platform string")
    sources = [EventSource(frame, name="event_a")]
    rules = {0: parameters.source_rules(sources[0], config, None, [])}
    exact = parameters.top_values(parameters.value_histogram(sources, rules, windows, config), 400)
    true = {(r.period, r.value): r.value_rows for r in exact.collect()}
    whole = parameters.daily_value_sketches(sources, rules, windows, config)
    found = parameters.merged_top_values(whole, windows, 400).collect()
    assert {(r.period, r.value): r.value_rows for r in found} == true
    # Stored days and new ones give the same, and old days are not read again.
    old = parameters.daily_value_sketches(sources, rules, windows, config).filter("day < date'2024-01-04'")
    new = parameters.daily_value_sketches(sources, rules, windows, config, since=date(2024, 1, 4))
    assert new.filter("day < date'2024-01-04'").isEmpty()
    again = parameters.merged_top_values(old.unionByName(new), windows, 400).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    # With far fewer places than values the frequent ones stay, within the rows let go.
    rough = parameters.daily_value_sketches(sources, rules, windows, config, tracked=64)
    for r in parameters.merged_top_values(rough, windows, 3).collect():
        n = sum(v for (period, _), v in true.items() if period == r.period)
        assert abs(r.value_rows - true[r.period, r.value]) <= 3.5 * n / 64
    with pytest.raises(ValueError):
        parameters.merged_top_values(whole, Windows.of("5 hours", "7 days", DAY), 3)


def test_top_values_beyond_the_sketches(spark):
    """A parameter with more values than a sketch tracks is counted, others come from sketches."""
    config = Settings({**CONFIG, "date_range": "2024-01-04 to 2024-01-05"})
    windows = Windows.of("2024-01-04 to 2024-01-05", "7 days", "2024-01-06")
    data = [
        (f"event_{'ab'[i % 2]}", DAY - timedelta(days=d, hours=1), f"p{i % 5}", f"r{i // 2 % (150 if i % 2 else 7) % (150 - d)}")
        for d in range(8) for i in range(600)
    ]
    frame = spark.createDataFrame(data, "event_table string, event_date timestamp_ntz, platform string, region string")
    sources = [EventSource(frame, name_column="event_table")]
    rules = {0: parameters.source_rules(sources[0], config, None, [])}
    wanted = parameters.top_values(parameters.value_histogram(sources, rules, windows, config), 4)
    columns = ("event_table", "parameter", "period", "rank", "value", "value_rows")
    for tracked in (64, 1000):
        days = parameters.daily_value_sketches(sources, rules, windows, config, tracked=tracked)
        found = parameters.exact_top_values(days, sources, rules, windows, config, 4, tracked)
        assert rows(found, *columns) == rows(wanted, *columns)
        assert (rows(parameters.merged_top_values(days, windows, 4), "value_rows") != rows(wanted, "value_rows")) == (tracked == 64)


# -- daily history ---------------------------------------------------------------
def test_history_counts_each_day_once(spark, tmp_path):
    config = Settings(CONFIG)
    data = [
        (f"event_{'ab'[i % 2]}", DAY - timedelta(days=d, hours=i), None if i % 3 else "x", "web" if i % 5 else "")
        for d in range(-3, 12) for i in range(20)
    ]
    frame = spark.createDataFrame(data, "event_table string, event_date timestamp_ntz, region string, platform string")
    rows_store = history.History(VersionedTable(spark, str(tmp_path / "rows")))
    state_store = history.History(VersionedTable(spark, str(tmp_path / "states")))
    asked = []
    for day in (DAY, DAY + timedelta(days=1), DAY + timedelta(days=1), DAY + timedelta(days=3)):
        windows = Windows.of("2 days", "7 days", day)
        visible = [EventSource(frame.filter(frame["event_date"] < day + timedelta(hours=5)), name_column="event_table")]
        rules = {0: parameters.source_rules(visible[0], config, None, [])}

        def counted(first, windows=windows, visible=visible):
            asked.append(first)
            return history.daily_rows(visible, windows, first)

        days = rows_store.extended(windows, counted)
        whole = E.volume(events_mod.event_times(visible, windows, "scope"), windows)
        assert rows(history.volume_of(days, windows)) == rows(whole)
        states = state_store.extended(
            windows, lambda first, w=windows, v=visible, r=rules: history.daily_states(v, r, w, config, first)
        )
        direct = parameters.parameter_metrics(visible, rules, windows, config)
        assert rows(history.parameter_metrics_of(states, windows)) == rows(direct)
    # The first run reads all, each later one from the first day that is not stored yet.
    assert asked == [None, date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 6)]
    assert rows_store.store.current() == 3
    with pytest.raises(ValueError):
        history.volume_of(days, Windows.of("5 hours", "7 days", DAY))
    late = history.daily_rows(visible, windows, date(2024, 1, 6))
    scan = late._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-06 00:00:00" in scan
