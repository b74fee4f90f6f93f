from datetime import datetime

import pytest
from conftest import rows

from eventgauge import Settings
from eventgauge.operators import contracts, flow
from eventgauge.sources import payloads
from eventgauge.sources.events import without_blacklisted

WHEN = datetime(2024, 1, 5)


def parsed(spark, texts, dead_letter=False, **extra):
    schema = "event_time timestamp_ntz, payload string" + "".join(f", {n} string" for n in extra)
    data = [(WHEN, t, *[extra[n][i] for n in extra]) for i, t in enumerate(texts)]
    table = payloads.PayloadTable("raw", spark.createDataFrame(data, schema))
    return payloads.parsed(table, None, dead_letter)


def test_payload_tables_need_their_columns(spark):
    with pytest.raises(ValueError):
        payloads.PayloadTable("raw", spark.createDataFrame([], "payload string"))
    found, missing = payloads.known_tables({}, ["a", "b"])
    assert (found, missing) == ([], ["a", "b"])


def test_physical_type_and_mode(spark):
    texts = ['{"type":"a.show"}', '{"type":"a.show"}', '{"type":7}', "no"]
    frame = parsed(spark, texts, type=["x.click", "", None, "x.y.login"], mode=["live", None, "", "test"])
    got = rows(frame, "event_table", "raw_type", "mode", "valid")
    assert got == [
        ("__UNKNOWN__", "", "", True), ("click", "x.click", "live", True),
        ("login", "x.y.login", "test", False), ("show", "a.show", "", True),
    ]
    summary = rows(flow.source_summary(frame), "event_table", "n_modes", "invalid_json_rows", "missing_params_object_rows")
    assert ("login", 1, 1, 0) in summary and ("click", 1, 0, 1) in summary


def test_source_summary_lists_modes(spark):
    texts = ['{"type":"a.show"}'] * 5 + ['{"type":"b.hide"}']
    frame = parsed(spark, texts, mode=["test", None, "live", "", "test", None])
    wanted = [("hide", [], 0, 1), ("show", ["live", "test"], 2, 5)]
    assert rows(flow.source_summary(frame), "event_table", "modes", "n_modes", "raw_rows") == wanted
    facts = flow.payload_facts(frame, Settings())
    assert rows(flow.summary_of(facts), "event_table", "modes", "n_modes", "raw_rows") == wanted


def test_name_filter_does_not_repeat_parsing(spark):
    frame = parsed(spark, ['{"type":"a"}'])
    filtered = without_blacklisted(frame, Settings({"table_blacklist": ["debug_*"]}))
    plan = filtered.select("event_table", "body")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_raw_types_and_examples(spark):
    values = {
        "whole": ["1", "2"], "long": ["12345678901234567890123", "1"], "real": ["1.5", "2"],
        "flag": ["true", "null"], "mixed": ["true", "1"], "text": ['"a"', '""'], "nested": ["[1]", "{}"],
        "empty": ["null", '""'], "dotted": ["1.0", "3"],
    }
    texts = [
        '{"type":"e","params":{' + ",".join(f'"{k}":{v[i]}' for k, v in values.items()) + "}}"
        for i in range(2)
    ] + ['{"type":"e","params":[1,2]}', '{"type":"e","params":null}', "broken"]
    frame = parsed(spark, texts)
    got = {r.parameter: r.type for r in flow.raw_types(frame).collect()}
    assert got == {
        "whole": "Int64", "long": "Int64", "real": "Float64", "flag": "UInt8", "mixed": "String",
        "text": "String", "nested": "String", "empty": "String", "dotted": "Float64",
    }
    shown = {r.parameter: r.examples for r in flow.raw_parameter_contract(frame).collect()}
    assert shown["text"] == ["a"] and shown["flag"] == ["true"] and shown["whole"] == ["1", "2"]


def test_presence_counts_a_row_once(spark):
    texts = [
        '{"type":"e","params":{"session_id":"a","session_uuid":"b"}}',
        '{"type":"e","params":{"session_id":null,"session_uuid":""}}',
        '{"type":"e","params":{"sessions_uuid":0,"k":{}}}',
    ]
    frame = parsed(spark, texts)
    assert rows(flow.raw_presence(frame, Settings())) == [("e", "k", 1), ("e", "session_id", 2)]
    only = spark.createDataFrame([("other",)], "event_table string")
    assert rows(flow.raw_presence(frame, Settings(), only)) == []


def test_dead_letters(spark):
    texts = [
        '{"event":{"name":"x.pay","parameters":{}},"validationErrors":["a","b","a"],"rejectedAt":"2024-01-02"}',
        '{"event":{"name":"x.pay"},"validationErrors":["b"],"rejectedAt":"2024-01-01"}', "{",
    ]
    frame = parsed(spark, texts, dead_letter=True)
    got = rows(
        flow.dlq_summary(frame),
        "event_table", "dlq_shape", "dlq_rows", "event_parameters_rows", "rejected_at_min", "rejected_at_max",
    )
    assert got == [
        ("__UNKNOWN__", "invalid_json", 1, 0, "", ""),
        ("pay", "legacy_event_envelope", 2, 1, "2024-01-01", "2024-01-02"),
    ]
    assert rows(flow.dlq_errors(frame), "validation_error", "dlq_rows") == [("a", 1), ("b", 2)]


def test_dead_letter_summary_lists_modes(spark):
    texts = ['{"event":{"name":"x.pay"}}'] * 4 + ["{"]
    frame = parsed(spark, texts, dead_letter=True, mode=["test", "live", None, "test", ""])
    wanted = [("__UNKNOWN__", [], 0, 1), ("pay", ["live", "test"], 2, 4)]
    assert rows(flow.dlq_summary(frame), "event_table", "modes", "n_modes", "dlq_rows") == wanted
    found = flow.dlq_summary_of(flow.letter_facts(frame))
    assert rows(found, "event_table", "modes", "n_modes", "dlq_rows") == wanted


# -- reconciliation ------------------------------------------------------------
def reconciled(spark, parsed_rows=(), raw=(), dlq=(), config=None):
    return {
        r.event_table: r
        for r in flow.reconcile(
            spark.createDataFrame(list(parsed_rows), "event_table string, rows_in_range long"),
            spark.createDataFrame(list(raw), "event_table string, raw_rows long"),
            spark.createDataFrame(
                list(dlq),
                "event_table string, dlq_source_table string, dlq_shape string, dlq_rows long",
            ),
            Settings(config or {}),
        ).collect()
    }


def test_reconciliation_flags(spark):
    got = reconciled(
        spark,
        [("revenue", 0), ("sessions", 0), ("silent", 0), ("gap", 5), ("alone", 5), ("good", 5), ("partner", 0)],
        [("revenue", 12), ("new", 8), ("gap", 9), ("good", 5), ("__UNKNOWN__", 2)],
        [("sessions", "d1", "s", 3), ("sessions", "d2", "t", 1)],
        {"source_flow": {"source_comparison_excluded_tables": ["partner"]}},
    )
    assert {name: (r.status, r.severity) for name, r in got.items()} == {
        "revenue": (["low_raw_seen_but_parsed_missing"], "low"),
        "sessions": (["critical_dlq_seen_but_parsed_missing", "critical_dlq_rows"], "critical"),
        "silent": (["critical_event_not_received"], "critical"),
        "gap": (["investigate_raw_to_parsed_count_gap"], "investigate"),
        "alone": (["investigate_parsed_without_source_window_rows"], "investigate"),
        "good": (["ok"], "ok"),
        "partner": (["investigate_source_comparison_not_applicable"], "investigate"),
        "new": (["low_missing_parsed_table"], "low"),
        "__UNKNOWN__": (["critical_source_type_missing"], "critical"),
    }
    assert (got["sessions"].dlq_rows, got["sessions"].dlq_source_tables) == (4, ["d1", "d2"])
    assert got["new"].parsed_rows is None


STATUS = (
    "event_table string, parameter string, status string, problem string, missing_pct double, "
    "report_priority string"
)


def test_pairs(spark):
    status = spark.createDataFrame(
        [
            ("b", "quantity", "problem", "missing_values", 0.4, "high"),
            ("a", "note", "ok", "", 0.0, "normal"),
            ("a", "event_name", "problem", "missing_column", None, "HIGH"),
            ("a", "shape", "problem", "invalid_values", 0.0, "extreme"),
            ("a", "user_id", "problem", "missing_values", 0.3, "extreme"),
            ("a", "old", "problem", "unpopulated_column", 1.0, "low"),
            ("a", "*", "error", "missing things", None, "high"),
            ("a", "event_name", "problem", "missing_values", 0.1, "low"),
        ],
        STATUS,
    )
    config = Settings({"event_context": {"a": {"skip_main_identifier_check": True}}})
    contract = contracts.contract_frame(
        spark, {"common_parameters": {"quantity": ["Int64", [], "high"]}, "events": {"a": {"parameters": {"old": None}}}}
    )
    got = rows(flow.parameter_pairs(status, contract, config), "event_table", "parameter", "target_missing_pct", "scope")
    assert got == [
        ("a", "event_name", 1.0, "configured_or_discovered"), ("a", "old", 1.0, "event"),
        ("b", "quantity", 0.4, "common"),
    ]
    assert flow.parameter_pairs(status, None, config, limit=2).count() == 2


def test_origins(spark):
    pairs = spark.createDataFrame(
        [
            ("login", "session_id", 0.5), ("login", "session_uuid", 0.5), ("pay", "session_id", 0.5),
            ("login", "event_name", 1.0), ("none", "x", 1.0), ("login", "full", 0.0), ("partner", "x", 1.0),
        ],
        "event_table string, parameter string, target_missing_pct double",
    ).selectExpr("*", "'missing_values' target_problem", "'high' report_priority", "'system' scope")
    presence = spark.createDataFrame(
        [("login", "session_id", 101), ("pay", "session_id", 50), ("login", "full", 100)],
        "event_table string, parameter string, raw_present_rows long",
    )
    source = spark.createDataFrame(
        [("login", 100), ("pay", 100), ("partner", 1)], "event_table string, raw_rows long"
    )
    config = Settings({"source_flow": {"source_comparison_excluded_table": "partner"}})
    got = {
        (r.event_table, r.parameter): (r.severity, r.raw_presence_pct)
        for r in flow.parameter_origin(pairs, presence, source, config).collect()
    }
    assert got == {
        ("login", "session_id"): ("low", 1.0), ("login", "session_uuid"): ("low", 1.0),
        ("pay", "session_id"): ("critical", 0.5), ("login", "event_name"): ("low", 1.0),
        ("none", "x"): ("investigate", None), ("login", "full"): ("ok", 1.0),
        ("partner", "x"): ("investigate", 0.0),
    }


def test_contract_additions_and_merge(spark):
    contract = contracts.contract_frame(
        spark,
        {
            "system_parameters": {"event_name": ["String", [], "high"], "session_id": ["String", [], "extreme"]},
            "common_parameters": {"currency": ["String", [], "high"]},
            "events": {"login": {"parameters": {"source": None}}},
        },
    )
    source = spark.createDataFrame(
        [("login",), ("purchase",), ("level_up",), ("__UNKNOWN__",)], "event_table string"
    )
    profile = spark.createDataFrame(
        [
            ("purchase", p, t, e) for p, t, e in [
                ("item_name", "String", ["case"]), ("quantity", "Int64", ["1", "2"]), ("currency", "String", ["VC"]),
                ("session_uuid", "String", ["u"]), ("device_hash", "String", ["h"]),
            ]
        ] + [("login", "other", "String", ["x"])],
        "event_table string, parameter string, type string, examples array<string>",
    )
    additions = contracts.contract_additions(contract, source, profile, Settings())
    assert rows(additions, "event_table", "parameter", "type", "event_required") == [
        ("level_up", None, None, False), ("purchase", "item_name", "String", False),
        ("purchase", "quantity", "Int64", False),
    ]
    merged = contracts.merged_contract(contract, additions)
    document = contracts.contract_document(merged.collect())
    assert document["events"]["login"] == {"parameters": {"source": None}}
    assert document["events"]["purchase"]["parameters"]["quantity"] == ["Int64", ["1", "2"], "normal"]
    assert document["events"]["level_up"] == {"parameters": {}, "required": False}
    again = contracts.merged_contract(merged, additions)
    assert again.count() == merged.count()
