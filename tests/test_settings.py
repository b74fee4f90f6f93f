import json
import re

import pytest

from eventgauge import Settings
from eventgauge.settings import glob_to_regex, merge_layers
from eventgauge.sources.catalog import select_event_tables


def test_layers_merge_deeply_and_replace_lists(tmp_path):
    low = tmp_path / "low.json"
    low.write_text(json.dumps({"a": {"x": 1, "y": [1, 2]}, "b": 1}))
    assert merge_layers(low, {"a": {"y": [3]}, "c": 2}, None) == {
        "a": {"x": 1, "y": [3]}, "b": 1, "c": 2,
    }


def test_prefixes_absent_and_empty():
    def of(profile):
        return Settings(
            {"active_database_profile": "p", "database_profiles": {"p": profile}}
        ).prefixes

    assert of({}) == ["event_"]
    assert of({"table_name_prefixes": []}) == []
    assert of({"table_name_prefixes": "a_, b_"}) == ["a_", "b_"]


def test_main_identifier():
    config = {"active_database_profile": "p"}
    config["database_profiles"] = {"p": {"main_identifier": "account_id"}}
    settings = Settings(config)
    assert settings.aliases("user_id") == ["account_id"]
    assert settings.identifier_of("user_id") == "account_id"
    config["database_profiles"]["p"]["main_identifier"] = "user-id; drop"
    with pytest.raises(ValueError):
        Settings(config).main_identifier


def test_blacklist_comes_from_five_places():
    settings = Settings(
        {
            "table_blacklist": ["a_*"], "event_blacklist": "b,c",
            "active_database_profile": "p",
            "database_profiles": {"p": {"table_blacklist": ["d"], "event_blacklist": ["a_*"]}},
            "db_problem_scan": {"table_blacklist": ["e"]},
        }
    )
    assert settings.blacklist == ["a_*", "b", "c", "d", "e"]


@pytest.mark.parametrize(
    ("pattern", "name", "match"),
    [
        ("DEBUG_*", "debug_events", True), ("event_t?st", "event_test", True),
        ("event_t?st", "event_tests", False), ("log[0-9]", "log7", True),
        ("log[!0-9]", "log7", False), ("a.b", "axb", False),
    ],
)
def test_globs(pattern, name, match):
    assert bool(re.match(glob_to_regex(pattern).replace("\\z", "\\Z"), name)) is match


def test_groups_and_context():
    settings = Settings(
        {
            "event_groups": {
                "same_second_allowed": {"tables": ["a", "b"]},
                "same_time_strict": ["b"],
                "missing_session_id_expected": "c, d",
            },
            "event_context": {
                "d": {"skip_session_id_check": False},
                "e": {"skip_session_id_check": True,
                      "step_exceptions": {"2": {"skip_adid_check": True}, "1": {}}},
            },
        }
    )
    assert settings.same_second_allowed == {"a"}
    assert settings.skipped_tables("skip_session_id_check") == ["c", "e"]
    assert settings.step_exceptions("skip_adid_check") == {"e": ["2"]}
    assert settings.missing_allowed("e", "session_uuid")
    assert not settings.missing_allowed("e", "user_id")
    assert settings.scan_skipped("session_id") == ["c", "d", "event_first_open"]


def test_parameter_thresholds():
    settings = Settings(
        {"thresholds": {"missing_event_key_pct": 0.001, "missing_session_id_pct": 0.01,
                        "duplicate_pct": 0.5, "invalid_x_pct": 0.2}}
    )
    assert settings.parameter_thresholds("missing") == {"event_key": 0.001, "session_id": 0.01}
    assert settings.parameter_thresholds("invalid") == {"x": 0.2}
    assert settings.threshold("duplicate_pct") == 0.5
    with pytest.raises(ValueError):
        Settings({"thresholds": {"missing_a_pct": 2}}).parameter_thresholds("missing")


def test_table_selection():
    sizes = {"event_b": 5, "event_a": 5, "event_big": 9, "event_login": 1}
    chosen = select_event_tables(sizes, Settings(), limit=3)
    assert chosen.chosen == ["event_login", "event_big", "event_a"]
    assert chosen.not_scanned == ["event_b"]
    explicit = Settings({"event_tables": "x,y"})
    assert select_event_tables(sizes, explicit, limit=1).chosen == ["x", "y"]
    assert Settings({"db_problem_scan": {"scan_max_event_tables": 137}}).max_event_tables == 137
    with pytest.raises(ValueError):
        Settings({"collection": {"max_event_tables": -1}}).max_event_tables


def test_flow_tables():
    flow = Settings({"source_flow": {"dlq_table": "d", "source_comparison_excluded_tables": "p"}}).flow
    assert (flow["dlq_tables"], flow["excluded"], flow["max_parameter_checks"]) == (["d"], ["p"], None)
