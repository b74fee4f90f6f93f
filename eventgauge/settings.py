"""Configuration: plain dictionaries, merged in layers, read through one object.

Everything here is driver-side metadata about tables and checks.  It never holds
measured data; its size follows the number of configured tables and rules.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

# ---------------------------------------------------------------------------
# Fixed values.  Results depend on these being exactly what they are.
# ---------------------------------------------------------------------------
TIME_COLUMN_CANDIDATES = ("event_date", "created_at", "date", "startdate", "loaded_at")

IDENTIFIER_ALIASES = {
    "adid": ["adid"],
    "session_id": ["session_id", "session_uuid", "sessions_uuid"],
    "event_key": ["event_key"],
}

THRESHOLDS = {
    "missing_adid_pct": 0.01,
    "missing_main_identifier_pct": 0.01,
    "missing_session_id_pct": 0.01,
    "missing_event_key_pct": 0.01,
    "duplicate_pct": 0.01,
    "replicated_pct": 0.01,
    "same_second_burst_pct": 0.01,
    "suspicious_high_delta_pct": 0.2,
    "suspicious_low_delta_pct": 0.2,
    "suspicious_volume_min_expected_rows": 10,
    "new_activity_min_rows": 100,
}

INVALID_VALUES = ["N/A", "NA", "unknown", "undefined", "none", "-"]

AUTO_EXCLUDED_COLUMNS = [
    "event_date",
    "event_key",
    "adid",
    "user_id",
    "session_id",
    "session_uuid",
    "sessions_uuid",
    "device_hash",
    "created_at",
    "loaded_at",
    "updated_at",
    "meta_data",
    "meta_data_jsonb",
    "server_supported_versions",
]
AUTO_EXCLUDED_PATTERNS = ["*_json", "*_jsonb"]

SYSTEM_PARAMETERS = [
    "event_key",
    "event_name",
    "adid",
    "user_id",
    "session_id",
    "character_id",
    "client_version",
    "platform",
    "region",
    "server",
    "server_region",
    "server_version",
    "tz_offset",
]

PARAMETER_PRIORITIES = {
    "adid": "extreme",
    "user_id": "extreme",
    "session_id": "extreme",
    "event_key": "extreme",
    "event_name": "high",
    "server_region": "high",
    "platform": "high",
    "step": "high",
    "value": "high",
    "type": "high",
    "tz_offset": "low",
}

PARAMETER_EXAMPLES = {
    "adid": ["4bcdd67e-0bbc-4ca8-b7a5-4ba29e28c30a"],
    "user_id": ["4bcdd67e-0bbc-4ca8-b7a5-4ba29e28c30a"],
    "session_id": ["4bcdd67e-0bbc-4ca8-b7a5-4ba29e28c30a"],
    "event_key": ["4bcdd67e-0bbc-4ca8-b7a5-4ba29e28c30a"],
    "platform": ["ios"],
    "tz_offset": ["180"],
}

PRIORITY_RANKS = {"extreme": 0, "critical": 0, "high": 1, "normal": 2, "low": 3}

# Payload keys that describe the device or transport, not the event.
TECHNICAL_PARAMETERS = [
    "device_hash",
    "event_date",
    "gps_adid",
    "idfa",
    "idfv",
    "ip_address",
    "oaid",
]

PRIORITY_EVENT_TABLES = [
    "event_first_open",
    "event_login",
    "event_session_start",
    "event_purchase",
    "event_click",
    "event_reward",
]
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------


def merge_layers(*layers: Mapping[str, Any] | str | Path | None) -> dict[str, Any]:
    """Merge configuration layers, later ones winning; lists are replaced whole."""

    def combine(low: dict[str, Any], high: Mapping[str, Any]) -> dict[str, Any]:
        out = dict(low)
        for key, value in high.items():
            both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
            out[key] = combine(out[key], value) if both else value
        return out

    merged: dict[str, Any] = {}
    for layer in layers:
        if layer is None:
            continue
        if isinstance(layer, (str, Path)):
            layer = json.loads(Path(layer).read_text(encoding="utf-8"))
        merged = combine(merged, layer)
    return merged


def as_list(value: Any) -> list[str] | None:
    """A comma-separated string or any collection as a list of stripped strings."""
    if value is None:
        return None
    parts = value.split(",") if isinstance(value, str) else value
    if not isinstance(parts, Iterable):
        return None
    return [text for text in (str(part).strip() for part in parts) if text]


def glob_to_regex(pattern: str) -> str:
    """A shell glob as an anchored regular expression for ``rlike``.

    ``fnmatch`` writes the same syntax as Java but for its end anchor.
    """
    return "^" + fnmatch.translate(pattern.casefold()).replace("\\Z", "") + "\\z"


def _limit(value: Any) -> int | None:
    """A number a configuration sets to leave work out; none is set by default."""
    if value in (None, "", 0):
        return None
    if int(value) < 0:
        raise ValueError(f"a limit must be positive, got {value!r}")
    return int(value)



class Settings:
    """Read access to one merged configuration."""

    def __init__(self, *layers: Mapping[str, Any] | str | Path | None):
        self.config = merge_layers(*layers)

    def _section(self, *path: str) -> dict[str, Any]:
        node: Any = self.config
        for key in path:
            node = node.get(key, {}) if isinstance(node, Mapping) else {}
        return node if isinstance(node, Mapping) else {}

    # -- profile ------------------------------------------------------------
    @property
    def profile(self) -> dict[str, Any]:
        name = self.config.get("active_database_profile", "")
        return dict(self._section("database_profiles").get(name, {}))

    @property
    def main_identifier(self) -> str:
        name = str(
            self.profile.get("main_identifier")
            or self.config.get("main_identifier")
            or "user_id"
        ).strip()
        if not re.fullmatch(r"[A-Za-z_]\w*", name, flags=re.ASCII):
            raise ValueError(f"main_identifier is not a column name: {name!r}")
        return name

    @property
    def prefixes(self) -> list[str]:
        """Table-name prefixes; an empty list means that every name is accepted."""
        for holder in (self.profile, self._section("db_problem_scan"), self.config):
            found = as_list(holder.get("table_name_prefixes"))
            if found is not None:
                return found
        return ["event_"]

    @property
    def blacklist(self) -> list[str]:
        holders = [
            self.config.get("table_blacklist"),
            self.config.get("event_blacklist"),
            self.profile.get("table_blacklist"),
            self.profile.get("event_blacklist"),
            self._section("db_problem_scan").get("table_blacklist"),
        ]
        return list(dict.fromkeys(p for held in holders for p in as_list(held) or []))

    # -- identifiers --------------------------------------------------------
    def aliases(self, identifier: str) -> list[str]:
        """Physical columns of a logical identifier, in order of preference."""
        if identifier in ("user_id", "main_id"):
            return [self.main_identifier]
        configured = self._section("quality_definitions", "missing_identifier", "aliases")
        found = as_list(configured.get(identifier)) or IDENTIFIER_ALIASES.get(
            identifier, [identifier]
        )
        return list(dict.fromkeys(found))

    def identifier_of(self, parameter: str) -> str:
        """The logical name under which a parameter's aliases are pooled."""
        if parameter in ("user_id", self.main_identifier):
            return self.main_identifier
        if parameter == "session_id" or parameter in self.aliases("session_id"):
            return "session_id"
        return parameter

    def payload_aliases(self, parameter: str) -> list[str]:
        """Payload keys that may carry a parameter."""
        if parameter == "event_name":
            return ["type"]
        canonical = self.identifier_of(parameter)
        if canonical == "session_id":
            return self.aliases("session_id")
        return [canonical]

    # -- thresholds and definitions ----------------------------------------
    def threshold(self, name: str, default: float = 0.01) -> float:
        configured = self._section("thresholds")
        return float(configured.get(name, THRESHOLDS.get(name, default)))

    @property
    def burst_threshold(self) -> int:
        definition = self._section("quality_definitions", "same_second_burst")
        return int(definition.get("default_unique_event_key_threshold", 3))

    @property
    def future_check_enabled(self) -> bool:
        return bool(
            self._section("quality_definitions", "future_event_time").get("enabled", True)
        )

    @property
    def future_tolerance_minutes(self) -> int:
        definition = self._section("quality_definitions", "future_event_time")
        return int(definition.get("future_tolerance_minutes", 10))

    # -- table groups -------------------------------------------------------
    def _group(self, *names: str) -> set[str]:
        tables: set[str] = set()
        for name in names:
            group = self._section("event_groups").get(name)
            held = group.get("tables") if isinstance(group, Mapping) else group
            tables.update(as_list(held) or [])
        return tables

    @property
    def same_second_allowed(self) -> set[str]:
        allowed = self._group("same_second_allowed", "same_time_allowed")
        return allowed - self._group("same_second_strict", "same_time_strict")

    @property
    def missing_main_allowed(self) -> set[str]:
        return self._group(
            "missing_main_identifier_allowed", "missing_main_identifier_expected"
        )

    @property
    def missing_session_allowed(self) -> set[str]:
        return self._group("missing_session_id_allowed", "missing_session_id_expected")

    def context(self, table: str) -> dict[str, Any]:
        return dict(self._section("event_context").get(table, {}))

    def skipped_tables(self, check: str) -> list[str]:
        """Tables on which a check is off.  An explicit context entry beats a group."""
        by_group = {
            "skip_main_identifier_check": self.missing_main_allowed,
            "skip_session_id_check": self.missing_session_allowed,
            "skip_suspicious_same_second_check": self.same_second_allowed,
        }.get(check, set())
        contexts = self._section("event_context")
        names = set(by_group) | set(contexts)
        return sorted(
            t for t in names if self.context(t).get(check, t in by_group) is True
        )

    def step_exceptions(self, check: str) -> dict[str, list[str]]:
        """For each table, the steps whose rows are not counted by a check."""
        found: dict[str, list[str]] = {}
        for table in self._section("event_context"):
            steps = self.context(table).get("step_exceptions") or {}
            exempt = sorted(s for s, rule in steps.items() if rule.get(check) is True)
            if exempt:
                found[table] = exempt
        return found

    def tables_where_missing_is_allowed(self, identifier: str) -> list[str]:
        """Tables in which the configuration permits a missing identifier."""
        group, check = {
            "main_id": (self.missing_main_allowed, "skip_main_identifier_check"),
            "session_id": (self.missing_session_allowed, "skip_session_id_check"),
        }[identifier]
        contexts = self._section("event_context")
        by_context = {t for t in contexts if self.context(t).get(check) is True}
        return sorted(set(group) | by_context)

    def missing_allowed(self, table: str, parameter: str) -> bool:
        canonical = self.identifier_of(parameter)
        if canonical == self.main_identifier:
            return table in self.tables_where_missing_is_allowed("main_id")
        if canonical == "session_id":
            return table in self.tables_where_missing_is_allowed("session_id")
        return False

    def scan_skipped(self, identifier: str) -> list[str]:
        """Tables whose missing identifier does not add to the problem score."""
        key, group = {
            "main_id": ("skip_missing_main_identifier_tables", self.missing_main_allowed),
            "session_id": ("skip_missing_session_id_tables", self.missing_session_allowed),
        }[identifier]
        scan = self._section("db_problem_scan")
        listed = as_list(scan.get(key) or self.config.get(key))
        return sorted(set(listed if listed is not None else ["event_first_open"]) | group)

    # -- table selection ----------------------------------------------------
    @property
    def explicit_tables(self) -> list[str] | None:
        scan = self._section("db_problem_scan")
        return as_list(scan.get("event_tables") or self.config.get("event_tables")) or None

    @property
    def priority_tables(self) -> list[str]:
        scan = self._section("db_problem_scan")
        found = as_list(
            scan.get("priority_event_tables") or self.config.get("priority_event_tables")
        )
        return found or list(PRIORITY_EVENT_TABLES)

    @property
    def max_event_tables(self) -> int | None:
        """How many event tables a run measures; all of them unless a number is set."""
        collection = self._section("collection").get("max_event_tables")
        scan = self._section("db_problem_scan").get("scan_max_event_tables")
        return _limit(collection or scan)

    # -- parameters ---------------------------------------------------------
    @property
    def parameter_defaults(self) -> dict[str, Any]:
        held = self._section("parameter_quality", "defaults")
        invalid = as_list(held.get("invalid_values"))
        return {
            "invalid_values": INVALID_VALUES if invalid is None else invalid,
            "max_missing_pct": float(held.get("max_missing_pct", 0.0)),
            "max_invalid_pct": float(held.get("max_invalid_pct", 0.0)),
            "top_values_limit": max(1, int(held.get("top_values_limit", 10))),
        }

    @property
    def discovery(self) -> dict[str, Any]:
        held = self._section("parameter_quality", "auto_discovery")
        columns = as_list(held.get("exclude_columns"))
        patterns = as_list(held.get("exclude_patterns"))
        return {
            "enabled": bool(held.get("enabled", True)),
            "exclude_columns": AUTO_EXCLUDED_COLUMNS if columns is None else columns,
            "exclude_patterns": AUTO_EXCLUDED_PATTERNS if patterns is None else patterns,
            "default_rule": {"required_value": "auto", **held.get("default_rule", {})},
            "required_min_presence_pct": float(held.get("required_min_presence_pct", 0.95)),
            "flag_unpopulated": bool(held.get("flag_unpopulated", True)),
        }

    @property
    def global_parameters(self) -> dict[str, dict]:
        return dict(self._section("parameter_quality", "global_parameters"))

    @property
    def table_parameters(self) -> dict[str, dict]:
        return dict(self._section("parameter_quality", "tables"))

    def parameter_thresholds(self, kind: str) -> dict[str, float]:
        """``missing_<p>_pct`` or ``invalid_<p>_pct`` entries as {p: share}."""
        found: dict[str, float] = {}
        for key, value in self._section("thresholds").items():
            match = re.fullmatch(rf"{kind}_(.+)_pct", str(key))
            if not match:
                continue
            share = float(value)
            if not 0.0 <= share <= 1.0:
                raise ValueError(f"thresholds.{key} must lie between 0 and 1")
            found[match.group(1)] = share
        return found

    @property
    def common_parameter_min_events(self) -> int:
        held = self._section("profile_schema").get("common_parameter_min_events", 3)
        return max(2, int(held))

    @property
    def system_parameters(self) -> list[str]:
        return [
            self.main_identifier if name == "user_id" else name for name in SYSTEM_PARAMETERS
        ]

    def parameter_priority(self, parameter: str) -> str:
        name = "user_id" if parameter == self.main_identifier else parameter
        return PARAMETER_PRIORITIES.get(name, "normal")

    # -- source flow --------------------------------------------------------
    @property
    def flow(self) -> dict[str, Any]:
        held = self._section("source_flow")

        def tables(plural: str, singular: str, fallback: str) -> list[str]:
            found = as_list(held.get(plural))
            if found is None:
                found = as_list(held.get(singular) or fallback) or []
            return list(dict.fromkeys(found))

        return {
            "raw_table": str(held.get("raw_table", "source_events")),
            "dlq_tables": tables("dlq_tables", "dlq_table", "source_events_dlq"),
            "excluded": tables(
                "source_comparison_excluded_tables", "source_comparison_excluded_table", ""
            ),
            "max_parameter_checks": _limit(held.get("max_parameter_checks")),
        }

    # -- drill-down ---------------------------------------------------------
    @property
    def drilldown(self) -> dict[str, Any]:
        held = self._section("drilldown")
        allowed = sorted(self.missing_main_allowed | self.missing_session_allowed)
        return {
            "tables": as_list(held.get("tables") or self.config.get("drilldown_tables")),
            "max_tables": _limit(held.get("max_tables")),
            "missing_id_tables": as_list(held.get("missing_id_tables"))
            or allowed
            or ["event_first_open"],
        }
