"""The registered queries as SQL for DuckDB, written against the given tables.

Each query is a final SELECT over named building blocks; ``statement`` puts the
blocks it needs in front of it.  The SQL follows the definitions directly (windows,
per-parameter unions, JSON functions), not the shape of the Spark plans.
"""

from __future__ import annotations

import re

from eventgauge.functions import redact

ZERO = "00000000-0000-0000-0000-000000000000"
START, STOP, BACK = "2024-01-24 00:00:00", "2024-01-31 00:00:00", "2024-01-10 00:00:00"
UNKNOWN = "__UNKNOWN__"


def norm(column: str) -> str:
    return (
        f"case when {column} is null or trim({column}, ' ') = '' or {column} = '{ZERO}'"
        f" or lower({column}) = 'null' then null else {column} end"
    )


def invalid_in(value: str, words: str = "'n/a','na','unknown','undefined','none','-'") -> str:
    return f"lower({value}) in ({words})"


NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]|[nN][aA][nN])$"


def number(value: str) -> str:
    return f"(case when regexp_matches({value}, '{NUMBER}') then try_cast({value} as double) end)"


BLOCKS: dict[str, str] = {}

# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------
BLOCKS["fx_events"] = f"""
select event_id, 'event_' || event_type as event_table, ts as created_at,
  date_trunc('hour', ts) as event_date,
  case when event_id % 97 = 0 then null when event_id % 89 = 0 then ''
       when event_id % 83 = 0 then '{ZERO}'
       when event_id % 79 = 0 then 'NULL' else cast(user_id % 5 as varchar) end as adid,
  case when event_type = 'signup' and event_id % 3 = 0 then null
       else cast(user_id as varchar) end as user_id,
  case when event_id % 5 = 0 then null else 's' || cast(event_id % 400 as varchar) end as session_id,
  case when event_id % 10 = 5 then 'u' || cast(event_id % 400 as varchar) end as session_uuid,
  case when event_id % 71 = 0 then ' ' else cast(event_id % 13 as varchar) end as event_key,
  case event_id % 4 when 0 then 'ios' when 1 then 'android' when 2 then 'web' else 'N/A' end as platform,
  case event_id % 7 when 0 then 'ru' when 1 then 'unknown' when 2 then null else 'US' end as region,
  case when ts >= timestamp '2024-01-24 00:00:00' and event_id % 2 = 0 then null
       else 'v' || cast(event_id % 3 as varchar) end as client_version,
  cast(null as varchar) as legacy_flag,
  cast(event_id % 6 as varchar) as step
from events"""

BLOCKS["fx_source"] = """
select event_id as row_id, ts as event_time,
  case when event_id % 101 = 0 then 'not json'
       when event_id % 103 = 0 then '{"type":"app.ns.' || case event_type when 'error' then 'other_' else 'event_' end || event_type || '","params":null}'
       when event_id % 107 = 0 then '{"params":{"k":1}}'
       else '{"type":"app.ns.' || case event_type when 'error' then 'other_' else 'event_' end || event_type || '","params":{"k":' || cast(event_id % 50 as varchar)
         || ',"session_uuid":' || case when event_id % 9 = 0 then 'null'
              else '"s' || cast(event_id % 400 as varchar) || '"' end
         || ',"region":"US","price":' || cast(event_id % 7 as varchar) || '.5,"vip":true}}' end as payload,
  case when event_id % 3 = 0 then '' else 'live' end as mode
from events"""

BLOCKS["fx_dlq"] = """
select event_id as row_id, ts as event_time,
  case when event_id % 500 = 0 then '{broken'
       when event_id % 100 = 0 then '{"type":"app.event_' || event_type || '","params":{"k":1}}'
       when event_id % 150 = 0 then '[1,2]'
       else '{"event":{"name":"legacy.event_' || event_type || '","parameters":{"k":1}},"validationErrors":["unknown event","code '
         || cast(event_id % 3 as varchar) || '"],"rejectedAt":"2024-01-0'
         || cast(1 + event_id % 9 as varchar) || 'T00:00:00Z"}' end as payload
from events"""

# ---------------------------------------------------------------------------
# Events
# ---------------------------------------------------------------------------
BLOCKS["canon_all"] = f"""
select event_table, event_date as event_time, created_at,
  {norm('adid')} as adid, {norm('user_id')} as main_id,
  coalesce({norm('session_id')}, {norm('session_uuid')}) as session_id,
  {norm('event_key')} as event_key, step,
  coalesce(nullif(step, ''), 'NULL') as step_label, 'NO_COLUMN' as type_label,
  coalesce(nullif(platform, ''), 'NULL') as platform_label,
  coalesce(nullif(region, ''), 'NULL') as region_label,
  'NO_COLUMN' as server_region_label
from fx_events"""
BLOCKS["canon"] = f"""
select * from canon_all
where event_time >= timestamp '{START}' and event_time < timestamp '{STOP}'"""
BLOCKS["ev_groups"] = """
select event_table, event_time, adid, event_key, count(*) as group_rows
from canon where adid is not null and event_key is not null
group by event_table, event_time, adid, event_key"""
BLOCKS["annotated"] = """
select *, cast(sum(group_rows) over (partition by event_table, event_time, adid) as bigint) as rows_in_second,
  count(*) over (partition by event_table, event_time, adid) as unique_event_keys,
  row_number() over (partition by event_table, event_time, adid order by event_key) as key_rank
from ev_groups"""
BLOCKS["anomalies"] = """
select event_table, cast(sum(group_rows - 1) as bigint) as duplicate_rows,
  count(*) - count(distinct event_key) as replicated_rows,
  cast(coalesce(sum(rows_in_second) filter (where key_rank = 1 and unique_event_keys > 3), 0) as bigint)
    as same_second_burst_rows
from annotated group by event_table"""
BLOCKS["missing_counts"] = """
select event_table, count(*) as rows_in_range,
  case when event_table <> 'event_view' then count(*) filter (where adid is null) end as missing_adid_rows,
  case when event_table <> 'event_signup' then count(*) filter (where main_id is null) end
    as missing_main_identifier_rows,
  count(*) filter (where session_id is null
    and not (event_table = 'event_error' and (step is null or step in ('0')))) as missing_session_id_rows,
  count(*) filter (where event_key is null) as missing_event_key_rows,
  count(*) filter (where adid is null) as raw_missing_adid_rows,
  count(*) filter (where main_id is null) as raw_missing_main_identifier_rows,
  count(*) filter (where session_id is null) as raw_missing_session_id_rows,
  count(*) filter (where event_key is null) as raw_missing_event_key_rows
from canon group by event_table"""
BLOCKS["history"] = f"""
select event_table,
  count(*) filter (where event_time >= timestamp '{START}' and event_time < timestamp '{STOP}') as rows_in_range,
  count(*) filter (where event_time >= timestamp '{BACK}' and event_time < timestamp '{START}') as lookback_rows,
  count(*) filter (where event_time > timestamp '2024-01-31 00:10:00') as future_event_time_rows
from canon_all group by event_table"""
BLOCKS["metrics_base"] = """
select h.event_table, true as has_event_key, true as has_main, true as has_session,
  coalesce(m.rows_in_range, 0) as rows_in_range,
  m.missing_adid_rows, m.missing_main_identifier_rows, m.missing_session_id_rows,
  m.missing_event_key_rows, a.duplicate_rows, a.replicated_rows,
  case when h.event_table <> 'event_click' then a.same_second_burst_rows end as same_second_burst_rows,
  h.lookback_rows, h.future_event_time_rows,
  m.raw_missing_adid_rows, m.raw_missing_main_identifier_rows, m.raw_missing_session_id_rows,
  m.raw_missing_event_key_rows, a.same_second_burst_rows as raw_same_second_burst_rows
from history h left join missing_counts m using (event_table) left join anomalies a using (event_table)
union all
select 'event_order', false, false, false,
  count(*) filter (where o_orderdate >= timestamp '2024-01-24' and o_orderdate < timestamp '2024-01-31'),
  count(*) filter (where o_orderdate >= timestamp '2024-01-24' and o_orderdate < timestamp '2024-01-31'
    and o_custkey is null),
  null, null, null, null, null, null,
  count(*) filter (where o_orderdate >= timestamp '2024-01-10' and o_orderdate < timestamp '2024-01-24'),
  count(*) filter (where o_orderdate > timestamp '2024-01-31 00:10:00'),
  count(*) filter (where o_orderdate >= timestamp '2024-01-24' and o_orderdate < timestamp '2024-01-31'
    and o_custkey is null),
  null, null, null, null
from orders"""


def _rates(rows: str) -> str:
    names = (
        "missing_adid", "missing_main_identifier", "missing_session_id", "missing_event_key",
        "duplicate", "replicated", "same_second_burst",
    )
    return ", ".join(
        f"round({n}_rows / nullif({rows}, 0)::double, 6) as {n}_pct" for n in names
    )


BLOCKS["metrics"] = f"""
select *, {_rates('rows_in_range')}, lookback_rows / 2.0::double as expected_rows,
  case when lookback_rows > 0 then (rows_in_range - lookback_rows / 2.0::double) / (lookback_rows / 2.0::double) end
    as delta
from metrics_base"""


def _flagged(pairs: list[tuple[str, str]], joiner: str) -> str:
    items = ", ".join(f"case when {condition} then {name} end" for condition, name in pairs)
    return f"concat_ws('{joiner}', {items})"


_STATUS_PAIRS = [("rows_in_range = 0", "'no_rows_in_range'")]
for _name in (
    "missing_adid", "missing_main_identifier", "missing_session_id", "duplicate", "replicated",
    "same_second_burst",
):
    _STATUS_PAIRS.append(
        (f"{_name}_rows / nullif(rows_in_range, 0)::double >= 0.01", f"'{_name}_high'")
    )
_STATUS_PAIRS += [("delta >= 0.2", "'suspicious_high'"), ("delta <= -0.2", "'suspicious_low'")]
BLOCKS["status_frame"] = f"""
select *, coalesce(nullif({_flagged(_STATUS_PAIRS, ', ')}, ''), 'ok') as status from metrics"""

_SCORE = " + ".join(
    [
        "coalesce(future_event_time_rows, 0)", "coalesce(duplicate_rows, 0)",
        "coalesce(raw_missing_adid_rows, 0)",
        "case when event_table in ('event_signup', 'event_first_open') then 0"
        " else coalesce(raw_missing_main_identifier_rows, 0) end",
        "case when event_table = 'event_first_open' then 0"
        " else coalesce(raw_missing_session_id_rows, 0) end",
        "coalesce(raw_missing_event_key_rows, 0)",
        "case when event_table = 'event_click' then 0 else coalesce(raw_same_second_burst_rows, 0) end",
    ]
)
BLOCKS["signal"] = f"select *, cast({_SCORE} as bigint) as problem_signal_rows from metrics"
_TIME = "case when event_table = 'event_order' then 'created_at' else 'event_date' end"
_PROBLEMS = _flagged(
    [
        ("rows_in_range = 0", "'No rows in selected period'"),
        ("duplicate_rows > 0", "'Duplicate event_time + adid + event_key rows found'"),
        (
            "raw_same_second_burst_rows > 0 and event_table <> 'event_click'",
            "'Same-second event bursts found'",
        ),
        ("future_event_time_rows > 0", f"'Future ' || {_TIME} || ' rows found'"),
        ("raw_missing_adid_rows > 0", "'Missing adid rows found'"),
        (
            "raw_missing_main_identifier_rows > 0 and event_table not in ('event_signup', 'event_first_open')",
            "'Missing user_id rows found'",
        ),
        ("raw_missing_session_id_rows > 0", "'Missing session_id rows found'"),
        ("raw_missing_event_key_rows > 0", "'Missing event_key rows found'"),
    ],
    "; ",
)
_WARNINGS = _flagged(
    [
        ("not has_event_key", "'Missing event_key column'"),
        ("not has_main", "'Missing main identifier column (accepted: user_id)'"),
        (
            "not has_session",
            "'Missing session identifier column (accepted: session_id, session_uuid, sessions_uuid)'",
        ),
    ],
    "; ",
)
BLOCKS["scan"] = f"""
select *, {_PROBLEMS} as problems, {_WARNINGS} as schema_warnings from metrics"""


def _class(condition: str, group: str, issue: str, metric: str, value: str, rows: str,
           level: str = "normal") -> str:
    return (
        f"select event_table, {group} as classification, '{issue}' as issue, '{metric}' as metric,"
        f" round(cast({value} as double), 6) as value, cast({rows} as bigint) as rows,"
        f" '{level}' as severity from metrics where {condition}"
    )


_CLASSES = [
    _class("rows_in_range = 0", "'confirmed'", "no_rows", "rows_in_range", "rows_in_range",
           "rows_in_range", "critical"),
    _class("duplicate_pct >= 0.01", "'confirmed'", "duplicate_high", "duplicate_pct",
           "duplicate_pct", "duplicate_rows"),
    _class("replicated_pct >= 0.01", "'confirmed'", "replicated_high", "replicated_pct",
           "replicated_pct", "replicated_rows"),
    _class("expected_rows >= 10 and delta >= 0.2", "'investigate'", "suspicious_high",
           "delta_vs_lookback_expected", "delta", "rows_in_range"),
    _class("expected_rows >= 10 and delta <= -0.2", "'investigate'", "suspicious_low",
           "delta_vs_lookback_expected", "delta", "rows_in_range"),
    _class("coalesce(expected_rows, 0) < 10 and rows_in_range >= 100", "'investigate'",
           "new_activity", "expected_rows_from_lookback", "coalesce(expected_rows, 0)",
           "rows_in_range"),
    _class("future_event_time_rows > 0", "'confirmed'", "future_event_time",
           "future_event_time_rows", "future_event_time_rows", "future_event_time_rows"),
    _class("raw_same_second_burst_rows / nullif(rows_in_range, 0)::double >= 0.01",
           "case when event_table = 'event_click' then 'expected' else 'investigate' end",
           "same_second_burst_high", "same_second_burst_pct",
           "raw_same_second_burst_rows / nullif(rows_in_range, 0)::double", "raw_same_second_burst_rows"),
]
for _name, _skipped in (
    ("missing_adid", "'event_view'"), ("missing_main_identifier", "'event_signup'"),
    ("missing_session_id", "''"), ("missing_event_key", "''"),
):
    _CLASSES.append(
        _class(
            f"round(raw_{_name}_rows / nullif(rows_in_range, 0)::double, 6) >= 0.01",
            f"case when event_table in ({_skipped}) then 'expected' else 'confirmed' end",
            f"{_name}_high", f"{_name}_pct", f"raw_{_name}_rows / nullif(rows_in_range, 0)::double",
            f"raw_{_name}_rows",
        )
    )

# ---------------------------------------------------------------------------
# Parameters: name -> (value, broken for any table, broken for event_click)
# ---------------------------------------------------------------------------
_WINDOW = f"event_date >= timestamp '{START}' and event_date < timestamp '{STOP}'"
_BEFORE = f"event_date >= timestamp '{BACK}' and event_date < timestamp '{START}'"
_PLAIN = ("adid", "client_version", "event_key", "legacy_flag", "platform", "user_id")


def _parameter(name: str, value: str, broken: str, only: str = "true") -> str:
    return (
        f"select event_table, '{name}' as parameter, value, ({_WINDOW}) as now_, ({_BEFORE}) as before_,"
        f" coalesce({broken}, false) as broken"
        f" from (select *, {value} as value from fx_events) where {only} and (({_WINDOW}) or ({_BEFORE}))"
    )


_UNIONS = [
    _parameter(
        n, norm(n), invalid_in("value"),
        "event_table <> 'event_click'" if n == "legacy_flag" else "true",
    )
    for n in _PLAIN
]
_UNIONS.append(
    _parameter(
        "region", norm("region"),
        f"({invalid_in('value')} or not regexp_matches(value, '^[A-Z]{{2}}$'))",
    )
)
_session = [norm("session_id"), norm("session_uuid")]
_valid = [f"case when not ({invalid_in(f'({v})')}) then {v} end" for v in _session]
_UNIONS.append(
    _parameter("session_id", f"coalesce({', '.join(_valid + _session)})", invalid_in("value"))
)
_step_number = number("value")
_UNIONS.append(
    _parameter(
        "step", norm("step"),
        f"({invalid_in('value')} or (event_table = 'event_click' and"
        f" ({_step_number} is null or {_step_number} < 1 or {_step_number} > 4)))",
    )
)
BLOCKS["parameter_rows"] = "\nunion all\n".join(_UNIONS)
BLOCKS["parameter_counts"] = """
select event_table, parameter,
  count(*) filter (where now_) as rows_checked,
  count(*) filter (where now_ and value is null) as missing_rows,
  count(*) filter (where now_ and value is not null and broken) as invalid_rows,
  count(*) filter (where before_) as lookback_rows_checked,
  count(*) filter (where before_ and value is null) as lookback_missing_rows,
  count(*) filter (where before_ and value is not null and broken) as lookback_invalid_rows
from parameter_rows group by event_table, parameter"""
BLOCKS["value_counts"] = """
select event_table, parameter, 'window' as period, coalesce(value, '<MISSING>') as value, count(*) as value_rows
from parameter_rows where now_ group by all
union all
select event_table, parameter, 'lookback', coalesce(value, '<MISSING>'), count(*)
from parameter_rows where before_ group by all"""
BLOCKS["ranked_values"] = """
select *, row_number() over (partition by event_table, parameter, period order by value_rows desc, value) as rank
from value_counts qualify rank <= 10"""
BLOCKS["rules"] = """
select * from (values
  ('adid', 'adid', 'extreme', true, 'auto'), ('client_version', 'client_version', 'normal', true, 'auto'),
  ('event_key', 'event_key', 'extreme', true, 'auto'), ('legacy_flag', 'legacy_flag', 'normal', false, 'auto'),
  ('platform', 'platform', 'high', true, 'auto'), ('region', 'region', 'normal', true, 'auto'),
  ('session_id', 'session_id,session_uuid', 'extreme', true, 'auto'),
  ('step', 'step', 'normal', false, 'auto'), ('user_id', 'user_id', 'extreme', true, 'auto')
) t(parameter, source_columns, report_priority, contract, required)"""
BLOCKS["ruled"] = """
select t.event_table, r.*,
  case when parameter = 'user_id' and event_table = 'event_signup' then 1.0
       when parameter = 'platform' then 0.05 else 0.0 end::double as max_missing
from (select distinct event_table from fx_events) t, rules r
where not (event_table = 'event_click' and parameter = 'legacy_flag')
union all
select 'event_order', * from (values
  ('adid', 'adid', 'extreme', true, 'auto', 0.0::double),
  ('priority', 'priority', 'normal', false, 'auto', 0.0::double),
  ('region', '', 'normal', false, 'true', 0.0::double),
  ('status', 'status', 'normal', false, 'auto', 0.0::double)) t"""
BLOCKS["parameter_joined"] = """
select r.*, coalesce(c.rows_checked, 0) as rows_checked,
  case when source_columns <> '' then coalesce(c.missing_rows, 0) end as missing_rows,
  case when source_columns <> '' then coalesce(c.invalid_rows, 0) end as invalid_rows,
  case when source_columns <> '' then coalesce(c.lookback_rows_checked, 0) end as lookback_rows_checked,
  case when source_columns <> '' then coalesce(c.lookback_missing_rows, 0) end as lookback_missing_rows,
  missing_rows / nullif(rows_checked, 0)::double as miss,
  invalid_rows / nullif(rows_checked, 0)::double as inv,
  1.0 - lookback_missing_rows / nullif(lookback_rows_checked, 0)::double as presence,
  coalesce(lookback_rows_checked > 0 and lookback_missing_rows = lookback_rows_checked, false) as never,
  case when required = 'auto' then coalesce(not never and presence >= 0.95, false)
       else required = 'true' and miss is not null end as inferred_required
from ruled r left join parameter_counts c using (event_table, parameter)"""
_PROBLEM = _flagged(
    [
        ("source_columns = ''", "'column_not_present'"),
        ("source_columns <> '' and never and miss < 1.0", "'newly_populated'"),
        ("source_columns <> '' and never and not coalesce(miss < 1.0, false)", "'unpopulated_column'"),
        ("source_columns <> '' and inferred_required and miss > max_missing", "'missing_values'"),
        ("source_columns <> '' and inv > 0.0", "'invalid_values'"),
    ],
    ",",
)
BLOCKS["parameter_frame"] = f"""
select event_table, parameter, source_columns, rows_checked, missing_rows, invalid_rows,
  lookback_rows_checked, lookback_missing_rows, contract, report_priority, inferred_required,
  round(miss, 6) as missing_pct, round(inv, 6) as invalid_pct,
  round(presence, 6) as lookback_presence_pct, round(rows_checked * presence, 6) as expected_present_rows,
  round((rows_checked - missing_rows - rows_checked * presence)
    / nullif(rows_checked * presence, 0), 6) as presence_delta_pct,
  {_PROBLEM} as problem,
  case when source_columns = '' then 'skipped' when problem <> '' then 'problem' else 'ok' end as status
from parameter_joined"""


def _rank(column: str) -> str:
    return f"case {column} when 'extreme' then 0 when 'critical' then 0 when 'high' then 1 when 'low' then 3 else 2 end"


BLOCKS["urgent"] = f"""
select *, {_rank('report_priority')} as priority_rank, case when contract then 0 else 1 end as contract_rank,
  case when regexp_matches(problem, 'missing_event|missing_column') then 0 else 1 end as schema_rank,
  -coalesce(missing_pct, 0.0) as missing_rank
from parameter_frame where status = 'problem'"""
BLOCKS["problem_groups"] = """
select priority_rank, report_priority, parameter,
  array_to_string(list_sort(list_distinct(flatten(list(string_split(problem, ','))))), ',') as problems,
  count(*) as affected_events, max(missing_pct) as max_missing_pct, min(event_table) as first_table,
  min(row(priority_rank, contract_rank, schema_rank, missing_rank, event_table, parameter)) as urgency
from urgent group by priority_rank, report_priority, parameter"""

# ---------------------------------------------------------------------------
# Payloads
# ---------------------------------------------------------------------------
_STRING = "case when json_type(j, '{0}') = 'VARCHAR' then nullif(json_extract_string(j, '{0}'), '') end"
BLOCKS["src_json"] = """
select *, json_valid(payload) as valid, case when json_valid(payload) then payload end as j from fx_source"""
BLOCKS["src_all"] = f"""
select *, coalesce({_STRING.format('$.type')}, '') as raw_type,
  coalesce(nullif(regexp_replace(raw_type, '^.*\\.', ''), ''), '{UNKNOWN}') as event_table
from src_json"""
BLOCKS["src"] = f"""
select * from src_all where event_time >= timestamp '{START}' and event_time < timestamp '{STOP}'"""
BLOCKS["dlq_json"] = """
select *, json_valid(payload) as valid, case when json_valid(payload) then payload end as j from fx_dlq"""
BLOCKS["dlq_all"] = f"""
select *, coalesce({_STRING.format('$.type')}, {_STRING.format('$.event.name')}, '') as raw_type,
  coalesce(nullif(regexp_replace(raw_type, '^.*\\.', ''), ''), '{UNKNOWN}') as event_table,
  case when not valid then 'invalid_json' when json_exists(j, '$.event') then 'legacy_event_envelope'
       when json_exists(j, '$.type') and json_exists(j, '$.params') then 'standard_type_params'
       else 'unknown_json_shape' end as dlq_shape,
  coalesce(json_exists(j, '$.event.parameters'), false) as has_event_parameters,
  {_STRING.format('$.event.name')} as source_event_name, {_STRING.format('$.rejectedAt')} as rejected_at,
  case when json_type(j, '$.validationErrors') = 'ARRAY'
       then cast(json_extract_string(j, '$.validationErrors[*]') as varchar[]) else [] end as validation_errors
from dlq_json"""
BLOCKS["dlq"] = f"""
select * from dlq_all where event_time >= timestamp '{START}' and event_time < timestamp '{STOP}'"""


def _summary(source: str) -> str:
    return f"""
select event_table, min(raw_type) as source_type,
  coalesce(string_agg(distinct nullif(mode, ''), ',' order by nullif(mode, '')), '') as modes,
  count(distinct nullif(mode, '')) as n_modes,
  count(*) as raw_rows, count(*) filter (where not valid) as invalid_json_rows,
  count(*) filter (where valid and coalesce(json_type(j, '$.params'), 'NULL') = 'NULL')
    as missing_params_object_rows
from {source} group by event_table"""


def _letters(source: str) -> str:
    return f"""
select event_table, 'source_events_dlq' as dlq_source_table, dlq_shape,
  coalesce(min(source_event_name), '') as source_event_name, '' as modes,
  0::bigint as n_modes, count(*) as dlq_rows,
  count(*) filter (where has_event_parameters) as event_parameters_rows,
  cast(sum(len(validation_errors)) as bigint) as validation_error_rows,
  coalesce(min(rejected_at), '') as rejected_at_min, coalesce(max(rejected_at), '') as rejected_at_max
from {source} group by event_table, dlq_shape"""


BLOCKS["summary"] = _summary("src")
BLOCKS["letters"] = _letters("dlq")


def _keys(source: str) -> str:
    return f"""
select row_id, event_table, key as parameter, json_extract(j, '$.params.' || key) as v,
  cast(json_extract(j, '$.params.' || key) as varchar) as raw_value
from (select row_id, event_table, j, unnest(json_keys(j, '$.params')) as key
      from {source} where json_type(j, '$.params') = 'OBJECT')"""


BLOCKS["src_keys_all"] = _keys("src_all")
BLOCKS["src_keys"] = _keys("src")


def _kinds(keys: str) -> str:
    return f"""
select event_table, parameter,
  case when json_type(v) = 'NULL' or raw_value in ('', 'null', '""') then null
       when json_type(v) = 'BOOLEAN' then 'bool' when json_type(v) in ('UBIGINT', 'BIGINT') then 'int'
       when json_type(v) = 'DOUBLE' then 'float' else 'other' end as kind
from {keys}"""


def _types(kinds: str) -> str:
    return f"""
select event_table, parameter,
  case when count(*) filter (where kind = 'bool') > 0 and count(*) filter (where kind <> 'bool') = 0 then 'UInt8'
       when count(*) filter (where kind = 'int') > 0 and count(*) filter (where kind <> 'int') = 0 then 'Int64'
       when count(*) filter (where kind = 'float') > 0
         and count(*) filter (where kind not in ('int', 'float')) = 0 then 'Float64'
       else 'String' end as type,
  count(*) as raw_rows, count(kind) as typed_rows
from {kinds} group by event_table, parameter"""


BLOCKS["kinds_all"] = _kinds("src_keys_all")
BLOCKS["kinds"] = _kinds("src_keys")
BLOCKS["types"] = _types("kinds")


def _profile(keys: str) -> str:
    return f"""
select event_table, parameter, string_agg(raw_value, ',' order by raw_value) as raw_examples,
  coalesce(string_agg(
    case when starts_with(raw_value, '"') then json_extract_string(raw_value, '$') else raw_value end, ','
    order by raw_value) filter (where raw_value not in ('', 'null', '""')), '') as examples
from (select *, row_number() over (partition by event_table, parameter order by raw_value) as n
      from (select distinct event_table, parameter, raw_value from {keys}))
where n <= 5 group by event_table, parameter"""


BLOCKS["profile"] = _profile("src_keys")


def _presence(keys: str) -> str:
    return f"""
select event_table, parameter, count(*) as raw_present_rows from (
  select distinct row_id, event_table,
    case when parameter in ('session_id', 'session_uuid', 'sessions_uuid') then 'session_id'
         else parameter end as parameter
  from {keys} where raw_value not in ('', 'null', '""'))
group by event_table, parameter"""


BLOCKS["presence"] = _presence("src_keys")

# ---------------------------------------------------------------------------
# Flow
# ---------------------------------------------------------------------------
BLOCKS["flow_joined"] = """
select coalesce(m.event_table, s.event_table, d.event_table) as event_table,
  m.event_table is not null as target_table_exists, coalesce(s.raw_rows, 0) as raw_rows,
  m.rows_in_range as parsed_rows, coalesce(d.dlq_rows, 0) as dlq_rows,
  coalesce(d.dlq_shapes, '') as dlq_shapes, coalesce(d.dlq_source_tables, '') as dlq_source_tables,
  false as source_comparison_excluded
from metrics m full join summary s on m.event_table = s.event_table
full join (select event_table, cast(sum(dlq_rows) as bigint) as dlq_rows,
             string_agg(distinct dlq_shape, ',' order by dlq_shape) as dlq_shapes,
             string_agg(distinct dlq_source_table, ',' order by dlq_source_table) as dlq_source_tables
           from letters group by event_table) d
  on d.event_table = coalesce(m.event_table, s.event_table)"""
_FLOW_FLAGS = _flagged(
    [
        ("target_table_exists and parsed_rows = 0 and raw_rows > 0", "'low_raw_seen_but_parsed_missing'"),
        (
            "target_table_exists and parsed_rows = 0 and raw_rows = 0 and dlq_rows > 0",
            "'critical_dlq_seen_but_parsed_missing'",
        ),
        (
            "target_table_exists and parsed_rows = 0 and raw_rows = 0 and dlq_rows = 0",
            "'critical_event_not_received'",
        ),
        (
            f"not target_table_exists and raw_rows > 0 and event_table <> '{UNKNOWN}'",
            "'low_missing_parsed_table'",
        ),
        ("dlq_rows > 0", "'critical_dlq_rows'"),
        (
            "target_table_exists and parsed_rows > 0 and raw_rows > parsed_rows",
            "'investigate_raw_to_parsed_count_gap'",
        ),
        (
            "target_table_exists and parsed_rows > 0 and raw_rows = 0",
            "'investigate_parsed_without_source_window_rows'",
        ),
        (f"event_table = '{UNKNOWN}' and raw_rows > 0", "'critical_source_type_missing'"),
    ],
    ",",
)
BLOCKS["flows"] = f"""
select * exclude (flags), coalesce(nullif(flags, ''), 'ok') as status,
  case when flags like '%critical_%' then 'critical' when flags like '%low_%' then 'low'
       when flags like '%investigate_%' then 'investigate' else 'ok' end as severity
from (select *, {_FLOW_FLAGS} as flags from flow_joined)"""
BLOCKS["pairs"] = f"""
select event_table, parameter, missing_pct as target_missing_pct, problem as target_problem, report_priority,
  case when parameter in ('event_key', 'session_id', 'event_name') then 'system'
       when parameter in ('region', 'currency') then 'common'
       when event_table = 'event_click' and parameter in ('platform', 'campaign', 'step') then 'event'
       else 'configured_or_discovered' end as scope
from parameter_frame
where status = 'problem' and (regexp_matches(problem, 'missing|unpopulated') or missing_pct > 0)
  and not (parameter = 'user_id' and event_table = 'event_signup')
order by {_rank('report_priority')}, event_table, parameter"""
BLOCKS["origins_joined"] = """
select p.*, coalesce(s.raw_rows, 0) as raw_rows,
  case when p.parameter = 'session_id' then 'session_id,session_uuid,sessions_uuid' else p.parameter end
    as source_aliases,
  case when coalesce(s.raw_rows, 0) > 0 then least(coalesce(e.raw_present_rows, 0), s.raw_rows)
       else coalesce(e.raw_present_rows, 0) end as raw_present_rows,
  case when coalesce(s.raw_rows, 0) > 0
       then least(coalesce(e.raw_present_rows, 0), s.raw_rows) / s.raw_rows::double end as share
from pairs p left join presence e using (event_table, parameter) left join summary s using (event_table)"""
BLOCKS["origins"] = """
select * exclude (share), round(share, 6) as raw_presence_pct,
  case when raw_rows = 0 then 'no_source_rows_for_parameter_check'
       when share >= 0.99 and target_missing_pct > 0 then 'likely_parser_or_column_mapping_issue'
       when share < 0.99 then 'source_payload_parameter_missing' else 'source_parameter_present' end as diagnosis,
  case when raw_rows = 0 then 'investigate_no_source_rows_for_parameter_check'
       when share >= 0.99 and target_missing_pct > 0 then 'low_target_parameter_missing_but_raw_present'
       when share < 0.99 then 'critical_parameter_missing_in_raw_and_target' else 'ok' end as status,
  case when raw_rows = 0 then 'investigate' when share >= 0.99 and target_missing_pct > 0 then 'low'
       when share < 0.99 then 'critical' else 'ok' end as severity
from origins_joined"""

# ---------------------------------------------------------------------------
# Contracts
# ---------------------------------------------------------------------------
BLOCKS["columns_of"] = """
select event_table, column_name, type from (select distinct event_table from fx_events),
  (values ('event_id', 'bigint'), ('created_at', 'timestamp_ntz'), ('adid', 'string'), ('user_id', 'string'),
   ('session_id', 'string'), ('session_uuid', 'string'), ('event_key', 'string'), ('platform', 'string'),
   ('region', 'string'), ('client_version', 'string'), ('legacy_flag', 'string'), ('step', 'string'),
   ('event_date', 'timestamp_ntz')) c(column_name, type)
union all
select 'event_order', * from (values ('created_at', 'timestamp_ntz'), ('adid', 'string'), ('status', 'string'),
   ('priority', 'string')) c(column_name, type)"""


def _canonical(column: str) -> str:
    return f"case when {column} in ('session_id', 'session_uuid', 'sessions_uuid') then 'session_id' else {column} end"


BLOCKS["contract_types"] = f"""
select parameter, type, tables from (
  select parameter, type, count(*) as tables,
    row_number() over (partition by parameter order by count(*) desc, min(event_table)) as n
  from (select event_table, {_canonical('column_name')} as parameter,
          arg_min(type, list_position(['session_id', 'session_uuid', 'sessions_uuid'], column_name)) as first_type,
          coalesce(first_type, min(type)) as type
        from columns_of group by 1, 2)
  group by parameter, type) where n = 1"""
_SYSTEM = (
    "'event_key','event_name','adid','user_id','session_id','character_id','client_version','platform',"
    "'region','server','server_region','server_version','tz_offset'"
)
BLOCKS["scopes"] = f"""
select parameter, count(distinct event_table) as event_tables,
  case when parameter in ({_SYSTEM}) then 'system' when count(distinct event_table) >= 3 then 'common'
       else 'event' end as scope
from parameter_frame group by parameter"""
BLOCKS["value_lists"] = """
select p.event_table, p.parameter, v.value, v.rank
from parameter_frame p join (
  select event_table, parameter, value,
    row_number() over (partition by event_table, parameter order by rank) as rank
  from ranked_values where period = 'lookback' and value <> '<MISSING>') v using (event_table, parameter)
where v.rank <= 5"""
BLOCKS["shared_examples"] = f"""
select parameter, string_agg(value, ',' order by n) as examples from (
  select parameter, value, row_number() over (partition by parameter order by seen) as n from (
    select {_canonical('parameter')} as parameter, value, min(row(event_table, rank)) as seen
    from value_lists group by 1, 2))
where n <= 5 group by parameter"""
_EXAMPLE = "4bcdd67e-0bbc-4ca8-b7a5-4ba29e28c30a"
_PRIORITY = (
    "case when parameter in ('adid','user_id','session_id','event_key') then 'extreme'"
    " when parameter in ('event_name','server_region','platform','step','value','type') then 'high'"
    " when parameter = 'tz_offset' then 'low' else 'normal' end"
)
BLOCKS["shared"] = f"""
select distinct parameter, 'system' as scope from contract_types where parameter in ({_SYSTEM})
union all
select parameter, 'common' from scopes where scope = 'common'"""
BLOCKS["held"] = f"select distinct event_table, {_canonical('column_name')} as parameter from columns_of"
BLOCKS["additions_base"] = f"""
select distinct event_table from src
where event_table <> '{UNKNOWN}'
  and event_table not in ('event_click', 'event_view', 'event_ghost', 'event_raw_only')"""
BLOCKS["additions"] = """
select 'event' as scope, b.event_table, t.parameter, t.type, coalesce(p.examples, '') as examples,
  'normal' as priority, false as ignored, false as event_required
from additions_base b left join (select * from types where parameter not in
    ('event_key', 'session_id', 'session_uuid', 'sessions_uuid', 'event_name', 'region', 'currency')) t
  using (event_table)
left join profile p using (event_table, parameter)"""
BLOCKS["contract"] = """
select * from (values
  ('system', null, 'event_key', 'String', '', 'extreme', false, true),
  ('system', null, 'session_id', 'String', '', 'extreme', false, true),
  ('system', null, 'event_name', 'String', '', 'high', false, true),
  ('common', null, 'region', 'String', 'US', 'high', false, true),
  ('common', null, 'currency', 'String', 'EUR', 'low', false, true),
  ('event', 'event_click', 'platform', 'String', 'ios', 'high', false, true),
  ('event', 'event_click', 'campaign', 'String', 'spring', 'normal', false, true),
  ('event', 'event_click', 'step', null, '', 'normal', true, true),
  ('system_exception', 'event_click', 'event_name', null, '', 'normal', false, true),
  ('event', 'event_view', null, null, '', 'normal', false, true),
  ('event', 'event_ghost', 'level', 'Int64', '1', 'normal', false, true),
  ('event', 'event_raw_only', null, null, '', 'normal', false, false)
) t(scope, event_table, parameter, type, examples, priority, ignored, event_required)"""

# ---------------------------------------------------------------------------
# Drill-downs
# ---------------------------------------------------------------------------
_DUP_KEYS = "event_table, event_time, adid, event_key"
BLOCKS["dup_samples"] = f"""
select *, row_number() over (partition by event_table order by rows_same_event_key_adid_time desc,
    event_time, adid, event_key) as rank
from (
  select {_DUP_KEYS}, count(*) as rows_same_event_key_adid_time,
    count(distinct main_id) as unique_main_identifiers
  from canon where adid is not null and event_key is not null
  group by {_DUP_KEYS} having count(*) > 1)
qualify rank <= 50"""
BLOCKS["burst_groups"] = """
select *, row_number() over (partition by event_table order by rows_same_second desc, event_time, adid) as rank
from (
  select event_table, event_time, adid, count(*) as rows_same_second, count(distinct event_key) as unique_event_keys
  from canon where adid is not null and event_key is not null
  group by event_table, event_time, adid having count(distinct event_key) > 3)
qualify rank <= 50"""


def _mode(label: str, keys: str, groups: str) -> str:
    """Most frequent label per group, the smallest on a tie."""
    return (
        f"(select {keys}, {label}_label as most_common_{label} from ("
        f"select {keys}, {label}_label, row_number() over (partition by {keys}"
        f" order by count(*) desc, {label}_label) as n from canon"
        f" where adid is not null and event_key is not null group by {keys}, {label}_label)"
        f" where n = 1) {groups}"
    )


BLOCKS["missing_ids"] = """
select *, row_number() over (partition by event_table order by rows_in_range desc, step, type) as rank,
  round(missing_main_identifier_rows / rows_in_range::double, 6) as missing_main_identifier_pct,
  round(missing_session_id_rows / rows_in_range::double, 6) as missing_session_id_pct
from (
  select event_table, step_label as step, type_label as type, count(*) as rows_in_range,
    count(*) filter (where main_id is null) as missing_main_identifier_rows,
    count(*) filter (where session_id is null) as missing_session_id_rows
  from canon where event_table in ('event_signup', 'event_error') group by 1, 2, 3)
where missing_main_identifier_rows > 0 or missing_session_id_rows > 0
qualify rank <= 100"""


def _expectation(source: str) -> str:
    return f"""
select event_table, step, type, 'user_id' as identifier,
  case when event_table = 'event_signup' then 'expected' else 'unexpected' end as expectation,
  missing_main_identifier_pct as missing_pct, rows_in_range from {source} where missing_main_identifier_pct > 0
union all
select event_table, step, type, 'session identifier', 'unexpected', missing_session_id_pct, rows_in_range
from {source} where missing_session_id_pct > 0"""


BLOCKS["missing_first"] = """
select * from missing_ids"""
BLOCKS["expectation_first"] = _expectation("missing_first")
BLOCKS["late"] = """
select event_table, created_at as event_time from fx_events where created_at > timestamp '2024-01-28 12:10:00'"""

# ---------------------------------------------------------------------------
# Shipments: line items as an event table
# ---------------------------------------------------------------------------
BLOCKS["ship_groups"] = """
select l_shipdate as event_time, l_suppkey as adid, l_orderkey as event_key, count(*) as group_rows
from lineitem where l_shipdate >= timestamp '1990-01-01' and l_shipdate < timestamp '2006-01-01'
  and l_suppkey is not null and l_orderkey is not null
group by 1, 2, 3"""
BLOCKS["ship_seconds"] = """
select event_time, adid, cast(sum(group_rows) as bigint) as n_rows, count(*) as n_keys
from ship_groups group by 1, 2"""
BLOCKS["ship_bursts"] = """
select event_time, adid, n_rows as rows_same_second, n_keys as unique_event_keys,
  row_number() over (order by n_rows desc, event_time, cast(adid as varchar)) as rank
from ship_seconds where n_keys > 3 qualify rank <= 50"""


def _finding(section: str, rank: int, order: str, issue: str, metric: str, value: str, rows: str,
             source: str, level: str = "'normal'", parameter: str = "null", step: str = "null",
             table: str = "event_table") -> str:
    return (
        f"select {section} as section, {rank} as source_rank, cast({order} as double) as order_key,"
        f" {table} as event_table, cast({parameter} as varchar) as parameter,"
        f" cast({step} as varchar) as step, {issue} as issue, {metric} as metric,"
        f" cast({value} as double) as value, cast({rows} as bigint) as rows, {level} as severity from {source}"
    )


def _has(flag: str) -> str:
    return f"(select * from status_frame where list_contains(string_split(status, ', '), '{flag}'))"


_traced = (
    "(select * from origins where diagnosis in"
    " ('source_payload_parameter_missing', 'likely_parser_or_column_mapping_issue'))"
)
_severe = "(select * from flows where severity in ('critical', 'low'))"
_FINDINGS = [
    _finding("severity || '_delivery'", 1, "0", "status", "'raw_rows'", "raw_rows",
             "coalesce(parsed_rows, 0)", _severe, "severity"),
    _finding("severity || '_delivery'", 2, _rank("report_priority"), "diagnosis", "'raw_presence_pct'",
             "raw_presence_pct", "raw_rows", _traced, "severity", "parameter"),
    _finding("case when scope = 'system' then 'system_parameters' else 'value_parameters' end", 2,
             _rank("report_priority"), "diagnosis", "'raw_presence_pct'", "raw_presence_pct", "raw_rows",
             _traced, "severity", "parameter"),
    _finding("'value_parameters'", 4, "position", "problems", "'missing_pct'", "max_missing_pct",
             "affected_events",
             "(select *, row_number() over (order by urgency) as position from problem_groups)",
             "report_priority", "parameter", table="first_table"),
    _finding("'confirmed'", 2, "-future_event_time_rows", "'future_event_time'", "'future_event_time_rows'",
             "future_event_time_rows", "rows_in_range",
             "(select * from scan where future_event_time_rows > 0)"),
    _finding("'confirmed'", 3, "0", "schema_warnings", "'schema_warnings'",
             "len(string_split(schema_warnings, '; '))", "rows_in_range",
             "(select * from scan where schema_warnings <> '')"),
    _finding("case when expectation = 'expected' then 'expected' else 'investigate' end", 9, "-rows_in_range",
             "expectation || '_missing_identifier'", "'missing_pct'", "missing_pct", "rows_in_range",
             "expectation_first", parameter="identifier", step="step"),
    _finding("'investigate'", 1, "0", "'same_second_burst_high'", "'same_second_burst_pct'",
             "same_second_burst_pct", "rows_in_range", _has("same_second_burst_high")),
    _finding("'investigate'", 3, "0", "'no_rows_unclassified'", "'rows_in_range'", "null", "rows_in_range",
             f"(select * from {_has('no_rows_in_range')} where event_table not in (select event_table from {_severe}))"),
]
for _position, (_name, _label) in enumerate(
    (("missing_adid", "adid"), ("missing_main_identifier", "user_id"),
     ("missing_session_id", "session identifier"))
):
    _FINDINGS.append(
        _finding("'system_parameters'", 3, str(_position), f"'{_name}_high'", f"'{_name}_pct'",
                 f"{_name}_pct", "rows_in_range", _has(f"{_name}_high"), parameter=f"'{_label}'")
    )
for _position, _name in enumerate(("duplicate", "replicated")):
    _FINDINGS.append(
        _finding("'confirmed'", 1, str(_position), f"'{_name}_high'", f"'{_name}_pct'", f"{_name}_pct",
                 "rows_in_range", _has(f"{_name}_high"))
    )
for _name in ("suspicious_high", "suspicious_low"):
    _FINDINGS.append(
        _finding("'investigate'", 2, "0", f"'{_name}'", "'delta_vs_lookback_expected'", "delta",
                 "rows_in_range", _has(_name))
    )
BLOCKS["all_findings"] = "\nunion all\n".join(_FINDINGS)

# ---------------------------------------------------------------------------
# Final statements
# ---------------------------------------------------------------------------
FORMAT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
FINAL: dict[str, str] = {}

FINAL["canonical_events"] = f"""
select event_table, {FORMAT.format('event_time')} as event_time, adid, main_id, session_id, event_key, step
from canon"""

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
_counts = " union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in _TABLES)
_columns = " union all ".join(
    f"select '{t}' as table_name, column_name from (describe select * from {t})" for t in _TABLES
)
FINAL["table_inventory"] = f"""
select table_name, any_value(n) as estimated_rows, count(*) as column_count,
  string_agg(column_name, ',' order by column_name) as columns,
  case when bool_or(column_name = 'ts') then 'ts' when bool_or(column_name = 'o_orderdate') then 'o_orderdate' end
    as measurement_time_column,
  bool_or(column_name = 'user_id') as has_main_id, bool_or(column_name = 'adid') as has_adid,
  table_name = 'events' as is_mandatory
from ({_columns}) join ({_counts}) using (table_name) group by table_name"""

FINAL["blacklist_filter"] = """
select event_table, count(*) as n_rows from fx_events
where not regexp_matches(lower(event_table), '^event_cl.*$') and not regexp_matches(lower(event_table), '^event_e.ror$')
group by event_table"""


def _counted(form: str, condition: str) -> str:
    return f"select '{form}' as form, event_table, count(*) as n_rows from fx_events where {condition} group by event_table"


def _span(low: str, high: str) -> str:
    return f"created_at >= timestamp '{low}' and created_at < timestamp '{high}'"


_SECOND = "(extract(hour from created_at) * 3600 + extract(minute from created_at) * 60 + extract(second from created_at))"
FINAL["window_rows"] = " union all ".join(
    [
        _counted("fixed", _span("2024-01-24 00:00:00", "2024-01-31 00:00:00")),
        _counted("rolling_days", _span("2024-01-25 12:30:00", "2024-01-28 12:30:00")),
        _counted("rolling_hours", _span("2024-01-27 00:30:00", "2024-01-28 12:30:00")),
        _counted("afternoon", _span("2024-01-30 16:00:00", "2024-01-30 18:00:00")),
        _counted("past_midnight", _span("2024-01-29 22:30:00", "2024-01-30 00:30:00")),
    ]
)
FINAL["lookback_rows"] = " union all ".join(
    [
        _counted("fixed", _span("2024-01-10 00:00:00", "2024-01-24 00:00:00")),
        _counted("rolling_days", _span("2024-01-11 12:30:00", "2024-01-25 12:30:00")),
        _counted("rolling_hours", _span("2024-01-17 00:30:00", "2024-01-27 00:30:00")),
    ]
)
FINAL["aligned_lookback_rows"] = " union all ".join(
    [
        _counted(
            "afternoon",
            _span("2024-01-02 16:00:00", "2024-01-30 16:00:00")
            + f" and {_SECOND} >= 57600 and {_SECOND} < 64800",
        ),
        _counted(
            "past_midnight",
            _span("2024-01-01 22:30:00", "2024-01-29 22:30:00")
            + f" and ({_SECOND} >= 81000 or {_SECOND} < 1800)",
        ),
    ]
)
FINAL["normalized_identifiers"] = "select event_id, " + ", ".join(
    f"{norm(n)} as {n}" for n in ("adid", "user_id", "session_id", "session_uuid", "event_key")
) + " from fx_events"
FINAL["identifier_alias_coalesce"] = f"""
select event_id, coalesce({norm('session_id')}, {norm('session_uuid')}) as session,
  'session_id,session_uuid' as session_columns, cast(null as varchar) as device, '' as device_columns
from fx_events"""
_PLACE = "({0} is not null and not (" + invalid_in("{0}") + " or not regexp_matches({0}, '^([a-z]+|[A-Z]{{2}})$')))"
FINAL["valid_first_alias"] = f"""
select event_id, place,
  coalesce({invalid_in('place')} or not regexp_matches(place, '^([a-z]+|[A-Z]{{2}})$'), false) as place_invalid
from (select event_id, coalesce(case when {_PLACE.format('r')} then r end,
        case when {_PLACE.format('p')} then p end, r, p) as place
      from (select event_id, {norm('region')} as r, {norm('platform')} as p from fx_events))"""
_KEY = number("k")
_VERSION = number("c")
FINAL["invalid_values"] = f"""
select event_id,
  ({invalid_in('r')} or not regexp_matches(r, '^[A-Z]{{2}}$')) as region_invalid,
  ({invalid_in('p')} or lower(p) not in ('ios', 'android')) as platform_invalid,
  ({invalid_in('k')} or {_KEY} is null or {_KEY} < 2 or {_KEY} > 9.5) as event_key_invalid,
  ({invalid_in('c')} or {_VERSION} is null or {_VERSION} < 1) as client_version_invalid,
  {invalid_in('s')} as session_id_invalid
from (select event_id, {norm('region')} as r, {norm('platform')} as p, {norm('event_key')} as k,
        {norm('client_version')} as c, {norm('session_id')} as s from fx_events)"""
FINAL["source_event_names"] = """
select 'source_events' as source_table, event_table, raw_type, count(*) as n_rows from src_all group by all
union all
select 'source_events_dlq', event_table, raw_type, count(*) from dlq_all group by all"""
FINAL["json_validity"] = """
select 'source_events' as source_table, valid, count(*) as n_rows from src_json group by all
union all select 'source_events_dlq', valid, count(*) from dlq_json group by all"""
FINAL["dlq_shapes"] = """
select dlq_shape, has_event_parameters, count(*) as n_rows from dlq_all group by all"""
FINAL["payload_parameters"] = "select row_id, parameter, raw_value from src_keys_all"
FINAL["raw_parameter_types"] = _types("kinds_all")


def _redaction() -> str:
    current, inner = "t0", "select doc_id, coalesce(text, '') as t0 from documents"
    counts = []
    for index, (name, pattern, replacement, _) in enumerate(redact.RULES, start=1):
        quoted = pattern.replace("'", "''")
        target = replacement.replace("$1", "\\1")
        counts.append(name)
        inner = (
            f"select *, cast(len(regexp_extract_all({current}, '{quoted}')) as bigint) as {name},"
            f" regexp_replace({current}, '{quoted}', '{target}', 'g') as t{index} from ({inner})"
        )
        current = f"t{index}"
    whole = f"trim(regexp_replace({current}, '\\s+', ' ', 'g'), ' ')"
    return (
        f"select doc_id, redacted, {', '.join(counts)}, case when length(redacted) <= 180 then redacted"
        f" else rtrim(substring(redacted, 1, 180), ' ') || '...' end as preview"
        f" from (select *, {whole} as redacted from ({inner}))"
    )


FINAL["redact_text"] = _redaction()
FINAL["event_base_metrics"] = f"""
select event_table, count(*) as rows_total, {FORMAT.format('min(event_time)')} as min_event_time,
  {FORMAT.format('max(event_time)')} as max_event_time,
  count(*) filter (where adid is null) as missing_adid_rows,
  count(*) filter (where main_id is null) as missing_main_identifier_rows,
  count(*) filter (where session_id is null) as missing_session_id_rows,
  count(*) filter (where event_key is null) as missing_event_key_rows
from canon group by event_table"""
FINAL["today_yesterday_rows"] = """
select event_table,
  count(*) filter (where event_time >= timestamp '2024-01-29' and event_time < timestamp '2024-01-30') as rows_today,
  count(*) filter (where event_time >= timestamp '2024-01-28' and event_time < timestamp '2024-01-29') as rows_yesterday
from canon_all
where event_time >= timestamp '2024-01-22 12:00:00' and event_time < timestamp '2024-01-29 12:00:00'
group by event_table"""
FINAL["missing_with_step_exceptions"] = "select *, " + ", ".join(
    f"round({n}_rows / rows_in_range::double, 6) as {n}_pct"
    for n in ("missing_adid", "missing_main_identifier", "missing_session_id", "missing_event_key")
) + " from missing_counts"
FINAL["future_event_rows"] = f"""
select event_table, count(*) as future_event_time_rows,
  {FORMAT.format('max(event_time)')} as max_future_event_time from late group by event_table"""
FINAL["duplicate_rows"] = "select event_table, duplicate_rows from anomalies"
FINAL["replicated_rows"] = "select event_table, replicated_rows from anomalies"
FINAL["same_second_burst_rows"] = "select event_table, same_second_burst_rows from anomalies"
FINAL["shipment_anomalies"] = """
select 'event_shipment' as event_table,
  (select cast(sum(group_rows - 1) as bigint) from ship_groups) as duplicate_rows,
  (select count(*) - count(distinct event_key) from ship_groups) as replicated_rows,
  (select cast(coalesce(sum(n_rows), 0) as bigint) from ship_seconds where n_keys > 3) as same_second_burst_rows"""
FINAL["burst_group_annotation"] = f"""
select event_table, {FORMAT.format('event_time')} as event_time, adid, event_key, group_rows, rows_in_second,
  unique_event_keys, key_rank as row_number, key_rank = 1 as is_first_key from annotated"""
FINAL["volume_vs_lookback"] = """
select event_table, rows_in_range, lookback_rows, round(lookback_rows / 2.0::double, 6) as expected_rows_from_lookback,
  case when lookback_rows > 0 then
    round((rows_in_range - lookback_rows / 2.0::double) / (lookback_rows / 2.0::double), 6) end
    as delta_vs_lookback_expected
from history"""
FINAL["rolling_volume"] = f"""
select event_table, rows_in_range, lookback_rows, round(lookback_rows / 2.0::double, 6) as expected_rows_from_lookback,
  case when lookback_rows > 0 then
    round((rows_in_range - lookback_rows / 2.0::double) / (lookback_rows / 2.0::double), 6) end
    as delta_vs_lookback_expected
from history where rows_in_range + lookback_rows > 0"""
FINAL["rolling_parameter_metrics"] = "select * from parameter_counts"
FINAL["event_status"] = """
select event_table, status, rows_in_range, missing_adid_rows, missing_main_identifier_rows, missing_session_id_rows,
  missing_event_key_rows, duplicate_rows, replicated_rows, same_second_burst_rows, lookback_rows, missing_adid_pct,
  missing_session_id_pct, duplicate_pct, replicated_pct, same_second_burst_pct,
  round(delta, 6) as delta_vs_lookback_expected,
  case when has_session then 'session_id,session_uuid' else '' end as session_id_columns,
  case when has_main then 'user_id' else '' end as main_identifier_columns,
  case when event_table = 'event_order' then 'created_at' else 'event_date' end as measurement_time_column
from status_frame"""
BLOCKS["stop_names"] = f"""
select event_table, cast(min(event_date) as date) as first_day, cast(max(event_date) as date) as last_day,
  count(*) filter (where event_date >= timestamp '{START}' and event_date < timestamp '{STOP}') as rows_in_range
from fx_events
where (event_table <> 'event_signup' or created_at < timestamp '2024-01-08')
  and (event_date >= timestamp '{BACK}' or (created_at < timestamp '2024-01-10' and event_date >= timestamp '2024-01-01'))
group by event_table"""
BLOCKS["stop_flows"] = f"""
select *, {_FLOW_FLAGS} as flags from (
  select n.*, true as target_table_exists, rows_in_range as parsed_rows, coalesce(s.raw_rows, 0) as raw_rows,
    coalesce(d.dlq_rows, 0) as dlq_rows
  from stop_names n left join summary s using (event_table)
  left join (select event_table, cast(sum(dlq_rows) as bigint) as dlq_rows from letters group by event_table) d
    using (event_table))"""
FINAL["stopped_event_types"] = f"""
select event_table, strftime(first_day, '%Y-%m-%d') as first_day, strftime(last_day, '%Y-%m-%d') as last_day,
  rows_in_range, rows_in_range = 0 as no_rows, last_day < cast(timestamp '{BACK}' as date) as stopped,
  coalesce(nullif(flags, ''), 'ok') as flow_status
from stop_flows"""
FINAL["problem_signal"] = """
select event_table, problem_signal_rows,
  round(problem_signal_rows / nullif(rows_in_range, 0)::double, 6) as problem_signal_pct from signal"""
FINAL["scan_problems"] = """
select event_table, case when problems = '' and schema_warnings = '' then 'ok' else 'problem' end as scan_status,
  problems, schema_warnings from scan"""
FINAL["classified_findings"] = "\nunion all\n".join(_CLASSES)
FINAL["parameter_metrics"] = "select * from parameter_counts"
FINAL["parameter_top_values"] = "select event_table, parameter, value, period, value_rows, rank from ranked_values"
FINAL["sketched_top_counts"] = "select event_table, parameter, period, rank, value_rows from ranked_values"
FINAL["parameter_status"] = """
select event_table, parameter, status, problem, source_columns, rows_checked, missing_rows, invalid_rows,
  lookback_rows_checked, lookback_missing_rows, missing_pct, invalid_pct, lookback_presence_pct,
  expected_present_rows, presence_delta_pct, inferred_required, report_priority from parameter_frame"""
_now = f"created_at >= timestamp '{START}' and created_at < timestamp '{STOP}'"
FINAL["parameters_of_several_sources"] = f"""
select event_table, parameter, count(*) filter (where {_now}) as rows_checked,
  count(*) filter (where {_now} and value is null) as missing_rows,
  count(*) filter (where not ({_now})) as lookback_rows_checked
from (
  select event_table, created_at, 'client_version' as parameter, client_version as value from fx_events
  union all
  select event_table, created_at, case when event_table in ('event_click', 'event_view') then 'alpha' else 'beta' end,
    case when event_table in ('event_click', 'event_view') then region else step end from fx_events
  union all
  select 'event_joined', created_at, 'gamma', region from fx_events where event_table = 'event_signup')
where created_at >= timestamp '{BACK}' and created_at < timestamp '{STOP}'
group by event_table, parameter"""
FINAL["prioritized_parameter_problems"] = """
select event_table, parameter, problem, cast(priority_rank as bigint) as priority_rank,
  cast(contract_rank as bigint) as contract_rank, cast(schema_rank as bigint) as schema_rank, missing_pct from urgent"""
FINAL["parameter_problem_groups"] = """
select report_priority, parameter, problems, affected_events, max_missing_pct from problem_groups"""
FINAL["unpopulated_columns"] = """
select event_table, count(*) as columns_unpopulated,
  string_agg(parameter, ', ' order by parameter) filter (where n <= 12) as preview,
  greatest(count(*) - 12, 0) as not_shown
from (select *, row_number() over (partition by event_table order by parameter) as n from parameter_frame
      where list_contains(string_split(problem, ','), 'unpopulated_column')) group by event_table"""
FINAL["source_event_summary"] = _summary("src_all")
FINAL["source_modes"] = """
select event_table, mode, count(*) as raw_rows from src_all where mode <> '' group by event_table, mode"""
FINAL["payload_facts"] = """
select t.event_table, t.parameter, t.type, t.raw_rows, t.typed_rows, p.raw_present_rows, x.examples, x.raw_examples
from types t left join presence p using (event_table, parameter)
left join (select * from profile where event_table not in
  ('event_click', 'event_view', 'event_ghost', 'event_raw_only')) x using (event_table, parameter)"""
FINAL["dlq_summary"] = _letters("dlq_all")
FINAL["dlq_validation_errors"] = """
select event_table, 'source_events_dlq' as dlq_source_table, dlq_shape, validation_error, count(*) as dlq_rows
from (select row_id, event_table, dlq_shape, unnest(list_distinct(validation_errors)) as validation_error from dlq_all)
group by event_table, dlq_shape, validation_error"""
FINAL["raw_parameter_profile"] = f"select event_table, parameter, raw_examples from ({_profile('src_keys_all')})"
FINAL["raw_parameter_presence"] = _presence("src_keys_all")
FINAL["event_flow_reconciliation"] = "select * from flows"
FINAL["parameter_problem_pairs"] = "select * from pairs"
FINAL["parameter_origin"] = "select * from origins"
FINAL["flow_summary"] = """
select 'source_event_types' as counter, count(*) as value from summary
union all select 'dlq_rows', cast(sum(dlq_rows) as bigint) from letters
union all select 'critical_event_flows', count(*) from flows where status like '%critical_%'
union all select 'low_event_flows', count(*) from flows where severity = 'low'
union all select 'parameter_checks', count(*) from origins
union all select 'source_parameter_missing', count(*) from origins where diagnosis = 'source_payload_parameter_missing'
union all select 'likely_parser_parameter_issues', count(*) from origins
  where diagnosis = 'likely_parser_or_column_mapping_issue'
union all select 'critical_parameter_issues', count(*) from origins where severity = 'critical'
union all select 'low_parameter_issues', count(*) from origins where severity = 'low'"""
FINAL["contract_types"] = "select * from contract_types"
FINAL["parameter_scopes"] = "select * from scopes"
FINAL["inferred_contract"] = f"""
select s.scope, cast(null as varchar) as event_table, parameter, coalesce(t.type, '') as type,
  coalesce(nullif(e.examples, ''), case
    when parameter in ('adid', 'user_id', 'session_id', 'event_key') then '{_EXAMPLE}'
    when parameter = 'platform' then 'ios' when parameter = 'tz_offset' then '180' else '' end) as examples,
  {_PRIORITY} as priority
from shared s left join contract_types t using (parameter) left join shared_examples e using (parameter)
union all
select 'event', p.event_table, p.parameter, coalesce(c.type, ''), coalesce(e.examples, ''), {_PRIORITY.replace('parameter', 'p.parameter')}
from parameter_frame p
left join columns_of c on c.event_table = p.event_table and c.column_name = p.parameter
left join (select event_table, parameter, string_agg(value, ',' order by rank) as examples
           from value_lists group by all) e on e.event_table = p.event_table and e.parameter = p.parameter
where p.parameter not in (select parameter from shared)
union all
select 'system_exception', t.event_table, s.parameter, '', '', 'normal'
from (select distinct event_table from columns_of) t, (select parameter from shared where scope = 'system') s
where not exists (select 1 from held h where h.event_table = t.event_table and h.parameter = s.parameter)"""
FINAL["contract_violations"] = """
select event_table, '*' as parameter, 'problem' as status, 'missing_event' as problem, 'high' as report_priority
from (select distinct event_table from contract where scope in ('event', 'system_exception') and event_required)
where event_table not in (select event_table from columns_of)
union all
select event_table, parameter, case when required then 'problem' else 'skipped' end,
  case when required then 'missing_column' else 'column_not_present' end, priority
from (
  select event_table, parameter, bool_or(required) as required, min(priority) as priority from (
    select event_table, parameter, true as required, priority from contract
    where scope = 'event' and parameter is not null and not ignored
    union all
    select e.event_table, c.parameter, c.scope = 'system', c.priority
    from (select distinct event_table from contract where scope = 'event') e,
         (select * from contract where scope in ('system', 'common')) c
    where not exists (select 1 from contract x where x.scope = 'system_exception'
                      and x.event_table = e.event_table and x.parameter = c.parameter)) d
  where event_table in (select event_table from columns_of)
    and not exists (select 1 from contract x where x.ignored and x.event_table = d.event_table
                    and x.parameter = d.parameter)
  group by event_table, parameter) d
where not exists (select 1 from held h where h.event_table = d.event_table and h.parameter = d.parameter)"""
FINAL["contract_additions"] = "select * from additions"
FINAL["contract_merge"] = "select * from contract union all select * from additions"
FINAL["missing_schema_tables"] = """
select distinct event_table from fx_events where event_table not in (select event_table from src_keys_all)"""
FINAL["drilldown_candidates"] = """
select event_table, round(worst / greatest(rows_in_range, 1)::double, 6) as score from (
  select *, greatest(coalesce(duplicate_rows, 0), coalesce(future_event_time_rows, 0),
    case when event_table = 'event_click' then 0 else coalesce(same_second_burst_rows, 0) end) as worst from metrics)
where worst > 0"""
FINAL["flagged_tables"] = """
select event_table, status from status_frame where status not in ('ok', 'no_rows_in_range')"""
FINAL["drilldown_tables"] = """
select event_table from metrics
where greatest(coalesce(duplicate_rows, 0), coalesce(future_event_time_rows, 0),
  case when event_table = 'event_click' then 0 else coalesce(same_second_burst_rows, 0) end) > 0
union
select event_table from status_frame where status not in ('ok', 'no_rows_in_range')"""
FINAL["configured_drilldown_tables"] = """
select event_table from metrics where event_table in ('event_view', 'event_order', 'event_absent')"""
_dup_joins = " ".join(
    f"left join {_mode(n, _DUP_KEYS, f'm_{n}')} using ({_DUP_KEYS})"
    for n in ("platform", "region", "server_region", "step", "type")
)
FINAL["duplicate_samples"] = f"""
select event_table, {FORMAT.format('event_time')} as event_time, adid, event_key, rows_same_event_key_adid_time,
  rank, unique_main_identifiers, most_common_platform, most_common_region, most_common_server_region,
  most_common_step, most_common_type
from dup_samples {_dup_joins}"""
_SEC_KEYS = "event_table, event_time, adid"
_burst_joins = " ".join(
    f"left join {_mode(n, _SEC_KEYS, f'm_{n}')} using ({_SEC_KEYS})"
    for n in ("platform", "region", "server_region")
)
FINAL["burst_samples"] = f"""
select event_table, {FORMAT.format('event_time')} as event_time, adid, rows_same_second, unique_event_keys, rank,
  most_common_platform, most_common_region, most_common_server_region
from burst_groups {_burst_joins}"""
FINAL["burst_labels"] = f"""
select event_table, {FORMAT.format('event_time')} as event_time, adid, rank, label, value, count(*) as n
from (
  select {_SEC_KEYS}, 'step' as label, step_label as value from canon where adid is not null and event_key is not null
  union all
  select {_SEC_KEYS}, 'type', type_label from canon where adid is not null and event_key is not null)
join burst_groups using ({_SEC_KEYS})
where value is not null group by all"""
FINAL["shipment_burst_samples"] = f"""
select 'event_shipment' as event_table, {FORMAT.format('event_time')} as event_time, cast(adid as varchar) as adid,
  rows_same_second, unique_event_keys, rank, 'NO_COLUMN' as most_common_platform, 'NO_COLUMN' as most_common_region,
  'NO_COLUMN' as most_common_server_region
from ship_bursts"""
FINAL["shipment_burst_labels"] = f"""
select 'event_shipment' as event_table, {FORMAT.format('event_time')} as event_time, cast(adid as varchar) as adid,
  rank, label, value, count(*) as n
from (
  select l_shipdate as event_time, l_suppkey as adid, 'step' as label, l_returnflag as value from lineitem
  union all
  select l_shipdate, l_suppkey, 'type', l_linestatus from lineitem)
join ship_bursts using (event_time, adid)
where value is not null group by all"""
FINAL["missing_ids_by_step"] = "select * from missing_ids"
FINAL["missing_id_expectation"] = _expectation("missing_ids")
FINAL["future_samples"] = f"""
select event_table, {FORMAT.format('event_time')} as event_time, rank, '2024-01-28 12:00:00' as checked_at
from (select *, row_number() over (partition by event_table order by event_time desc) as rank from late)
where rank <= 50"""
FINAL["sample_summary"] = """
select event_table, count(*) as sample_groups, max(n) as max_rows, max(ids) as max_unique, 'duplicate' as kind
from (select event_table, count(*) as n, count(distinct main_id) as ids
  from canon where adid is not null and event_key is not null
  group by event_table, event_time, adid, event_key having count(*) > 1) group by event_table
union all
select event_table, count(*), max(n), max(keys), 'burst'
from (select event_table, count(*) as n, count(distinct event_key) as keys
  from canon where adid is not null and event_key is not null and event_table <> 'event_click'
  group by event_table, event_time, adid having count(distinct event_key) > 3) group by event_table"""
_places = (
    "case section when 'critical_delivery' then 1 when 'low_delivery' then 2 when 'system_parameters' then 3"
    " when 'value_parameters' then 4 when 'confirmed' then 5 when 'expected' then 6 else 7 end"
)
FINAL["findings_report"] = f"""
select section, event_table, parameter, step, issue, metric, round(value, 6) as value, rows, severity, rank,
  cast({_places} as bigint) as section_order
from (select *, row_number() over (partition by section order by source_rank, order_key, event_table nulls first,
        parameter nulls first, step nulls first, issue) as rank from all_findings)"""
FINAL["run_summary"] = """
select 'tables_checked' as counter, count(*) as value from scan
union all select 'problem_tables', count(*) from scan where problems <> '' or schema_warnings <> ''
union all select 'rows_in_range', cast(sum(rows_in_range) as bigint) from scan
union all select 'flagged_tables', count(*) from status_frame where status <> 'ok'
union all select 'tables_without_rows', count(*) from status_frame where contains(status, 'no_rows_in_range')
union all select 'parameters_checked', count(*) from parameter_frame
union all select 'parameter_problems', count(*) from parameter_frame where status = 'problem'"""


def _needed(text: str) -> set[str]:
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & BLOCKS.keys() - found:
            found.add(name)
            pending.append(BLOCKS[name])
    return found


def statement(final: str) -> str:
    """A final SELECT with the blocks it uses in front, in order of definition."""
    needed = _needed(final)
    # Blocks that are named like a result column are only used where read from.
    blocks = [f"{name} as ({body.strip()})" for name, body in BLOCKS.items() if name in needed]
    return ("with " + ",\n".join(blocks) + "\n" if blocks else "") + final.strip()


def all_statements() -> dict[str, str]:
    return {name: statement(final) for name, final in FINAL.items()}
