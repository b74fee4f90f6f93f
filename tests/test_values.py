import pytest
from pyspark.sql import functions as F

from eventgauge.functions import payload as P
from eventgauge.functions import redact
from eventgauge.functions import values as V

ZERO = "00000000-0000-0000-0000-000000000000"


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (None, None), ("", None), ("   ", None), ("null", None), ("NULL", None), (ZERO, None),
        ("\t", "\t"), (" null ", " null "), (" a ", " a "), ("0", "0"), (ZERO[:-1] + "1", ZERO[:-1] + "1"),
    ],
)
def test_normalized(spark, value, expected):
    frame = spark.createDataFrame([(value,)], "v string")
    row = frame.select(V.normalized("v").alias("n"), V.is_missing("v").alias("m")).first()
    assert row.n == expected and row.m == (expected is None)


def test_normalized_casts_and_quotes(spark):
    frame = spark.createDataFrame([(7,)], "`odd ``name` long")
    assert frame.select(V.normalized("odd `name")).first()[0] == "7"


@pytest.mark.parametrize(
    ("value", "broken"),
    [
        ("12.5", False), ("abc", True), (" 12 ", True), ("inf", True), ("-inf", True), ("nan", False),
        ("1d", True), ("5", False), ("4.99", True), ("20.1", True), ("1e1", False), (".5e1", False), ("+7", False),
    ],
)
def test_limits(spark, value, broken):
    frame = spark.createDataFrame([(value,)], "v string")
    rule = {"min_value": 5, "max_value": 20}
    assert frame.select(V.is_invalid(F.col("v"), rule, [])).first()[0] is broken


@pytest.mark.parametrize(
    ("rule", "value", "broken"),
    [
        ({}, "anything", False), ({}, "Unknown", True), ({"invalid_values": []}, "Unknown", False),
        ({"invalid_values": "bad, worse"}, "WORSE", True), ({"allowed_values": ["iOS"]}, "ios", False),
        ({"allowed_values": ["iOS"]}, "web", True), ({"allowed_pattern": "^[A-Z]{2}$"}, "US", False),
        ({"allowed_pattern": "^[A-Z]{2}$"}, "us", True), ({"allowed_pattern": "b"}, "abc", False),
    ],
)
def test_invalid_rules(spark, rule, value, broken):
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(V.is_invalid(F.col("v"), rule, ["unknown"])).first()[0] is broken


def test_first_valid_prefers_valid_and_keeps_invalid(spark):
    data = [("unknown", "ok"), ("unknown", None), (None, "unknown"), (None, " "), ("a", "b")]
    frame = spark.createDataFrame(data, "x string, y string")
    value, columns = V.first_valid(["x", "gone", "y"], frame.columns, {}, ["unknown"])
    assert columns == ["x", "y"]
    assert [r[0] for r in frame.select(value).collect()] == ["ok", "unknown", "unknown", None, "a"]
    assert V.first_present(["gone"], frame.columns)[1] == []


def test_dimension(spark):
    frame = spark.createDataFrame([("",), (None,), ("a",)], "d string")
    shown = frame.select(V.dimension("d", frame.columns), V.dimension("e", frame.columns)).collect()
    assert [tuple(r) for r in shown] == [("NULL", "NO_COLUMN"), ("NULL", "NO_COLUMN"), ("a", "NO_COLUMN")]


def test_ratio_of_nothing(spark):
    row = spark.range(1).select(V.pct(F.lit(1), F.lit(3)), V.pct(F.lit(1), F.lit(0))).first()
    assert tuple(row) == (0.333333, None)


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ('{"a":1}', True), ('{"a":1} xyz', False), ('{"a":1}] g', False), ('{"a":1},{"b":2}', False),
        ('{"a":1},"y":2', False), ("", False), (" ", False), ("[1,2]", True), ("not json", False),
        ('{"a":1,"a":2}', True), ("null", True), ('"abc"', True), ("{'a':1}", False), ("{broken", False),
        ('  {"a": 1}\n', True), (None, False),
    ],
)
def test_json_validity(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "p string")
    assert frame.select(P.is_valid_json(P.enclosed(F.col("p")))).first()[0] is valid


@pytest.mark.parametrize(
    ("text", "shape", "name"),
    [
        ('{"event":{"name":"x.login"}}', "legacy_event_envelope", "login"),
        ('{"event":null}', "legacy_event_envelope", "__UNKNOWN__"),
        ('{"type":5,"params":{}}', "standard_type_params", "__UNKNOWN__"),
        ('{"type":"a.b.show","params":null}', "standard_type_params", "show"),
        ('{"type":"","event":{"name":"n"}}', "legacy_event_envelope", "n"),
        ('{"type":"a."}', "unknown_json_shape", "__UNKNOWN__"),
        ("[1]", "unknown_json_shape", "__UNKNOWN__"), ("{", "invalid_json", "__UNKNOWN__"),
    ],
)
def test_shapes_and_names(spark, text, shape, name):
    wrapped = P.enclosed(F.col("p"))
    frame = spark.createDataFrame([(text,)], "p string").select(wrapped.alias("w"))
    valid = P.is_valid_json(F.col("w"))
    candidates = [P.filled_text(P.at(F.col("w"), "type")), P.filled_text(P.at(F.col("w"), "event", "name"))]
    row = frame.select(P.dlq_shape(valid, F.col("w")), P.event_name(candidates)).first()
    assert tuple(row) == (shape, name)


def test_string_arrays(spark):
    texts = ['{"e":["a","b"]}', '{"e":"a"}', '{"e":[1,"x"]}', "{}", "{"]
    frame = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r[0] for r in frame.select(P.texts_at(P.enclosed(F.col("p")), "e")).collect()]
    assert got == [["a", "b"], [], ["1", "x"], [], []]


def test_redaction(spark):
    texts = [
        "see http://localhost:8080/x?y and https://10.1.2.3/z) or 192.168.0.7, not 8.8.8.8",
        "C:\\Users\\me\\file and ```code here``` end",
        "before\n  select * from t where a = 1",
        "the query: SELECT 1",
        None,
        "word " * 100,
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = redact.redacted(frame, "t", limit=20).collect()
    assert got[0].redacted == "see [local-url] and [local-url]) or [local-ip], not 8.8.8.8"
    assert (got[0].local_urls, got[0].local_ips) == (2, 1)
    assert got[1].redacted == "[user-dir]\\file and end"
    assert got[2].redacted == "before SQL omitted."
    assert got[3].redacted == "the query omitted."
    assert got[4].redacted == ""
    assert got[5].redacted == ("word " * 100).strip()
    assert got[5].preview == "word word word word..."
