from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventgauge import Settings, TimeRange, Windows, parse_lookback, parse_range
from eventgauge.functions.windows import parse_reference
from eventgauge.plans.quality_run import windows_of


@pytest.mark.parametrize(
    ("spec", "amount", "unit"),
    [
        ("7 days", 7, "day"), ("7d", 7, "day"), ("last 7 days", 7, "day"), (7, 7, "day"),
        ("3", 3, "day"), ("1 hour", 1, "hour"), ("2h", 2, "hour"), ("2 HOURS", 2, "hour"),
        ({"days_back": 4}, 4, "day"), ({"default_days_back": 5}, 5, "day"),
        ({"hours_back": 6, "days_back": 1}, 6, "hour"), ({}, 7, "day"), (None, 7, "day"),
    ],
)
def test_rolling_forms(spec, amount, unit):
    found = parse_range(spec)
    assert (found.amount, found.unit, found.is_fixed) == (amount, unit, False)


@pytest.mark.parametrize(
    "spec",
    [
        "2026-02-01 to 2026-02-03", "2026-02-01..2026-02-03", "2026-02-01 .. 2026-02-03",
        {"start_date": "2026-02-01", "end_date": "2026-02-03"},
        {"from_date": "2026-02-01", "to_date": "2026-02-03"},
    ],
)
def test_fixed_forms_are_inclusive(spec):
    found = parse_range(spec)
    assert (found.start, found.end) == (date(2026, 2, 1), date(2026, 2, 3))
    assert (found.days_back, found.seconds) == (3, 3 * 86400)
    low, high = Windows.of(spec, "30 days", "2026-03-01").measurement_bounds
    assert (low, high) == (datetime(2026, 2, 1), datetime(2026, 2, 4))


@pytest.mark.parametrize(
    "spec",
    [
        "next week", "0 days", 0, -3, True, False, "", "2026-05-05 to 2026-02-01",
        "2026-02-30 to 2026-03-01", {"start_date": "2026-02-01"}, {"to_date": "2026-02-01"},
        {"hours_back": 0}, {"days_back": -1},
    ],
)
def test_rejected_forms(spec):
    with pytest.raises(ValueError):
        parse_range(spec)


def test_lookback_is_rolling_and_longer():
    assert parse_lookback(None).description == "last 30 days"
    assert parse_lookback("12h").description == "last 12 hours"
    with pytest.raises(ValueError):
        parse_lookback("2026-02-01 to 2026-02-03")
    with pytest.raises(ValueError):
        Windows.of("7 days", "7 days", "2026-01-01")
    assert Windows.of("2026-02-01 to 2026-02-03", "1 day", "2026-03-01")


def test_reference_keeps_the_absolute_instant():
    assert parse_reference("2026-08-06T17:08:46+04:00") == datetime(2026, 8, 6, 13, 8, 46)
    assert parse_reference("2026-08-06T17:08:46Z") == datetime(2026, 8, 6, 17, 8, 46)
    assert parse_reference("2026-07-17 12:30:00") == datetime(2026, 7, 17, 12, 30)
    with pytest.raises(ValueError):
        parse_reference("yesterday")


def test_bounds_and_comparison_windows():
    hours = Windows.of("1 hour", "30 days", "2026-07-17 12:30:00")
    assert hours.measurement_bounds == (
        datetime(2026, 7, 17, 11, 30), datetime(2026, 7, 17, 12, 30),
    )
    assert hours.lookback_bounds[0] == datetime(2026, 7, 17, 11, 30) - timedelta(days=30)
    assert hours.is_aligned and hours.comparison_windows == 30.0
    days = Windows.of("7 days", "30 days", "2026-07-17")
    assert not days.is_aligned and days.comparison_windows == 30 / 7
    assert not Windows.of("24 hours", "30 days", "2026-07-17").is_aligned
    assert not Windows.of("2 hours", "48 hours", "2026-07-17").is_aligned
    assert Windows.of("2 hours", "48 hours", "2026-07-17").comparison_windows == 24.0


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("reference", ["2024-01-30 18:00:00", "2024-01-30 00:30:00"])
def test_predicates_against_python(spark, kind, reference):
    windows = Windows.of("2 hours", "3 days", reference)
    moments = [datetime(2024, 1, 26) + timedelta(minutes=30 * i, seconds=i % 60) for i in range(240)]
    frame = spark.createDataFrame(
        [(m.strftime("%Y-%m-%d %H:%M:%S"),) for m in moments], "text string"
    ).select("text", F.col("text").cast(kind).alias("t"))
    got = frame.select(
        "text",
        windows.in_measurement(frame, "t").alias("m"),
        windows.in_lookback(frame, "t").alias("l"),
        windows.in_scope(frame, "t").alias("s"),
    ).collect()
    now = windows.reference
    for row in got:
        moment = datetime.strptime(row.text, "%Y-%m-%d %H:%M:%S")
        start = now - timedelta(hours=2)
        # The slot of the previous days that ends at the reference's time of day.
        slots = [(start - timedelta(days=k), now - timedelta(days=k)) for k in range(0, 5)]
        in_slot = any(a <= moment < b for a, b in slots)
        assert row.m == (start <= moment < now)
        assert row.l == (start - timedelta(days=3) <= moment < start and in_slot)
        assert row.s == (start - timedelta(days=3) <= moment < now)


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int)) as event_date", "id"
    ).write.parquet(path)
    frame = spark.read.parquet(path)
    windows = Windows.of("7 days", "14 days", "2024-02-01")
    plan = frame.filter(windows.in_measurement(frame, "event_date"))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "GreaterThanOrEqual(event_date" in text and "LessThan(event_date" in text


def test_settings_supply_the_window():
    windows = windows_of(Settings({"date_range": "1 day", "lookback": "30 days"}), "2026-01-02")
    assert windows.measured == TimeRange(1, "day")
    assert windows_of(Settings(), "2026-01-02").measured.amount == 7
