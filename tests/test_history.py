"""Alert rules and schedules on small histories."""

from datetime import datetime, timedelta

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from syncloom.operators.alerts import evaluate, notifications
from syncloom.operators.schedules import expected_runs, missed_runs, scheduled_vs_actual, slot_of
from syncloom.plans.spec import AlertSpec, ScheduleSpec

T0 = datetime(2024, 1, 1, 8)
SCHEMA = ("sync_id string, run_id string, started_at timestamp, completed_at timestamp, scheduled_at timestamp, "
          "status string, records_processed bigint, records_failed bigint, full_sync boolean")


def history(spark, *runs, step=timedelta(hours=7)):
    """Runs of one sync, as (status, processed, failed), seven hours apart."""
    data = []
    for i, (status, processed, failed) in enumerate(runs):
        at = T0 + i * step
        data.append(("s", f"r{i}", at, at + timedelta(minutes=10 * i), at - timedelta(minutes=5), status, processed, failed, i == 1))
    return table(spark, SCHEMA, *data)


def flags(df):
    got = {r.run_id: "".join(c for c, on in zip("FSR", (r.fire, r.send, r.recovery)) if on) for r in df.collect()}
    return [got[f"r{i}"] for i in range(len(got))]


RUNS = [("failed", 0, 0), ("failed", 10, 1), ("completed", 100, 60), ("completed", 100, 50), ("failed", 5, 5),
        ("completed", 130, 0)]


@pytest.mark.parametrize("config, want", [
    ({"type": "FailureAlertConfiguration"}, ["FS", "F", "R", "", "FS", "R"]),
    ({"type": "FailureAlertConfiguration", "send_for": "every_time"}, ["FS", "FS", "R", "", "FS", "R"]),
    ({"type": "FailureAlertConfiguration", "should_send_recovery": False}, ["FS", "F", "", "", "FS", ""]),
    ({"type": "InvalidRecordPercentAlertConfiguration", "options": {"threshold": "50"}}, ["", "", "FS", "R", "FS", "R"]),
    ({"type": "RecordCountDeviationAlertConfiguration",
      "options": {"threshold": "20", "record_type": "records_processed"}}, ["", "", "", "", "FS", "F"]),
    ({"type": "RuntimeAlertConfiguration", "options": {"threshold": "30", "unit": "minutes"}}, ["", "", "", "", "FS", "F"]),
    ({"type": "RuntimeAlertConfiguration", "options": {"threshold": "0.5", "unit": "hours", "start_type": "scheduled"}},
     ["", "", "", "FS", "F", "F"]),
    ({"type": "FullSyncTriggerAlertConfiguration"}, ["", "FS", "", "", "", ""]),
    ({"type": "StatusAlertConfiguration", "options": {"status_name": "completed"}}, ["", "", "FS", "FS", "", "FS"]),
    ({"type": "StatusAlertConfiguration", "options": {"status_name": "started"}}, ["FS"] * 6),
])
def test_rules(spark, config, want):
    assert flags(evaluate(history(spark, *RUNS), AlertSpec.from_config(config))) == want


def test_zero_expected(spark):
    alert = AlertSpec("RecordCountDeviationAlertConfiguration", threshold=10, record_type="records_processed")
    got = flags(evaluate(history(spark, ("completed", 0, 0), ("completed", 0, 0), ("completed", 5, 0)), alert))
    assert got == ["", "", "FS"]


def test_notifications(spark):
    alerts = [AlertSpec("FailureAlertConfiguration"), AlertSpec("FullSyncTriggerAlertConfiguration")]
    got = rows(notifications(history(spark, *RUNS), alerts), "run_id", "alert", "kind")
    assert [(r, k) for r, a, k in got if a.startswith("Failure")] == [
        ("r0", "violation"), ("r2", "recovery"), ("r4", "violation"), ("r5", "recovery")]
    assert [(r, k) for r, a, k in got if a.startswith("Full")] == [("r1", "violation")]


def grid(spark, schedule, lo, hi):
    syncs = table(spark, "sync_id string, lo timestamp, hi timestamp", ("s", lo, hi))
    return [r.slot for r in expected_runs(syncs, schedule, "lo", "hi").orderBy("slot").collect()]


def test_grids(spark):
    lo, hi = datetime(2024, 1, 1, 0, 7), datetime(2024, 1, 1, 1, 0)  # a Monday
    assert grid(spark, ScheduleSpec("quarter_hourly"), lo, hi) == [datetime(2024, 1, 1, 0, m) for m in (15, 30, 45)]
    assert grid(spark, ScheduleSpec("hourly", minute=35), lo, hi) == [datetime(2024, 1, 1, 0, 35)]
    assert grid(spark, ScheduleSpec("hourly", minute=7), lo, hi) == [lo]
    assert grid(spark, ScheduleSpec("hourly", minute=5), lo, hi) == []
    assert grid(spark, ScheduleSpec("never"), lo, hi) == []
    assert grid(spark, ScheduleSpec("daily", hour=24), lo, datetime(2024, 1, 3, 0, 1)) == [
        datetime(2024, 1, 2), datetime(2024, 1, 3)]
    assert grid(spark, ScheduleSpec("weekly", day="Sunday", hour=8), lo, datetime(2024, 1, 22)) == [
        datetime(2024, 1, 7, 8), datetime(2024, 1, 14, 8), datetime(2024, 1, 21, 8)]
    with pytest.raises(ValueError):
        grid(spark, ScheduleSpec("continuous"), lo, hi)


def test_slots_and_missed_runs(spark):
    schedule = ScheduleSpec("weekly", day="Sunday", hour=24, minute=30)  # Monday 00:30
    at = spark.sql("select timestamp '2024-01-01 00:29:59' as a, timestamp '2024-01-01 00:30:00' as b")
    assert tuple(at.select(slot_of(F.col("a"), schedule), slot_of(F.col("b"), schedule)).first()) == (
        datetime(2023, 12, 25, 0, 30), datetime(2024, 1, 1, 0, 30))
    hourly = ScheduleSpec("hourly")
    syncs = table(spark, "sync_id string, lo timestamp, hi timestamp", ("s", T0, T0 + timedelta(hours=3)))
    due = expected_runs(syncs, hourly, "lo", "hi")
    started = table(spark, "sync_id string, started_at timestamp", ("s", T0 + timedelta(minutes=2)),
                    ("s", T0 + timedelta(minutes=40)), ("s", T0 + timedelta(hours=2)), ("t", T0 + timedelta(hours=1)))
    assert rows(missed_runs(due, started, hourly), "slot") == [(T0 + timedelta(hours=1),)]
    delays = {r.slot.hour: r.delay_seconds for r in scheduled_vs_actual(due, started, hourly).collect()}
    assert delays == {8: 120.0, 9: None, 10: 0.0}
