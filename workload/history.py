"""Queries over the run history: latest runs, alerts, schedules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from syncloom.operators.alerts import evaluate, status_events
from syncloom.operators.runs import folded, latest_runs
from syncloom.operators.schedules import expected_runs, missed_runs, scheduled_vs_actual
from syncloom.plans.spec import AlertSpec, ScheduleSpec
from workload.fixtures import fixture, over_tables, with_fixtures
from workload.registry import register


@register("run_latest", with_fixtures("runs", """
    select sync_id, cast(started_at as varchar) as last_run_at, run_id as last_run_id, status
    from (select *, row_number() over (partition by sync_id order by started_at desc, run_id desc) as rn from runs)
    where rn = 1"""))
def run_latest(spark, sf_dir):
    last = latest_runs(fixture(spark, sf_dir, "runs"))
    return last.withColumn("last_run_at", F.col("last_run_at").cast("string"))


def _alert(name: str, rule: str, shown: tuple[str, ...], history: str = "", **config):
    """Register an alert rule. ``rule`` is the violation in SQL over ``runs``; ``shown`` the columns compared."""
    every = config.get("send_for", "first_time") == "every_time"
    recovers = config.get("should_send_recovery", True)
    event = config["type"].startswith(("FullSync", "Status"))
    send = "fire" if every or event else "fire and not was"
    recovery = "not fire and was" if recovers and not event else "false"
    sql = with_fixtures("runs", f"""
        select run_id, sync_id, {', '.join(shown)} from (
            select *, {send} as send, {recovery} as recovery from (
                select *, coalesce(lag(fire) over (partition by sync_id order by started_at, run_id), false) as was
                from (select *, coalesce({rule}, false) as fire from (select * {history} from runs))))""")

    @register(name, sql)
    def run(spark, sf_dir):
        alert = AlertSpec.from_config({**config, "options": config.get("options", {})})
        return evaluate(fixture(spark, sf_dir, "runs"), alert).select("run_id", "sync_id", *shown)


def runtime(start: str, seconds: int) -> str:
    return f"epoch_us(completed_at) - epoch_us({start}) > {seconds} * 1000000::bigint"


FIRE, ALL = ("fire",), ("fire", "send", "recovery")
_alert("alert_failure", "status = 'failed'", FIRE, type="FailureAlertConfiguration")
_alert("alert_send_first", "status = 'failed'", ("fire", "send"), type="FailureAlertConfiguration",
       should_send_recovery=False)
_alert("alert_recovery", "status = 'failed'", ALL, type="FailureAlertConfiguration", send_for="every_time")
_alert("alert_invalid_percent", "records_processed > 0 and records_failed * 100.0 > records_processed * 20", ALL,
       type="InvalidRecordPercentAlertConfiguration", options={"threshold": "20"})
_alert("alert_full_sync", "full_sync", ALL, type="FullSyncTriggerAlertConfiguration")
_alert(
    "alert_count_deviation",
    """case when expected = 0 then records_processed > 0
            else abs(records_processed - expected) * 100.0 > expected * 60 end""",
    ALL,
    history=""", last_value(case when status = 'completed' then records_processed end ignore nulls) over
        (partition by sync_id order by started_at, run_id rows between unbounded preceding and 1 preceding) as expected""",
    type="RecordCountDeviationAlertConfiguration", options={"threshold": "60", "record_type": "records_processed"},
)
_alert("alert_runtime", runtime("started_at", 600 * 60), ALL, type="RuntimeAlertConfiguration",
       options={"threshold": "600", "unit": "minutes", "start_type": "actual"})
_alert("alert_runtime_scheduled", runtime("scheduled_at", 20 * 3600), ALL, type="RuntimeAlertConfiguration",
       options={"threshold": "20", "unit": "hours", "start_type": "scheduled"})


@register("alert_status", with_fixtures("runs", """
    select sync_id, run_id, 'started' as status_name, cast(started_at as varchar) as at from runs
    union all
    select sync_id, run_id, 'completed', cast(completed_at as varchar) from runs where status = 'completed'"""))
def alert_status(spark, sf_dir):
    events = status_events(fixture(spark, sf_dir, "runs"))
    return events.withColumn("at", F.col("at").cast("string"))


# ---- runs that have started and not ended: the last one of every third sync

EVENTS = """
    select sync_id, run_id, 'started' as status, scheduled_at, started_at, cast(null as timestamp) as completed_at,
           cast(null as bigint) as records_processed, cast(null as bigint) as records_failed, full_sync from runs
    union all
    select sync_id, run_id, status, scheduled_at, started_at, completed_at, records_processed, records_failed, full_sync from (
        select *, row_number() over (partition by sync_id order by started_at desc, run_id desc) as back from runs)
    where back > 1 or cast(substr(sync_id, 6) as int) % 3 <> 0"""
OPEN_RUNS = """
    select * from (select *, row_number() over (partition by sync_id, run_id order by case status when 'started' then 1 else 0 end) as nth
                   from run_events) where nth = 1"""
NOW = datetime(2025, 1, 1)


def open_runs(spark, sf_dir):
    """The run history of rows written at the start and at the end of runs."""
    fixture(spark, sf_dir, "runs").createOrReplaceTempView("runs")
    events = spark.sql(EVENTS)
    return folded(events.withColumn("seq", F.lit(1)).withColumn("object", F.lit("x")))


def _open_alert(name: str, rule: str, listed: str, event: bool, **config):
    """As ``_alert``, over runs of which some are open; ``listed`` says which open runs the rule can decide on."""
    send = "fire" if event else "fire and not was"
    recovery = "false" if event else "not fire and was"

    @register(name, with_fixtures("runs", f"""
        , run_events as ({EVENTS}), all_runs as ({OPEN_RUNS})
        select run_id, sync_id, status, fire, {send} as send, {recovery} as recovery from (
            select *, coalesce(lag(fire) over (partition by sync_id order by started_at, run_id), false) as was
            from (select *, coalesce({rule}, false) as fire from all_runs) where status <> 'started' or {listed})"""))
    def run(spark, sf_dir):
        alert = AlertSpec.from_config(config)
        return evaluate(open_runs(spark, sf_dir), alert, NOW).select("run_id", "sync_id", "status", "fire", "send", "recovery")


_open_alert("alert_runtime_open_run", "epoch_us(coalesce(completed_at, timestamp '2025-01-01')) - epoch_us(started_at) > 600 * 60 * 1000000::bigint",
            "fire", False, type="RuntimeAlertConfiguration", options={"threshold": "600", "unit": "minutes", "start_type": "actual"})
_open_alert("alert_failure_open_run", "status = 'failed'", "false", False, type="FailureAlertConfiguration", options={})
_open_alert("alert_status_rule", "status = 'completed'", "fire", True, type="StatusAlertConfiguration", options={"status_name": "completed"})
_open_alert("alert_status_started", "true", "fire", True, type="StatusAlertConfiguration", options={"status_name": "started"})


# ---- schedules: every sync is expected from its first to its last day of activity

SPANS = """
    select 'sync-' || cast(user_id as varchar(20)) as sync_id, cast(cast(min(ts) as date) as timestamp) as lo,
           cast(cast(max(ts) as date) as timestamp) as hi
    from events group by user_id"""
SCHEDULES = {
    "quarter_hourly": ScheduleSpec("quarter_hourly"),
    "hourly": ScheduleSpec("hourly", minute=10),
    "daily": ScheduleSpec("daily", hour=8, minute=30),
    "weekly": ScheduleSpec("weekly", day="Tuesday", hour=24, minute=5),  # Wednesday 00:05
    "never": ScheduleSpec("never"),
}


@register("sched_grid", f"""
    with spans as ({SPANS}),
    minutes as (select sync_id, hi, unnest(generate_series(lo, hi - interval 1 minute, interval 15 minute)) as t from spans),
    fives as (select sync_id, hi, unnest(generate_series(lo, hi - interval 1 minute, interval 5 minute)) as t from spans)
    select sync_id, 'quarter_hourly' as frequency, cast(t as varchar) as slot from minutes where t < hi
    union all select sync_id, 'hourly', cast(t as varchar) from fives where t < hi and minute(t) = 10
    union all select sync_id, 'daily', cast(t as varchar) from fives where t < hi and hour(t) = 8 and minute(t) = 30
    union all select sync_id, 'weekly', cast(t as varchar) from fives
              where t < hi and dayofweek(t) = 3 and hour(t) = 0 and minute(t) = 5""")
def sched_grid(spark, sf_dir):
    spans = over_tables(spark, sf_dir, SPANS)
    out = None
    for name, schedule in SCHEDULES.items():
        grid = expected_runs(spans, schedule, "lo", "hi").select(
            "sync_id", F.lit(name).alias("frequency"), F.col("slot").cast("string").alias("slot")
        )
        out = grid if out is None else out.unionByName(grid)
    return out


HOURLY = ScheduleSpec("hourly", minute=10)
DUE = """
    select sync_id, unnest(generate_series(lo + interval 10 minute, hi - interval 1 minute, interval 1 hour)) as slot
    from spans where lo < hi"""
STARTS = """
    select 'sync-' || cast(user_id as varchar(20)) as sync_id, ts as started_at from events"""
BY_SLOT = """
    select sync_id, time_bucket(interval 1 hour, started_at - interval 10 minute) + interval 10 minute as slot,
           min(started_at) as first_start from starts group by 1, 2"""


@register("sched_missed", f"""
    with spans as ({SPANS}), starts as ({STARTS}), due as ({DUE}), done as ({BY_SLOT})
    select due.sync_id, cast(due.slot as varchar) as slot from due
    left join done on due.sync_id = done.sync_id and due.slot = done.slot where done.sync_id is null""")
def sched_missed(spark, sf_dir):
    due = expected_runs(over_tables(spark, sf_dir, SPANS), HOURLY, "lo", "hi")
    missed = missed_runs(due, spark.sql(STARTS), HOURLY)
    return missed.select("sync_id", F.col("slot").cast("string").alias("slot"))


@register("sched_delay", f"""
    with spans as ({SPANS}), starts as ({STARTS}), due as ({DUE}), done as ({BY_SLOT})
    select due.sync_id, cast(due.slot as varchar) as slot,
           (epoch_us(first_start) - epoch_us(due.slot)) / 1000000::double as delay_seconds
    from due join done on due.sync_id = done.sync_id and due.slot = done.slot""")
def sched_delay(spark, sf_dir):
    due = expected_runs(over_tables(spark, sf_dir, SPANS), HOURLY, "lo", "hi")
    pairs = scheduled_vs_actual(due, spark.sql(STARTS), HOURLY).filter("started_at is not null")
    return pairs.select("sync_id", F.col("slot").cast("string").alias("slot"), "delay_seconds")
