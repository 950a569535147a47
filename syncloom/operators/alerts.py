"""Alert rules as boolean columns over the run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.operators.runs import OPEN
from syncloom.plans.spec import AlertSpec

ORDER = ("started_at", "run_id")
SECONDS = {"minutes": 60, "hours": 3600}


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def _before(value: Column) -> Column:
    """The last non-null value among the earlier runs of the same sync. Runs of one sync do not overlap, so time bounds
    their number; all look-backs share one exchange by sync."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy("sync_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1))


def _runtime(start: Column, end: Column, alert: AlertSpec) -> Column:
    return (_micros(end) - _micros(start)) / F.lit(SECONDS[alert.unit] * 1_000_000.0) > F.lit(alert.threshold)


def violations(runs: DataFrame, alert: AlertSpec, now: datetime | None = None) -> DataFrame:
    """The runs with a ``fire`` column: does this run violate the rule? Never null.

    An open run has lasted until ``now`` (by default the time of the query) and can be late; no other rule can be
    decided before it ends. It is listed if it fires, so that it neither ends a streak nor counts as a recovery.
    """
    kind = alert.type.removesuffix("AlertConfiguration")
    open_ = F.col("status") == OPEN
    if kind == "RecordCountDeviation":
        # expected = the count of the previous completed run
        count = F.col(alert.record_type).cast("double")
        done = F.when(F.col("status") == "completed", count)
        runs = runs.withColumn("__expected", _before(done))
        expected = F.col("__expected")
        apart = F.abs(count - expected)
        rule = F.when(expected == 0, count > 0).otherwise(apart * 100 > expected * F.lit(alert.threshold))
    elif kind == "Failure":
        rule = F.col("status") == "failed"
    elif kind == "InvalidRecordPercent":
        share = F.col("records_failed") * F.lit(100.0)
        rule = (F.col("records_processed") > 0) & (share > F.col("records_processed") * F.lit(alert.threshold))
    elif kind == "FullSyncTrigger":
        rule = F.col("full_sync")
    elif kind == "Runtime":
        start = F.col("started_at") if alert.start_type == "actual" else F.col("scheduled_at")
        until = F.current_timestamp() if now is None else F.lit(now)
        rule = _runtime(start, F.when(open_, until).otherwise(F.col("completed_at")), alert)
    else:
        # every recorded run has started; only some complete
        rule = F.lit(True) if alert.status_name == "started" else F.col("status") == alert.status_name
    decided = kind in ("Runtime", "Status")
    fire = F.coalesce(rule, F.lit(False)) & (F.lit(decided) | ~open_)
    return runs.withColumn("fire", fire).filter(~open_ | F.col("fire")).drop("__expected")


def evaluate(runs: DataFrame, alert: AlertSpec, now: datetime | None = None) -> DataFrame:
    """Runs with ``fire`` (violated), ``send`` (notify now) and ``recovery`` (notify that it is over).

    ``first_time`` sends on the first violation of each streak; a recovery is the first run after a streak. Alerts that
    need no look-back stay narrow: no shuffle.
    """
    fired = violations(runs, alert, now)
    every = alert.send_for == "every_time"
    # full syncs and status changes are events, not conditions that resolve
    event = alert.type.startswith(("FullSyncTrigger", "Status"))
    recovers = alert.should_send_recovery and not event
    if (every or event) and not recovers:
        return fired.withColumn("send", F.col("fire")).withColumn("recovery", F.lit(False))
    before = fired.withColumn("__before", _before(F.col("fire")))
    was = F.coalesce(F.col("__before"), F.lit(False))
    send = F.col("fire") if every or event else F.col("fire") & ~was
    recovery = ~F.col("fire") & was if recovers else F.lit(False)
    return before.withColumn("send", send).withColumn("recovery", recovery).drop("__before")


def status_events(runs: DataFrame) -> DataFrame:
    """One row per status change: every run started, completed runs completed. Narrow."""
    done = F.col("status") == "completed"
    events = F.array(
        F.struct(F.lit("started").alias("status_name"), F.col("started_at").alias("at")),
        F.struct(F.when(done, F.lit("completed")).alias("status_name"), F.col("completed_at").alias("at")),
    )
    return (
        runs.select("sync_id", "run_id", F.explode(events).alias("e"))
        .select("sync_id", "run_id", "e.status_name", "e.at")
        .filter(F.col("status_name").isNotNull())
    )


def notifications(runs: DataFrame, alerts: list[AlertSpec], now: datetime | None = None) -> DataFrame:
    """All notifications of several alerts: sync, run, alert type, violation or recovery."""
    parts = []
    for a in alerts:
        e = evaluate(runs, a, now).filter("send or recovery")
        kind = F.when(F.col("send"), F.lit("violation")).otherwise(F.lit("recovery"))
        parts.append(e.select("sync_id", "run_id", "started_at", F.lit(a.type).alias("alert"), kind.alias("kind")))
    none = runs.limit(0).select("sync_id", "run_id", "started_at", F.lit("").alias("alert"), F.lit("").alias("kind"))
    out = parts[0] if parts else none
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
