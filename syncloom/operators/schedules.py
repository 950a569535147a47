"""Expected runs of a schedule, checked against the runs that took place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.plans.spec import WEEKDAYS, ScheduleSpec

# Minutes between two slots of each frequency.
STEP_MINUTES = {"quarter_hourly": 15, "hourly": 60, "daily": 24 * 60, "weekly": 7 * 24 * 60}


def _offset_minutes(schedule: ScheduleSpec) -> int:
    """Minutes from the start of the frequency's unit to its slot. Weeks start on Monday; hour 24 is the next day's 0."""
    minutes = {"quarter_hourly": 0, "hourly": schedule.minute}.get(
        schedule.frequency, schedule.hour * 60 + schedule.minute
    )
    if schedule.frequency == "weekly":
        minutes += (WEEKDAYS.index(schedule.day) - 1) % 7 * 24 * 60
    return minutes % STEP_MINUTES[schedule.frequency]


def slot_of(at: Column, schedule: ScheduleSpec) -> Column:
    """The slot a time belongs to: the latest one not after it. Microsecond arithmetic, no per-row branching."""
    step = STEP_MINUTES[schedule.frequency] * 60_000_000
    # 1970-01-05, four days after the epoch, was a Monday
    offset = _offset_minutes(schedule) * 60_000_000 + (4 * 24 * 3_600_000_000 if schedule.frequency == "weekly" else 0)
    micros = F.unix_micros(at.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros - F.lit(offset), F.lit(step)))


def expected_runs(syncs: DataFrame, schedule: ScheduleSpec, lo: str, hi: str) -> DataFrame:
    """``(sync_id, slot)`` for every slot in [lo, hi) of every sync; ``lo`` and ``hi`` name timestamp columns.

    ``never`` has none. ``continuous`` and cron expressions have no fixed grid and are refused.
    """
    if schedule.frequency == "never":
        return syncs.select("sync_id", F.col(lo).cast("timestamp").alias("slot")).filter(F.lit(False))
    if schedule.frequency not in STEP_MINUTES:
        raise ValueError(f"{schedule.frequency} has no grid of expected runs")
    step = F.expr(f"interval {STEP_MINUTES[schedule.frequency]} minutes")
    start = F.col(lo).cast("timestamp")
    first = slot_of(start, schedule)
    first = F.when(first < start, first + step).otherwise(first)
    end = F.col(hi).cast("timestamp")
    last = slot_of(F.timestamp_micros(F.unix_micros(end) - 1), schedule)
    slots = F.when(first <= last, F.sequence(first, last, step))
    return syncs.select("sync_id", F.explode(slots).alias("slot"))


def runs_by_slot(runs: DataFrame, schedule: ScheduleSpec) -> DataFrame:
    """First start per sync and slot, with its delay. Runs of one slot are combined map-side."""
    slot = slot_of(F.col("started_at"), schedule)
    first = runs.groupBy("sync_id", slot.alias("slot")).agg(F.min(F.col("started_at").cast("timestamp")).alias("started_at"))
    delay = (F.unix_micros("started_at") - F.unix_micros("slot")) / F.lit(1_000_000.0)
    return first.withColumn("delay_seconds", delay)


def scheduled_vs_actual(expected: DataFrame, runs: DataFrame, schedule: ScheduleSpec) -> DataFrame:
    """Every expected slot with the start and delay of its run, null where the run was missed."""
    return expected.join(runs_by_slot(runs, schedule), ["sync_id", "slot"], "left")


def missed_runs(expected: DataFrame, runs: DataFrame, schedule: ScheduleSpec) -> DataFrame:
    """Expected slots without a run."""
    return expected.join(runs_by_slot(runs, schedule).select("sync_id", "slot"), ["sync_id", "slot"], "left_anti")
