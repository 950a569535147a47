"""Run counters, run records and the latest run per sync."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.operators.changes import CHANGE, DELETE, INSERT, UPDATE

RUN_SCHEMA = (
    "run_id string, sync_id string, status string, created_at timestamp, scheduled_at timestamp, "
    "started_at timestamp, completed_at timestamp, full_sync boolean, source_record_count bigint, "
    "records_updates bigint, records_deletes bigint, records_invalid bigint, records_processed bigint, "
    "records_succeeded bigint, records_updated bigint, records_failed bigint, error_message string, "
    "object string, writes string, seq bigint, high_water_mark string, state boolean"
)


OPEN = "started"  # the status of a run that has begun and not ended


def folded(events: DataFrame) -> DataFrame:
    """One row per attempt of a run, from the rows its start and its end wrote: the last one written.

    An attempt is known by sync, run and sequence number. Rows combine map-side; an attempt has two of them.
    """
    row = F.struct((F.col("status") != OPEN).alias("ended"), F.struct(*events.columns).alias("r"))
    # writes without a sync are told apart by their object; a sync's row gets one when it ends
    keyed = events.select("sync_id", "run_id", "seq", F.when(F.col("sync_id").isNull(), F.col("object")).alias("of"), row.alias("e"))
    return keyed.groupBy("sync_id", "run_id", "seq", "of").agg(F.max("e").alias("e")).select("e.r.*")


def counts_of(column: str, *labels: str) -> list[Column]:
    """One sum per label, usable in an aggregate or in an observation of a write."""
    return [F.sum(F.when(F.col(column) == label, 1).otherwise(0)).alias(label) for label in labels]


def counters_from(inserts: int, updates: int, deletes: int, invalid: int, source: int) -> dict[str, int]:
    """The seven record-type counters, and the records that arrived."""
    sent = inserts + updates + deletes
    return {
        "source_record_count": source,
        "records_updates": updates,
        "records_deletes": deletes,
        "records_invalid": invalid,
        "records_processed": sent + invalid,
        "records_succeeded": sent,
        "records_updated": updates,
        "records_failed": invalid,
    }


def run_counters(changes: DataFrame, rejected: DataFrame) -> DataFrame:
    """The counters as one row, from planned changes and rejected records.

    Both inputs shrink to one row of partial sums per task before anything is shuffled.
    """
    c = changes.agg(*counts_of(CHANGE, INSERT, UPDATE, DELETE, "unchanged"))
    r = rejected.agg(F.count(F.lit(1)).alias("invalid"))
    names = [INSERT, UPDATE, DELETE, "unchanged", "invalid"]
    parts = c.withColumn("invalid", F.lit(0)).select(*names).unionByName(
        r.select(*[F.lit(0).alias(n) for n in names[:-1]], "invalid")
    )
    t = parts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    sent = F.col(INSERT) + F.col(UPDATE) + F.col(DELETE)
    return t.select(
        (F.col(INSERT) + F.col(UPDATE) + F.col("unchanged") + F.col("invalid")).alias("source_record_count"),
        F.col(UPDATE).alias("records_updates"),
        F.col(DELETE).alias("records_deletes"),
        F.col("invalid").alias("records_invalid"),
        (sent + F.col("invalid")).alias("records_processed"),
        F.col(UPDATE).alias("records_updated"),
        F.col("invalid").alias("records_failed"),
    )


def latest_runs(runs: DataFrame, order: Sequence[str] = ("started_at", "run_id")) -> DataFrame:
    """``last_run_at``, ``last_run_id`` and ``status`` per sync; the maximum is taken map-side first."""
    last = F.max(F.struct(*order, "status", *[c for c in ("run_id", "started_at") if c not in order])).alias("r")
    return runs.groupBy("sync_id").agg(last).select(
        "sync_id",
        F.col("r.started_at").alias("last_run_at"),
        F.col("r.run_id").alias("last_run_id"),
        F.col("r.status").alias("status"),
    )
