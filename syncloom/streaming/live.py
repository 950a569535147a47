"""Live syncs: keyed records folded into an object per micro-batch, or events appended once each."""

from __future__ import annotations

from collections.abc import Mapping as Dict, Sequence
from dataclasses import dataclass, field as dc_field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from syncloom.functions.columns import quoted
from syncloom.operators.changes import CHANGE, UPSERT
from syncloom.operators.fields import validate_fields
from syncloom.operators.keys import NULL_KEY, REASON, VALUE, latest_by_key
from syncloom.operators.mapping import LookupObject, project
from syncloom.operators.policies import policies_of
from syncloom.operators.runs import counters_from
from syncloom.plans.spec import Field, SegmentSpec, SpecError, SyncSpec
from syncloom.session import exists, scratch_path, stored
from syncloom.sinks.objects import ORDER, ObjectStore
from syncloom.sources.readers import UNDECODABLE

EVENT, EVENT_DAY, RUN = "_event", "_event_day", "_run"
LATEST = "sql.streaming.queryId"  # the local property that names the stream a micro-batch belongs to


@dataclass
class Context:
    """What a live sync's mappings may refer to besides the record itself."""

    segments: Sequence[SegmentSpec] = ()
    lookups: Dict[str, LookupObject] | None = None
    fields: Sequence[Field] = ()

    def check(self, spec: SyncSpec) -> None:
        """Definitions that a live sync cannot honour are refused before it starts."""
        for m in spec.mappings:
            if m.type == "segment_membership" and not self.segments:
                raise SpecError("segment membership needs segments")
            if m.lookup_object and m.lookup_object not in (self.lookups or {}):
                raise SpecError(f"unknown lookup object {m.lookup_object!r}")


@dataclass(frozen=True)
class Counts:
    n: int
    bad: int


@dataclass
class LiveRuns:
    """Micro-batches as committed runs of a sync, named by stream and batch: a new checkpoint is a new stream.

    Only the first batch after a start can be a replay, so only that one looks for its own commit.
    """

    spec: SyncSpec
    store: ObjectStore
    context: Context
    _seq: int | None = None

    def run_id(self, batch: DataFrame, batch_id: int) -> str:
        query = batch.sparkSession.sparkContext.getLocalProperty(LATEST) or "direct"
        return f"{self.spec.name}-{query}-{batch_id:012d}"

    def committed(self, run_id: str) -> bool:
        if self._seq is None:
            done, _, following = self.store.standing(self.spec.name, run_id)
            self._seq = following - 1
            if done:
                return True
        self._seq += 1
        return False

    def staged(self, batch: DataFrame, run_id: str, extra: Dict[str, Column], key: str) -> tuple[DataFrame, Counts, DataFrame]:
        """The valid records, the counts of all, and what is held for the batch's passes; rejects are written.

        Mapped and checked records are kept where they were made; a lost executor's are made again from the source.
        """
        spec, store = self.spec, self.store
        if UNDECODABLE in batch.columns:
            extra = {**extra, UNDECODABLE: F.col(UNDECODABLE)}
        mapped = project(batch, spec, run_id, self.context.segments, self.context.lookups, keep_rejects=True, extra=extra)
        mapped = validate_fields(mapped, self.context.fields)
        mapped = mapped.withColumn(REASON, F.when(quoted(key).isNull(), F.lit(NULL_KEY)).otherwise(F.col(REASON)))
        if UNDECODABLE in extra:
            lost = F.col(UNDECODABLE).isNotNull()
            mapped = mapped.withColumn(REASON, F.when(lost, F.lit("undecodable")).otherwise(F.col(REASON)))
            mapped = mapped.withColumn(VALUE, F.coalesce(UNDECODABLE, VALUE)).drop(UNDECODABLE)
        held = mapped.persist()
        bad = F.coalesce(F.sum(F.when(F.col(REASON).isNotNull(), 1).otherwise(0)), F.lit(0))
        counts = held.agg(F.count(F.lit(1)), bad).first()
        store.write_rejected(spec.name, run_id, held.filter(F.col(REASON).isNotNull()).drop(*extra))
        return held.filter(F.col(REASON).isNull()).drop(REASON, VALUE), Counts(*counts), held

    def commit(self, run_id: str, started: datetime, writes: str, sent: tuple[int, int], counts: Counts) -> None:
        self.store.record(run_id=run_id, sync_id=self.spec.name, status="completed", created_at=started, started_at=started,
                          completed_at=datetime.now(timezone.utc), full_sync=False, object=self.spec.object, writes=writes,
                          seq=self._seq, **counters_from(*sent, 0, counts.bad, counts.n))


@dataclass
class Folder:
    """Folds micro-batches into an object.

    A batch writes one row per changed key and reads neither the object nor the history: its cost follows the batch.
    """

    spec: SyncSpec
    store: ObjectStore
    order: Sequence[str]
    compact_after: int = 100
    context: Context = dc_field(default_factory=Context)

    def __post_init__(self) -> None:
        self.context.check(self.spec)
        self.runs = LiveRuns(self.spec, self.store, self.context)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spec, store, started = self.spec, self.store, datetime.now(timezone.utc)
        run_id = self.runs.run_id(batch, batch_id)
        if self.runs.committed(run_id):
            return
        extra = {f"{ORDER}{i}": quoted(c) for i, c in enumerate(self.order)}
        valid, counts, held = self.runs.staged(batch, run_id, extra, spec.keys[0])
        written = Observation()
        last = latest_by_key(valid, spec.keys, list(extra), policies_of(spec.mappings))
        out = last.withColumn(CHANGE, F.lit(UPSERT)).observe(written, F.count(F.lit(1)).alias("n"))
        store.write(spec.object, spec.name, run_id, out, self.runs._seq)
        self.runs.commit(run_id, started, "changes", (0, written.get["n"]), counts)
        held.unpersist()
        if (batch_id + 1) % self.compact_after == 0:
            store.compact(spec.object, spec.keys, f"{run_id}-base", datetime.now(timezone.utc), self.runs._seq, policies_of(spec.mappings))


def live_map_records(
    stream: DataFrame, spec: SyncSpec, store: ObjectStore, order: Sequence[str], checkpoint: str,
    interval: str | None = None, compact_after: int = 100, context: Context | None = None,
) -> StreamingQuery:
    """Keep the object at the last record per key by ``order`` (event time, then offset), however late records arrive.

    ``interval`` runs continuously; without it the available data is processed once.
    """
    writer = stream.writeStream.foreachBatch(Folder(spec, store, order, compact_after, context or Context()))
    return _start(writer.option("checkpointLocation", checkpoint), interval)


@dataclass
class Appender:
    """Appends every event once, however late it or its copies arrive.

    An event is known by its id and the day of its time. The ids of a day are a partition of a table beside the object, so a
    batch reads the ids of the days it touches, and no history. Copies collapse map-side before the ids meet. Ids carry the run that wrote
    them, before its commit: the runs that never committed are found once, when a stream starts, and their ids do not count.
    """

    spec: SyncSpec
    store: ObjectStore
    event_id: str
    event_time: str
    context: Context = dc_field(default_factory=Context)
    _lost: list[str] | None = None
    _days: set[str] = dc_field(default_factory=set)

    def __post_init__(self) -> None:
        self.context.check(self.spec)
        self.runs = LiveRuns(self.spec, self.store, self.context)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spec, store, started = self.spec, self.store, datetime.now(timezone.utc)
        run_id = self.runs.run_id(batch, batch_id)
        if self.runs.committed(run_id):
            return
        day = F.coalesce(F.to_date(quoted(self.event_time)).cast("string"), F.lit("none"))
        extra = {EVENT: quoted(self.event_id), EVENT_DAY: day}
        valid, counts, held = self.runs.staged(batch, run_id, extra, EVENT)
        rest = [c for c in valid.columns if c not in extra]
        row = F.any_value(F.struct(*[quoted(c).alias(c) for c in rest])).alias("r")
        once = valid.groupBy(*extra).agg(row)
        sent = self._sent(valid, run_id)
        once = (once if sent is None else once.join(sent, list(extra), "left_anti")).persist()
        ids = once.select(*extra, F.lit(run_id).alias(RUN)).hint("rebalance", EVENT_DAY)
        ids.write.mode("append").partitionBy(EVENT_DAY).parquet(event_ids(store, spec.name))
        written = Observation()
        out = once.select(*[F.col("r").getField(c).alias(c) for c in rest]).observe(written, F.count(F.lit(1)).alias("n"))
        store.write(spec.object, spec.name, run_id, out)
        self.runs.commit(run_id, started, "append", (written.get["n"], 0), counts)
        once.unpersist()
        held.unpersist()

    def _sent(self, valid: DataFrame, run_id: str) -> DataFrame | None:
        """The ids that committed runs have sent for the days of these events."""
        spark, ids = valid.sparkSession, event_ids(self.store, self.spec.name)
        schema = f"{EVENT} {valid.schema[EVENT].dataType.simpleString()}, {RUN} string, {EVENT_DAY} string"
        reader = spark.read.option("basePath", ids).schema(schema)
        if self._lost is None:
            known = exists(spark, ids)
            runs = reader.parquet(ids).select(RUN).distinct() if known else None
            done = self.store.completed(self.spec.name).withColumnRenamed("run_id", RUN)
            self._lost = [r[0] for r in runs.join(done, RUN, "left_anti").toLocalIterator()] if known else []
        days = [r[0] for r in valid.select(EVENT_DAY).distinct().toLocalIterator()]
        past = [d for d in days if d in self._days or exists(spark, f"{ids}/{EVENT_DAY}={d}")]
        self._days.update(days)
        if not past:
            return None
        names = reader.parquet(*[f"{ids}/{EVENT_DAY}={d}" for d in past])
        return names.filter(~F.col(RUN).isin(*self._lost, run_id)).select(EVENT, EVENT_DAY)


def event_ids(store: ObjectStore, sync: str) -> str:
    return store.path("event_ids", sync, "table")


def tidy_event_ids(store: ObjectStore, sync: str, before: date) -> None:
    """Rewrite the ids of each earlier day in as few files as they fill. Not while the sync's stream runs."""
    table = store.spark.read.parquet(event_ids(store, sync))
    old = stored(table.filter(F.col(EVENT_DAY).cast("date") < F.lit(before)), scratch_path(store.spark, "event-ids"))
    writer = old.hint("rebalance", EVENT_DAY).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer.partitionBy(EVENT_DAY).parquet(event_ids(store, sync))


def live_activate_events(
    stream: DataFrame, spec: SyncSpec, store: ObjectStore, event_id: str, event_time: str, checkpoint: str,
    interval: str | None = None, context: Context | None = None,
) -> StreamingQuery:
    """Append every event once to the object, mapped to the destination's fields; events that do not fit are kept as rejects.

    An event is known by its id **and** the UTC day of its time: copies that differ in the day are two events, which is what lets a batch
    look at the ids of few days.
    """
    writer = stream.writeStream.foreachBatch(Appender(spec, store, event_id, event_time, context or Context()))
    return _start(writer.option("checkpointLocation", checkpoint), interval)


def _start(writer, interval: str | None) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
