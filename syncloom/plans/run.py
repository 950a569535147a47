"""One run of a sync: read, map, validate, find the changes, write them, record the run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping as Dict, Sequence
from dataclasses import dataclass, field as dc_field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from syncloom.functions.columns import quoted
from syncloom.operators import changes as ch
from syncloom.operators.alerts import notifications
from syncloom.operators.fields import validate_fields
from syncloom.operators.keys import REASON, VALUE, split_by_key
from syncloom.operators.mapping import LookupObject, project, with_membership
from syncloom.operators.policies import policies_of
from syncloom.operators.runs import counters_from, counts_of
from syncloom.operators.schedules import expected_runs, missed_runs
from syncloom.plans.spec import Field, SegmentSpec, SpecError, SyncSpec
from syncloom.session import discard, rereadable, stored
from syncloom.sinks.files import export_file
from syncloom.sinks.objects import ObjectStore, utc
from syncloom.sources.readers import Catalog, live_order
from syncloom.streaming.live import Context, live_activate_events, live_map_records

MARK = "__mark"
CONTINUOUS = "10 seconds"  # between two micro-batches of a continuous sync
log = logging.getLogger(__name__)


def mark_text(value: Column, kind: T.DataType) -> Column:
    """A mark as text that no session's time zone changes: instants as microseconds since the epoch."""
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def mark_value(text: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    return F.lit(text).cast(kind)


@dataclass(frozen=True)
class Members:
    """A table of (record key, segment) rows."""

    table: DataFrame
    key: str
    segment: str


@dataclass(frozen=True)
class RunResult:
    run_id: str
    status: str
    counters: dict[str, int]
    high_water_mark: str | None


@dataclass
class SyncRunner:
    """Runs syncs against one root, with the saved definitions they refer to.

    ``clock`` tells the completion time. After ``compact_after`` change sets an object gets a new base.
    """

    spark: SparkSession
    root: str
    catalog: Catalog
    lookups: Dict[str, LookupObject] | None = None
    segments: Sequence[SegmentSpec] = ()
    members: Members | None = None
    fields: Sequence[Field] = ()
    unions: Dict[str, tuple[str, str]] = dc_field(default_factory=dict)  # object name -> the two objects it unites
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)
    compact_after: int = 24

    def __post_init__(self) -> None:
        self.store = ObjectStore(self.spark, self.root)

    def run(
        self, spec: SyncSpec, run_id: str, now: datetime, force_full: bool = False, scheduled_at: datetime | None = None
    ) -> RunResult:
        """Run once. A run id that is already committed is not run again; a failed one may be repeated."""
        done, prior, seq = self.store.standing(spec.name, run_id)
        if done:
            names = counters_from(0, 0, 0, 0, 0)
            return RunResult(run_id, "completed", {n: done[n] for n in names}, done.high_water_mark)
        row = dict(run_id=run_id, sync_id=spec.name, created_at=now, started_at=now, scheduled_at=scheduled_at,
                   full_sync=force_full, seq=seq)
        self.store.record(**row, status="started")
        try:
            this = _Run(self, spec, run_id, now, force_full, seq, prior)
            counters, mark, writes = this.execute()
        except Exception as error:
            self.store.record(**row, status="failed", completed_at=self.clock(), error_message=str(error))
            raise
        ended = dict(sync_id=spec.name, status="completed", started_at=now, completed_at=self.clock(), seq=seq)
        main = {**row, **counters, **ended, "high_water_mark": mark, "object": spec.object if writes else None, "writes": writes, "state": this.has_state}
        self.store.commit([*[{**ended, **part} for part in this.parts], main])
        try:
            this.tidy()
            self._compact_if_due(spec, run_id, now, seq)
        except Exception:  # the run is committed; what is left over is upkeep, and the next run tries again
            log.exception("upkeep after run %s of %s failed", run_id, spec.name)
        return RunResult(run_id, "completed", counters, mark)

    def start(
        self, spec: SyncSpec, checkpoint: str, order: Sequence[str] = (), event_id: str | None = None, event_time: str | None = None
    ) -> StreamingQuery:
        """Start a live sync: keyed records by ``order``, or events once each by id and time.

        Without an ``order`` it is the topic's own (``live_order``); a stream of records that has none is refused. It has the segments, lookups and field rules of the runner. Continuous schedules go on; others process what is there.
        """
        if spec.run_mode != "live":
            raise SpecError("only live syncs are started")
        stream, context = self.catalog.stream(self.spark, spec.source), Context(self.segments, self.lookups, self.fields)
        interval = CONTINUOUS if spec.schedule is not None and spec.schedule.frequency == "continuous" else None
        if spec.sync_behavior_family == "activateEvents":
            if event_id is None or event_time is None:
                raise SpecError("events are known by an id and a time")
            return live_activate_events(stream, spec, self.store, event_id, event_time, checkpoint, interval, context)
        order = order or live_order(stream, self.catalog.topic(spec.source).order)
        return live_map_records(stream, spec, self.store, order, checkpoint, interval, context=context)

    def history(self, spec: SyncSpec) -> DataFrame:
        return self.store.runs().filter(F.col("sync_id") == spec.name)

    def notifications(self, spec: SyncSpec) -> DataFrame:
        """What the sync's alerts have to say about its history; runs that are open have lasted until now."""
        return notifications(self.history(spec), list(spec.alerts), self.clock())

    def missed(self, spec: SyncSpec, lo: datetime, hi: datetime) -> DataFrame:
        """The slots of the sync's schedule in [lo, hi) in which no run started."""
        if spec.schedule is None:
            raise SpecError("the sync has no schedule")
        span = self.spark.range(1).select(
            F.lit(spec.name).alias("sync_id"), F.lit(utc(lo)).alias("lo"), F.lit(utc(hi)).alias("hi")
        )
        return missed_runs(expected_runs(span, spec.schedule, "lo", "hi"), self.history(spec), spec.schedule)

    def _compact_if_due(self, spec: SyncSpec, run_id: str, now: datetime, seq: int) -> None:
        pending = [r for r in self.store.writes_since_base(spec.object) if r.writes != "base"]
        if len(pending) >= self.compact_after:
            self.store.compact(spec.object, spec.keys, f"{spec.name}-{run_id}-base", now, seq)


class _Run:
    def __init__(
        self, runner: SyncRunner, spec: SyncSpec, run_id: str, now: datetime, full: bool, seq: int, prior: Row | None
    ) -> None:
        self.r, self.spec, self.run_id, self.now, self.full, self.seq = runner, spec, run_id, now, full, seq
        self.store, self.prior = runner.store, prior
        self.temporary: list[str] = []  # tables nobody needs once the run is committed
        self.parts: list[dict] = []  # writes to further objects, committed with the run
        self.has_state = False  # whether the run left the source's state for the next one
        self.metadata = [m.to for m in spec.mappings if m.type == "sync_metadata"]

    def execute(self) -> tuple[dict[str, int], str | None, str | None]:
        valid, rejected, seen = self._validated()
        watched, refused = self._counted(rejected)
        self.store.write_rejected(self.spec.name, self.run_id, watched)
        held = None
        if refused.get["n"] and self.spec.keys:
            # records that are in the source but cannot be sent: neither new nor gone
            held = self.store.rejected(self.spec.name, self.run_id).select(*[quoted(k) for k in self.spec.keys]).distinct()
        sent, writes = self._write(valid, held)
        mark = seen.get.get("mark")
        if mark is None and self.prior is not None:
            mark = self.prior.high_water_mark
        return counters_from(*sent, refused.get["n"], seen.get["n"]), mark, writes

    def tidy(self) -> None:
        """After the commit: delete this run's intermediate tables and the source state the next run does not need."""
        for path in self.temporary:
            discard(self.r.spark, path)
        if self.prior is not None:
            if self.prior.state:
                discard(self.r.spark, self.store.path("state", self.spec.name, self.prior.run_id))

    def _kept(self, df: DataFrame, kind: str) -> DataFrame:
        path = self.store.path(kind, self.spec.name, self.run_id)
        self.temporary.append(path)
        return stored(df, path)

    # ---- read, map, validate

    def _source(self) -> tuple[DataFrame, dict]:
        src = self.r.catalog.resolve(self.r.spark, self.spec.source)
        column = self.spec.high_water_mark_attribute
        if column is None:
            return src, {}
        if self.prior is not None and self.prior.high_water_mark is not None and not self.full:
            past = mark_value(self.prior.high_water_mark, src.schema[column].dataType)
            src = src.filter((quoted(column) > past) | quoted(column).isNull())
        return src, {MARK: quoted(column)}

    def _mapped(self) -> DataFrame:
        src, extra = self._source()
        if self.r.members is None and not self.r.segments and any(
            m.type == "segment_membership" for m in self.spec.mappings
        ):
            raise SpecError("segment membership needs segments or a membership table")
        mapped = project(src, self.spec, self.run_id, self.r.segments, self.r.lookups, keep_rejects=True, extra=extra)
        mapped = validate_fields(mapped, self.r.fields)
        if not extra:
            return mapped
        return mapped.withColumn(REASON, F.when(F.col(MARK).isNull(), F.lit("null_mark")).otherwise(F.col(REASON)))

    def _validated(self) -> tuple[DataFrame, DataFrame, Observation]:
        """Valid and rejected records, and the observation of record count and new mark.

        A source that is cheap and safe to read again is not copied: the key check reads its key columns only. Others
        are written down once, so that every later pass sees the same rows.
        """
        mapped, keys, seen = self._mapped(), self.spec.keys, Observation()
        marked = [c for c in (MARK,) if c in mapped.columns]
        measures = [F.count(F.lit(1)).alias("n"), *[mark_text(F.max(c), mapped.schema[c].dataType).alias("mark") for c in marked]]
        again = rereadable(mapped)
        if not again:
            mapped = self._kept(mapped.observe(seen, *measures), "staging")
        body = mapped.drop(MARK)
        if keys:
            twice = self._kept(self._duplicates(mapped, marked, seen if again else None), "duplicates")
            usable, rejected = split_by_key(body, keys, twice)
            rejected = rejected.unionByName(usable.filter(F.col(REASON).isNotNull()))
        else:
            usable = mapped.observe(seen, *measures).drop(MARK) if again else body
            rejected = body.filter(F.col(REASON).isNotNull())
        columns = [quoted(c) for c in usable.columns if c not in (REASON, VALUE)]
        valid = usable.filter(F.col(REASON).isNull()).select(*columns)
        if self.r.members is not None:
            for m in self.spec.mappings:
                if m.type == "segment_membership":
                    t = self.r.members
                    valid = with_membership(valid, m.to, keys[0], t.table, t.key, t.segment, spread=False)
        return valid, rejected, seen

    def _duplicates(self, mapped: DataFrame, marked: list[str], seen: Observation | None) -> DataFrame:
        """The keys that occur more than once; record count and new mark fall out of the same grouping.

        The observation sits above the grouping: below it, an empty shuffle would be optimized away and take it along.
        """
        keys = [quoted(k) for k in self.spec.keys]
        grouped = mapped.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.max(c).alias(c) for c in marked])
        if seen is not None:
            total = F.coalesce(F.sum("__n"), F.lit(0)).alias("n")
            grouped = grouped.observe(seen, total, *[mark_text(F.max(c), mapped.schema[c].dataType).alias("mark") for c in marked])
        for k in keys:
            grouped = grouped.filter(k.isNotNull())
        return grouped.filter("__n > 1").select(*keys)

    # ---- write

    def _write(self, valid: DataFrame, held: DataFrame | None) -> tuple[tuple[int, int, int], str | None]:
        spec = self.spec
        if spec.exports_file:
            watched, inserts = self._counted(valid)
            export_file(watched, spec.object, spec.advanced_configuration, self.now, self.r.root)
            return (inserts.get["n"], 0, 0), None
        if spec.replaces_object:
            if spec.keys and not rereadable(valid):
                valid = self._kept(valid, "valid")
            watched, inserts = self._counted(valid)
            self.store.write(spec.object, spec.name, self.run_id, watched)
            if spec.keys:  # a later run with another strategy starts from what was uploaded
                seen = ch.snapshot(valid, spec.keys, self.metadata).withColumn(ch.CHANGE, F.lit(ch.UNCHANGED))
                self.store.write_state(spec.name, self.run_id, seen)
                self.has_state = True
            return (inserts.get["n"], 0, 0), "base"
        if spec.high_water_mark_attribute:
            new = valid
            if self.prior is None and spec.historical_sync_operation == "skip_current_records":
                new = valid.filter(F.lit(False))
            return self._append(new), "append"
        sent, gone, touched = self._delta(valid, held)
        part = touched is not None
        if spec.operation == "append":
            if part:
                sent = sent.filter(F.col(ch.CHANGE) == ch.INSERT).drop(ch.CHANGE)
            elif self.prior is None:
                sent = ch.appended(sent, first_run=True, historical=spec.historical_sync_operation)
            return self._append(sent), "append"
        fresh = sent.drop(ch.CHANGE)
        if part and gone is not None:
            touched = touched.unionByName(gone)
        if spec.object in self.r.unions:
            return self._write_union(fresh), None
        return self._merge(spec.object, spec.name, self.run_id, fresh, gone, touched)

    def _append(self, new: DataFrame) -> tuple[int, int, int]:
        watched, inserts = self._counted(new)
        self.store.write(self.spec.object, self.spec.name, self.run_id, watched)
        return inserts.get["n"], 0, 0

    def _delta(self, valid: DataFrame, held: DataFrame | None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
        """The records to send, labelled insert or update, the keys to delete, and those sent; keeps the state for the next run.

        Keys and fingerprints meet first; then the source is read again for the records of the keys that changed. A first or full run, and one after a run that left no state, sends all records, unlabelled. Keys that are ``held``
        (in the source, but rejected) keep the fingerprint they had, and are never deleted.
        """
        spec, keys, store = self.spec, self.spec.keys, self.store
        fields = [valid.schema[k] for k in keys]
        previous = store.snapshot(spec.name, self.prior.run_id, fields) if self.prior is not None and self.prior.state else None
        self.has_state, waiting = True, None
        if held is not None and previous is not None:
            held = held.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in fields])
            waiting = previous.join(held, keys, "left_semi").withColumn(ch.CHANGE, F.lit(ch.UNCHANGED))
            previous = previous.join(held, keys, "left_anti")
        deletes = spec.operation == "mirror" and spec.mirror_strategy == "sync_updates_and_deletes"
        if not rereadable(valid):
            valid = self._kept(valid, "valid")
        if previous is None or self.full:
            seen = ch.snapshot(valid, keys, self.metadata).withColumn(ch.CHANGE, F.lit(ch.UNCHANGED))
            seen = seen if waiting is None else seen.unionByName(waiting)
            store.write_state(spec.name, self.run_id, seen)
            return valid, ch.gone_since(valid, previous, keys) if deletes and previous is not None else None, None
        state = ch.source_state(valid, previous, keys, self.metadata)
        state = state if waiting is None else state.unionByName(waiting)
        store.write_state(spec.name, self.run_id, state)
        state = store.state(spec.name, self.run_id, state.schema)
        columns = [quoted(k) for k in keys]
        changed = state.filter(F.col(ch.CHANGE).isin(ch.INSERT, ch.UPDATE)).drop(ch.FINGERPRINT)
        gone = state.filter(F.col(ch.CHANGE) == ch.DELETE).select(*columns)
        return ch.of_keys(valid, changed, keys), gone if deletes else None, changed.select(*columns)

    @staticmethod
    def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("n")), seen

    def _merge(
        self, obj: str, sync: str | None, run_id: str, fresh: DataFrame, gone: DataFrame | None, touched: DataFrame | None
    ) -> tuple[tuple[int, int, int], str]:
        """Bring one object up to date with the fresh records, as a change set where it can be one.

        ``touched`` lists every key that may change, where that is less than the whole source.
        """
        spec, keys = self.spec, self.spec.keys
        present = self.store.read(obj, keys)
        if present is None:
            whole, inserts = self._counted(fresh.filter(F.lit(False)) if spec.operation == "update" else fresh)
            self.store.write(obj, sync, run_id, whole)
            return (inserts.get["n"], 0, 0), "base"
        retyped = any(
            m.follow_source_type and m.to in present.columns and m.to in fresh.columns
            and present.schema[m.to].dataType != fresh.schema[m.to].dataType
            for m in spec.mappings
        )
        present = ch.evolve(present, fresh, spec.mappings)
        if touched is not None and not retyped:
            present = present.join(touched, keys, "left_semi").select(*[quoted(c) for c in present.columns])
        if spec.operation == "insert":
            planned = ch.new_records(fresh, present, keys).withColumn(ch.CHANGE, F.lit(ch.INSERT))
        else:
            nulls = spec.operation == "mirror" and spec.mirror_strategy == "sync_updates_and_nulls"
            planned = ch.plan_changes(
                fresh, present, keys, policies_of(spec.mappings, force_nulls=nulls),
                insert=spec.operation != "update", gone=gone, ignore=self.metadata,
            )
        counted = Observation()
        labels = (ch.INSERT, ch.UPDATE, ch.DELETE)
        watched = planned.observe(counted, *counts_of(ch.CHANGE, *labels))
        if retyped:
            whole = ch.end_state(watched)
            if spec.operation == "insert":
                whole = present.unionByName(whole, allowMissingColumns=True)
            self.store.write(obj, sync, run_id, whole)
            kind = "base"
        else:
            self.store.write(obj, sync, run_id, watched.filter(F.col(ch.CHANGE).isin(*labels)), self.seq)
            kind = "changes"
        return tuple(counted.get[name] or 0 for name in labels), kind

    def _write_union(self, fresh: DataFrame) -> tuple[int, int, int]:
        """A destination that is the union of two objects: each record is written where it exists or belongs."""
        spec, keys = self.spec, self.spec.keys
        if spec.operation not in ("insert", "update", "upsert"):
            raise SpecError(f"{spec.operation} does not apply to a union of objects")
        names = self.r.unions[spec.object]
        known = [self.store.read(n, keys) for n in names]
        known = [fresh.filter(F.lit(False)) if k is None else k for k in known]
        routed = ch.route_union(fresh, *known, keys, spec.lead_union_insert_to or names[0], names).drop("action")
        routed = self._kept(routed, "routed")
        sums = (0, 0, 0)
        for name in names:
            part, run_id = routed.filter(F.col("route") == name).drop("route"), f"{spec.name}-{self.run_id}-{name}"
            sent, kind = self._merge(name, None, run_id, part, None, part.select(*[quoted(k) for k in keys]))
            self.parts.append(dict(run_id=run_id, sync_id=None, object=name, writes=kind))
            sums = tuple(a + b for a, b in zip(sums, sent))
        return sums
