"""Destination objects as plain Parquet below one root, each run writing its own directories.

``<root>/objects/<object>/<sync>/<run>``  what the run wrote: a full ``base``, a set of ``changes``, or records to ``append``
``<root>/state/<sync>/<run>``        the source records the run saw, by key and fingerprint, and those it found changed
``<root>/rejected/<sync>/<run>``     records the run refused, with the reason
``<root>/sync_runs/day=<day>``       a row when a run starts, and one when it ends, appended last: that row is the commit

Nothing is overwritten in place, so a lost executor or a failed run leaves the last committed state readable, and a
repeated run id rewrites its own directories only. A run writes its changes, not the whole object; the object is read as
its last base with the later changes laid over it, and ``compact`` folds them into a new base now and then.
"""

from __future__ import annotations

from collections.abc import Mapping as Dict, Sequence
from datetime import date, datetime, timezone
from itertools import groupby
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from syncloom.functions.columns import flatten, nest, quoted
from syncloom.operators.changes import CHANGE, DELETE, FINGERPRINT
from syncloom.operators.keys import latest_by_key
from syncloom.operators.policies import WritePolicy
from syncloom.operators.runs import OPEN, RUN_SCHEMA, folded
from syncloom.session import discard, scratch_path, stored

SEQ, DAY = "_seq", "day"
ORDER = "_order_"


def order_columns(df: DataFrame) -> list[str]:
    """The columns that say which of two records of a key is the later one (live objects carry them)."""
    return sorted(c for c in df.columns if c.startswith(ORDER))


def utc(at: datetime) -> datetime:
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at


class ObjectStore:
    """Runs and objects below ``root``. One writer per object at a time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._run_rows([], 0).write.partitionBy(DAY).mode("ignore").parquet(self._runs_path)

    @property
    def _runs_path(self) -> str:
        return f"{self.root}/sync_runs"

    # ---- runs

    def runs(self) -> DataFrame:
        """The run history, one row per attempt of a run: as it ended, or ``started`` while it is open or if its driver was lost."""
        return folded(self._stored_runs().drop(DAY))

    def _ended(self) -> DataFrame:
        """The rows written at the end of runs; they need no folding."""
        return self._stored_runs().drop(DAY).filter(F.col("status") != OPEN)

    def _stored_runs(self) -> DataFrame:
        return self.spark.read.schema(f"{RUN_SCHEMA}, {DAY} date").parquet(self._runs_path)

    def completed(self, sync_id: str) -> DataFrame:
        """The ids of a sync's committed runs."""
        return self._ended().filter((F.col("sync_id") == sync_id) & (F.col("status") == "completed")).select("run_id")

    def tidy_history(self, before: date) -> None:
        """Rewrite the run rows of each earlier day as one file, so that reading the history lists few files."""
        old = self._stored_runs().filter(F.col(DAY) < F.lit(before))
        kept = stored(old, scratch_path(self.spark, "history"))
        writer = kept.repartition(DAY).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
        writer.partitionBy(DAY).parquet(self._runs_path)

    def standing(self, sync_id: str, run_id: str) -> tuple[Row | None, Row | None, int]:
        """The committed row of this run, the sync's last completed run, and the next sequence number, in one job.

        A run is known by its sync and its id: two syncs may use the same ids.
        """
        runs, done = self._stored_runs().drop(DAY), F.col("status") == "completed"
        row = F.struct("seq", *[c for c in runs.columns if c != "seq"])
        found = runs.agg(
            F.max(F.when(done & (F.col("sync_id") == sync_id) & (F.col("run_id") == run_id), row)).alias("same"),
            F.max(F.when(done & (F.col("sync_id") == sync_id), row)).alias("last"),
            F.coalesce(F.max("seq"), F.lit(0)).alias("seq"),
        ).first()
        return found.same, found.last, found.seq + 1

    def record(self, **values: Any) -> None:
        """Append one run row. For a completed run this is the commit."""
        self.commit([values])

    def commit(self, rows: Sequence[Dict[str, Any]]) -> None:
        """Append several rows of one day in one task: they are one file, so either all are there or none is."""
        frames = [self._run_rows(values, 1) for values in rows]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        whole.coalesce(1).write.mode("append").partitionBy(DAY).parquet(self._runs_path)

    def _run_rows(self, values: Any, rows: int) -> DataFrame:
        given = {k: utc(v) if isinstance(v, datetime) else v for k, v in dict(values).items()}
        fields = T.StructType.fromDDL(RUN_SCHEMA).fields
        day = F.lit(given["started_at"].astimezone(timezone.utc).date() if rows else None).cast("date").alias(DAY)
        return self.spark.range(0, rows, 1, 1).select(
            *[F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in fields], day
        )

    # ---- objects

    def path(self, kind: str, name: str, run_id: str) -> str:
        return f"{self.root}/{kind}/{name}/{run_id}"

    def place(self, obj: str, sync_id: str | None, run_id: str) -> str:
        return f"{self.root}/objects/{obj}/{sync_id or '_'}/{run_id}"

    def write(self, obj: str, sync_id: str | None, run_id: str, df: DataFrame, seq: int | None = None) -> None:
        """Write a run's records to its own directory; changes carry the sequence number that orders them."""
        out = nest(df) if seq is None else nest(df).withColumn(SEQ, F.lit(seq).cast("bigint"))
        out.write.mode("overwrite").parquet(self.place(obj, sync_id, run_id))

    def writes_since_base(self, obj: str) -> list[Row]:
        """Committed writes that make up the object: the last base, if any, and what came after it, in order.

        A compacted base has the sequence number of the last change it holds.
        """
        own = self._ended().filter((F.col("object") == obj) & (F.col("status") == "completed") & F.col("writes").isNotNull())
        base = own.filter("writes = 'base'").agg(F.coalesce(F.max("seq"), F.lit(0))).scalar()
        later = (F.col("seq") > base) | ((F.col("seq") == base) & (F.col("writes") == "base"))
        found = own.filter(later).select("seq", "run_id", "writes", F.coalesce("sync_id", F.lit("_")).alias("sync_id"))
        return sorted(found.distinct().collect())

    def read(
        self, obj: str, keys: Sequence[str] = (), policies: Dict[str, WritePolicy] | None = None
    ) -> DataFrame | None:
        """The object as committed, flat; ``None`` before its first write."""
        df = self._read_all(obj, keys, policies)
        return None if df is None else df.drop(*order_columns(df))

    def _read_all(self, obj: str, keys: Sequence[str], policies: Dict[str, WritePolicy] | None) -> DataFrame | None:
        whole = None
        for kind, group in groupby(self.writes_since_base(obj), key=lambda r: r.writes):
            part = self._load([self.place(obj, r.sync_id, r.run_id) for r in group])
            if whole is not None:
                whole, part = same_types([whole, part])
            if kind == "changes":
                whole = overlaid(whole, part, keys, policies)
            else:
                whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
        return whole

    def _load(self, paths: list[str]) -> DataFrame:
        """Files of several runs. Runs of one schema are one scan; fields may have come, gone or changed type."""
        groups: list[tuple[T.StructType, list[str]]] = []
        for path in paths:
            schema = self.spark.read.parquet(path).schema
            if not groups or groups[-1][0] != schema:
                groups.append((schema, []))
            groups[-1][1].append(path)
        frames = same_types([flatten(self.spark.read.schema(schema).parquet(*some)) for schema, some in groups])
        whole = None
        for frame in frames:
            whole = frame if whole is None else whole.unionByName(frame, allowMissingColumns=True)
        newest = frames[-1].columns
        return whole.select(*[quoted(c) for c in [*newest, *[c for c in whole.columns if c not in newest]]])

    def create_object(self, obj: str, schema: T.StructType, run_id: str, at: datetime) -> None:
        """A new, empty object with typed fields."""
        self.write(obj, None, run_id, self.spark.createDataFrame([], schema))
        self._commit_base(obj, run_id, at, self.standing("", run_id)[2])

    def compact(
        self, obj: str, keys: Sequence[str], run_id: str, at: datetime, seq: int,
        policies: Dict[str, WritePolicy] | None = None,
    ) -> None:
        """Fold the changes since the last base, up to ``seq``, into a new one."""
        self.write(obj, None, run_id, self._read_all(obj, keys, policies))
        self._commit_base(obj, run_id, at, seq)

    def _commit_base(self, obj: str, run_id: str, at: datetime, seq: int) -> None:
        self.record(run_id=run_id, status="completed", created_at=at, started_at=at, completed_at=at, object=obj,
                    writes="base", seq=seq)

    def vacuum(self, obj: str) -> None:
        """Delete what the object's last base has superseded. Not while something still reads an older state."""
        current = {(r.sync_id, r.run_id) for r in self.writes_since_base(obj)}
        past = self._ended().filter((F.col("object") == obj) & (F.col("status") == "completed") & F.col("writes").isNotNull())
        for r in past.select(F.coalesce("sync_id", F.lit("_")).alias("sync_id"), "run_id").distinct().toLocalIterator():
            if (r.sync_id, r.run_id) not in current:
                discard(self.spark, self.place(obj, r.sync_id, r.run_id))

    # ---- source state and rejected records

    def write_state(self, sync: str, run_id: str, df: DataFrame) -> None:
        """Stored by change, so that reading the changes reads (and plans with the size of) the changes only."""
        df.write.partitionBy(CHANGE).mode("overwrite").parquet(self.path("state", sync, run_id))

    def state(self, sync: str, run_id: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path("state", sync, run_id))

    def snapshot(self, sync: str, run_id: str, keys: Sequence[T.StructField]) -> DataFrame:
        """Key and fingerprint of the source records a run saw."""
        pair = T.StructType().add("a", "long").add("b", "long")
        schema = T.StructType([*keys, T.StructField(FINGERPRINT, pair), T.StructField(CHANGE, T.StringType())])
        return self.state(sync, run_id, schema).filter(F.col(CHANGE) != DELETE).drop(CHANGE)

    def write_rejected(self, sync: str, run_id: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path("rejected", sync, run_id))

    def rejected(self, sync: str, run_id: str) -> DataFrame:
        return self.spark.read.parquet(self.path("rejected", sync, run_id))


def as_text(column: Column, kind: T.DataType) -> Column:
    """Any value as text that says it whole."""
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast("string")


def loses(frame: DataFrame, name: str, kind: T.DataType) -> Column | None:
    """Whether a value of the field does not come back from ``kind``; ``None`` where one cannot be cast to the other."""
    column = quoted(name)
    lost = ~column.eqNullSafe(column.try_cast(kind).try_cast(frame.schema[name].dataType))
    try:
        frame.select(lost)
    except AnalysisException:
        return None
    return lost


def same_types(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """The frames, oldest first, with one type for each field: the newest of its types that holds all its values, else text.

    Values are looked at only where a field changed to something other than text.
    """
    kinds: dict[str, list[T.DataType]] = {}
    for frame in reversed(frames):
        for f in frame.schema.fields:
            if f.dataType not in (seen := kinds.setdefault(f.name, [])):
                seen.append(f.dataType)
    several = {name: seen for name, seen in kinds.items() if len(seen) > 1}
    text = T.StringType()
    tries = {(name, k): kind for name, seen in several.items() if seen[0] != text for k, kind in enumerate(seen) if kind != text}
    tests: dict[tuple[str, int], list[bool]] = {place: [] for place in tries}
    for frame in frames:
        wanted = {}
        for (name, k), kind in tries.items():
            if name in frame.columns and frame.schema[name].dataType != kind:
                lost = loses(frame, name, kind)
                if lost is None:
                    tests[name, k].append(True)
                else:
                    wanted[name, k] = lost
        if wanted:
            found = frame.agg(*[F.coalesce(F.max(lost), F.lit(False)) for lost in wanted.values()]).first()
            for place, lost in zip(wanted, found):
                tests[place].append(lost)
    chosen = {name: next((kind for k, kind in enumerate(seen) if (name, k) in tries and not any(tests[name, k])), text)
              for name, seen in several.items()}

    def cast(f: T.StructField) -> Column:
        to = chosen.get(f.name, f.dataType)
        if f.dataType == to:
            return quoted(f.name)
        return (as_text(quoted(f.name), f.dataType) if to == text else quoted(f.name).try_cast(to)).alias(f.name)

    return [frame.select(*[cast(f) for f in frame.schema.fields]) if several else frame for frame in frames]


def overlaid(
    whole: DataFrame | None, changes: DataFrame, keys: Sequence[str], policies: Dict[str, WritePolicy] | None = None
) -> DataFrame:
    """The base with the last change of every changed key laid over it.

    Only changed keys are grouped; the base is anti-joined, by broadcast while the changes are small. Base rows of
    changed keys join the fold where they can matter: under write policies that look at the present value, and where
    records carry an order of their own, so that a late record does not displace a newer one.
    """
    keys = list(keys)
    key_cols = [quoted(k) for k in keys]
    fold = {c: p for c, p in (policies or {}).items() if c in changes.columns and (p.preserve or not p.sync_nulls)}
    order = order_columns(changes)
    rows = changes
    if (fold or order) and whole is not None:
        touched = whole.join(changes.select(*key_cols).distinct(), keys, "left_semi")
        rows = changes.unionByName(
            touched.withColumn(SEQ, F.lit(0).cast("bigint")).withColumn(CHANGE, F.lit("kept")), allowMissingColumns=True
        )
    last = latest_by_key(rows, keys, [*order, SEQ], fold)
    live = last.filter(F.col(CHANGE) != DELETE).drop(CHANGE, SEQ)
    if whole is None:
        return live
    rest = whole.join(last.select(*key_cols), keys, "left_anti")
    columns = [c for c in live.columns if c in whole.columns] + [c for c in whole.columns if c not in live.columns]
    columns += [c for c in live.columns if c not in whole.columns]
    both = rest.unionByName(live, allowMissingColumns=True)
    return both.select(*[quoted(c) for c in columns])
