"""Change detection and the operations that bring a destination object up to date.

Every operator here expects at most one row per key on each side (``split_by_key`` sees to that for sources; a
destination object and a snapshot are written that way), so the joins have no hot key. All sides are hash-partitioned
on the key once, and chained joins reuse that partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping as Dict, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from syncloom.functions.columns import changed, fingerprint, quoted
from syncloom.operators.policies import WritePolicy
from syncloom.plans.spec import Mapping

CHANGE = "_change"
INSERT, UPDATE, DELETE, UNCHANGED, KEPT = "insert", "update", "delete", "unchanged", "kept"
UPSERT, FINGERPRINT = "upsert", "_fingerprint"


def _flagged(df: DataFrame, side: str, flag: str) -> DataFrame:
    return df.withColumn(flag, F.lit(True)).alias(side)


def diff(src: DataFrame, target: DataFrame, keys: Sequence[str], fields: Sequence[str] | None = None) -> DataFrame:
    """Label every key insert, update, delete or unchanged, with the values before and after as structs.

    ``fields`` are compared (default: all the sides share). Restrict both sides before calling: a filter on one side
    of a full outer join cannot be pushed below it.
    """
    keys = list(keys)
    names = list(fields) if fields is not None else [c for c in src.columns if c in target.columns and c not in keys]
    cols = [quoted(c) for c in [*keys, *names]]
    joined = _flagged(src.select(*cols), "s", "__s").join(_flagged(target.select(*cols), "t", "__t"), keys, "full_outer")
    here, there = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    different = changed([(quoted(c, "s"), quoted(c, "t")) for c in names])
    label = F.when(~there, INSERT).when(~here, DELETE).when(different, UPDATE).otherwise(UNCHANGED)
    return joined.select(
        *[quoted(k) for k in keys],
        label.alias("change"),
        F.when(there, F.struct(*[quoted(c, "t").alias(c) for c in names])).alias("before"),
        F.when(here, F.struct(*[quoted(c, "s").alias(c) for c in names])).alias("after"),
    )


def snapshot(src: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """What the next run needs to know about this one: per key a fingerprint of the mapped fields.

    ``ignore`` names fields that differ on every run (run metadata). The snapshot stays narrow however wide records are.
    """
    marked = fingerprint(_compared(src, keys, ignore)).alias(FINGERPRINT)
    return src.select(*[quoted(k) for k in keys], marked)


def _compared(src: DataFrame, keys: Sequence[str], ignore: Sequence[str]) -> list[T.StructField]:
    """The fields that make a record changed, in an order that does not depend on the source's."""
    return sorted((f for f in src.schema.fields if f.name not in keys and f.name not in ignore), key=lambda f: f.name)


def changed_since(src: DataFrame, previous: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """The records that are new or differ from the previous snapshot."""
    keys = list(keys)
    joined = src.alias("s").join(previous.alias("p"), keys, "left")
    fresh = ~F.col(f"p.{FINGERPRINT}").eqNullSafe(fingerprint(_compared(src, keys, ignore), "s"))
    return joined.filter(fresh).select(*[quoted(k) if k in keys else quoted(k, "s") for k in src.columns])


def source_state(src: DataFrame, previous: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """The source against the previous snapshot, in one join of keys and fingerprints: what to send, and the snapshot for the next run.

    One row per key of either side with ``_change`` (insert, update, unchanged, delete) and the record's fingerprint (null
    for deletes). Fingerprints are made in the scan, so no field is exchanged, however wide records are; those of the
    changed keys are fetched by ``of_keys``.
    """
    keys = list(keys)
    marked = snapshot(src, keys, ignore)
    was = previous.select(*[quoted(k) for k in keys], F.col(FINGERPRINT).alias("__was"))
    joined = _flagged(marked, "s", "__s").join(_flagged(was, "p", "__p"), keys, "full_outer")
    here, there = F.col("__s").isNotNull(), F.col("__p").isNotNull()
    differs = ~F.col(f"s.{FINGERPRINT}").eqNullSafe(F.col("__was"))
    label = F.when(~here, DELETE).when(~there, INSERT).when(differs, UPDATE).otherwise(UNCHANGED)
    return joined.select(*[quoted(k) for k in keys], F.col(f"s.{FINGERPRINT}").alias(FINGERPRINT), label.alias(CHANGE))


def of_keys(src: DataFrame, labelled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The records of the labelled keys, with their label. Labels are a stored table of known size: few are broadcast."""
    joined = src.join(labelled.select(*[quoted(k) for k in keys], CHANGE), list(keys))
    return joined.select(*[quoted(c) for c in src.columns], CHANGE)


def gone_since(src: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the previous snapshot that left the source."""
    cols = [quoted(k) for k in keys]
    return previous.select(*cols).join(src.select(*cols), list(keys), "left_anti")


def evolve(dst: DataFrame, src: DataFrame, mappings: Sequence[Mapping]) -> DataFrame:
    """Give the destination the generated fields it lacks, and re-type the fields that follow their source."""
    have, wanted = set(dst.columns), {f.name: f.dataType for f in src.schema.fields}
    retype = {m.to for m in mappings if m.follow_source_type and m.to in wanted}
    out = []
    for f in dst.schema.fields:
        again = f.name in retype and f.dataType != wanted[f.name]
        out.append((quoted(f.name).try_cast(wanted[f.name]) if again else quoted(f.name)).alias(f.name))
    new = [m.to for m in mappings if m.generate_field and m.to not in have and m.to in wanted]
    out += [F.lit(None).cast(wanted[name]).alias(name) for name in new]
    return dst.select(*out)


def plan_changes(
    src: DataFrame,
    dst: DataFrame,
    keys: Sequence[str],
    policies: Dict[str, WritePolicy] | None = None,
    insert: bool = True,
    gone: DataFrame | None = None,
    previous: DataFrame | None = None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Every destination record as it will be, labelled in ``_change``.

    insert / update / unchanged (the merged record equals the present one, write policies included) / delete /
    kept (no source record, not to be deleted). Deletes are the keys in ``gone``, or those of ``previous`` that the
    source no longer has. ``ignore`` names fields that alone do not make an update. Records to delete show their last
    values.
    """
    keys, policies = list(keys), policies or {}
    fields = [c for c in dst.columns if c not in keys]
    fields += [c for c in src.columns if c not in keys and c not in fields]
    left = _flagged(dst, "d", "__d")
    if gone is not None or previous is not None:
        marks = (gone if gone is not None else previous).select(*[quoted(k) for k in keys]).withColumn("__p", F.lit(True))
        left = left.join(marks, keys, "left")
        leaving = F.col("__p").isNotNull()
    else:
        leaving = F.lit(False)
    joined = left.alias("d").join(_flagged(src, "s", "__s"), keys, "full_outer" if insert else "left")
    here, there = F.col("__s").isNotNull(), F.col("__d").isNotNull()
    after, pairs = {}, []
    for c in fields:
        if c not in src.columns:
            after[c] = quoted(c, "d")
        elif c not in dst.columns:
            after[c] = quoted(c, "s")
        else:
            merged = policies.get(c, WritePolicy()).merged(quoted(c, "s"), quoted(c, "d"))
            after[c] = F.when(here, merged).otherwise(quoted(c, "d"))
            if c not in ignore:
                pairs.append((after[c], quoted(c, "d")))
        if c in src.columns and c not in dst.columns and c not in ignore:
            pairs.append((after[c], F.lit(None)))
    label = (
        F.when(~here & leaving, DELETE)
        .when(~here, KEPT)
        .when(~there, INSERT)
        .when(changed(pairs), UPDATE)
        .otherwise(UNCHANGED)
    )
    # an unchanged record keeps every present value, run metadata included
    keep = {c: F.when(there & here & ~changed(pairs), quoted(c, "d")).otherwise(after[c])
            for c in ignore if c in src.columns and c in dst.columns}
    columns = [*dst.columns, *[c for c in src.columns if c not in dst.columns]]
    values = [quoted(c) if c in keys else keep.get(c, after[c]).alias(c) for c in columns]
    return joined.select(*values, label.alias(CHANGE))


def end_state(changes: DataFrame) -> DataFrame:
    """The destination after the planned changes."""
    return changes.filter(F.col(CHANGE) != DELETE).drop(CHANGE)


def apply_insert(src: DataFrame, dst: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source records whose key the destination lacks. Only the destination's keys are shuffled."""
    return dst.unionByName(new_records(src, dst, keys), allowMissingColumns=True)


def new_records(src: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source records whose key is not among ``known``."""
    joined = src.join(known.select(*[quoted(k) for k in keys]), list(keys), "left_anti")
    return joined.select(*[quoted(c) for c in src.columns])


def apply_update(src: DataFrame, dst: DataFrame, keys: Sequence[str], policies=None) -> DataFrame:
    """Change the records both sides have; new keys are ignored."""
    return end_state(plan_changes(src, dst, keys, policies, insert=False))


def apply_upsert(src: DataFrame, dst: DataFrame, keys: Sequence[str], policies=None) -> DataFrame:
    """Insert new records, update existing ones, never delete."""
    return end_state(plan_changes(src, dst, keys, policies))


def apply_mirror(
    src: DataFrame,
    dst: DataFrame,
    keys: Sequence[str],
    previous: DataFrame | None = None,
    strategy: str = "sync_updates_and_deletes",
    policies: Dict[str, WritePolicy] | None = None,
) -> DataFrame:
    """Keep the destination equal to the source, by one of three strategies.

    Deletes concern records that left the source since the last run, never records the sync does not own; without a
    previous run there are none.
    """
    if strategy == "upload_and_swap":
        return src
    if strategy == "sync_updates_and_nulls":
        names = [c for c in src.columns if c not in keys]
        given = policies or {}
        nulls = {c: WritePolicy(given.get(c, WritePolicy()).preserve, True) for c in names}
        return end_state(plan_changes(src, dst, keys, nulls))
    return end_state(plan_changes(src, dst, keys, policies, previous=previous))


def after_mark(src: DataFrame, column: str, mark: object | None) -> DataFrame:
    """Records past the high-water mark (strictly); all but null marks when there is none yet.

    A plain comparison with a literal of the column's type, so it reaches the file scan.
    """
    value = quoted(column)
    if mark is None:
        return src.filter(value.isNotNull())
    return src.filter(value > F.lit(mark).cast(src.schema[column].dataType))


def apply_append(
    src: DataFrame,
    dst: DataFrame,
    keys: Sequence[str] | None = None,
    previous: DataFrame | None = None,
    mark_column: str | None = None,
    mark: object | None = None,
    first_run: bool = False,
    historical: str = "backfill_all_records",
) -> DataFrame:
    """Add new records, never touch existing ones."""
    new = appended(src, keys, previous, mark_column, mark, first_run, historical)
    return dst.unionByName(new, allowMissingColumns=True)


def appended(
    src: DataFrame,
    keys: Sequence[str] | None = None,
    previous: DataFrame | None = None,
    mark_column: str | None = None,
    mark: object | None = None,
    first_run: bool = False,
    historical: str = "backfill_all_records",
) -> DataFrame:
    """The records an append sends: past the mark, or with keys the previous snapshot lacks."""
    if first_run and historical == "skip_current_records":
        return src.filter(F.lit(False))
    if mark_column is not None:
        return after_mark(src, mark_column, None if first_run else mark)
    if first_run or previous is None:
        return src
    return new_records(src, previous, keys)


def route_union(
    src: DataFrame, first: DataFrame, second: DataFrame, keys: Sequence[str], insert_to: str, names: tuple[str, str]
) -> DataFrame:
    """Where each record goes when the destination is the union of two objects.

    A record is updated where it exists (the first object wins); a new record is inserted into ``insert_to``.
    """
    if insert_to not in names:
        raise ValueError(f"insert_to must be one of {names}")
    keys = list(keys)
    key_cols = [quoted(k) for k in keys]
    known = [obj.select(*key_cols).withColumn(flag, F.lit(True)) for obj, flag in ((first, "__a"), (second, "__b"))]
    joined = src.join(known[0], keys, "left").join(known[1], keys, "left")
    in_first, in_second = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    return joined.select(
        *[quoted(c) for c in src.columns],
        F.when(in_first, names[0]).when(in_second, names[1]).otherwise(insert_to).alias("route"),
        F.when(in_first | in_second, UPDATE).otherwise(INSERT).alias("action"),
    )
