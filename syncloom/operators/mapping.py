"""Field mappings as projections: every mapping is one Column; lookups and membership tables add one join each."""

from __future__ import annotations

from collections.abc import Mapping as Dict, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncloom.functions.columns import hashed, quoted, spark_type
from syncloom.functions.naming import normalized_names, order_fields
from syncloom.functions.template import compile_template
from syncloom.operators.fields import first_problem
from syncloom.operators.keys import REASON, VALUE
from syncloom.operators.skew import join_unique
from syncloom.plans.spec import Mapping, SegmentSpec, SpecError, SyncSpec


@dataclass(frozen=True)
class LookupObject:
    """A destination object whose records can be referred to; ``id_field`` is what a reference resolves to."""

    records: DataFrame
    id_field: str = "id"


def constant_text(value: object) -> str:
    """The shortest text that reads back as the value; whole numbers without decimals, truth values in lower case."""
    text = repr(value) if isinstance(value, float) else str(value)
    if isinstance(value, bool):
        return text.lower()
    return str(int(value)) if isinstance(value, float) and value.is_integer() else text


def expand_mappings(columns: Sequence[str], spec: SyncSpec) -> list[Mapping]:
    """The explicit mappings, plus one direct mapping per unmapped source column under ``sync_all_properties``."""
    explicit = list(spec.mappings)
    if spec.field_behavior == "specific_properties":
        return explicit
    used = {m.from_ for m in explicit if m.type == "direct"}
    written = {m.to for m in explicit}
    names = normalized_names([c for c in columns if c not in used], spec.field_normalization)
    return explicit + [Mapping(to=to, from_=c) for c, to in names.items() if to not in written]


def segment_names(segments: Sequence[SegmentSpec]) -> Column:
    """Names of the segments whose predicate holds for the record, sorted and comma-joined; empty text for none."""
    hits = [F.when(F.expr(s.predicate), F.lit(s.name)) for s in sorted(segments, key=lambda s: s.name)]
    if not hits:
        return F.lit("")
    return F.array_join(F.array_compact(F.array(*hits)), ",")


def membership_by_key(members: DataFrame, key: str, segment: str) -> DataFrame:
    """One row per key: its segment names, sorted and comma-joined. Repeated rows collapse map-side in the set."""
    names = F.array_join(F.array_sort(F.collect_set(quoted(segment))), ",")
    return members.groupBy(quoted(key)).agg(names.alias("__segments"))


def _value(
    m: Mapping, df: DataFrame, run_id: str | None, segments: Sequence[SegmentSpec] | None
) -> tuple[Column, tuple[Column, str, Column] | None]:
    """The mapped value, and the rule that is broken when it cannot be given the field's type."""
    if m.type in ("direct", "hash"):
        if m.from_ not in df.columns:
            raise SpecError(f"mapping of {m.to} names the unknown column {m.from_!r}")
        raw = quoted(m.from_) if m.type == "direct" else hashed(quoted(m.from_))
    elif m.type == "constant":
        raw = F.lit(constant_text(m.constant))
    elif m.type == "sync_metadata":
        if run_id is None:
            raise SpecError(f"mapping of {m.to} needs a run")
        raw = F.lit(run_id)
    elif m.type == "liquid_template":
        raw = compile_template(m.liquid_template, df.columns)
    else:
        raw = segment_names(segments or [])
    value, problem = raw, None
    if m.field_type is not None and not m.follow_source_type:
        value = raw.try_cast(spark_type(m.field_type))
        problem = (raw.isNotNull() & value.isNull(), f"bad_type:{m.to}", raw)
    if m.array_field:
        is_array = m.type == "direct" and isinstance(df.schema[m.from_].dataType, T.ArrayType)
        if is_array:
            element = spark_type(m.field_type) if m.field_type and not m.follow_source_type else None
            value = F.transform(raw, lambda x: x.try_cast(element)) if element else raw
            problem = (F.exists(F.zip_with(raw, value, lambda a, b: a.isNotNull() & b.isNull()), lambda x: x),
                       f"bad_type:{m.to}", F.to_json(raw)) if element else None
        else:
            value = F.when(value.isNotNull(), F.array(value))
    return value, problem


def resolve_lookup(
    df: DataFrame, field: str, lookup: LookupObject, lookup_field: str, constant: str | None = None,
    spread: bool | None = None, values_of: DataFrame | None = None,
) -> DataFrame:
    """Replace the field's value by the id of the looked-up record; a value without a match is a ``lookup_miss``.

    Several matches resolve to the smallest id. A constant is resolved once, as a scalar subquery, instead of joining
    every record on one key. ``values_of`` may give the field's values from before other lookups were joined.
    """
    kind = lookup.records.schema[lookup_field].dataType
    by, found = quoted(lookup_field), F.min(quoted(lookup.id_field))
    raw, columns = quoted(field), df.columns
    if constant is not None:
        match = lookup.records.filter(by == F.lit(constant).try_cast(kind)).agg(found)
        joined = df.withColumn("__found", match.scalar())
    else:
        ids = lookup.records.filter(by.isNotNull()).groupBy(by.alias("__lookup")).agg(found.alias("__found"))
        probe = (raw if df.schema[field].dataType == kind else raw.try_cast(kind)).alias("__lookup")
        keys_of = None if values_of is None else values_of.select(probe)
        joined = join_unique(df.select("*", probe), ids, ["__lookup"], "left", spread, keys_of).drop("__lookup")
    miss = raw.isNotNull() & F.col("__found").isNull()
    if REASON in columns:
        miss = miss & F.col(REASON).isNull()
    out = [F.col("__found").alias(c) if c == field else quoted(c) for c in columns if c not in (REASON, VALUE)]
    earlier = (F.col(REASON), F.col(VALUE)) if REASON in columns else (F.lit(None).cast("string"),) * 2
    return joined.select(
        *out,
        F.when(miss, F.lit(f"lookup_miss:{field}")).otherwise(earlier[0]).alias(REASON),
        F.when(miss, raw.cast("string")).otherwise(earlier[1]).alias(VALUE),
    )


def with_membership(
    df: DataFrame, field: str, key: str, members: DataFrame, member_key: str, segment: str, spread: bool | None = None
) -> DataFrame:
    """Set the field from a table of (key, segment) rows; a record in no segment gets empty text."""
    names = membership_by_key(members, member_key, segment)
    names = names.select(quoted(member_key).alias(key), "__segments")
    joined = join_unique(df, names, [key], "left", spread)
    text = F.coalesce(F.col("__segments"), F.lit(""))
    columns = df.columns if field in df.columns else [*df.columns, field]
    return joined.select(*[text.alias(c) if c == field else quoted(c) for c in columns])


def project(
    df: DataFrame,
    spec: SyncSpec,
    run_id: str | None = None,
    segments: Sequence[SegmentSpec] | None = None,
    lookups: Dict[str, LookupObject] | None = None,
    keep_rejects: bool = False,
    spread: bool | None = None,
    extra: Dict[str, Column] | None = None,
) -> DataFrame:
    """Source columns to destination fields (flat; dotted names are nested when written).

    ``extra`` columns are carried along behind the fields.

    With ``keep_rejects`` the result carries ``reject_reason`` and ``rejected_value`` for values that did not fit
    their field; without, rows with such values are dropped from the result as they would be from the sync.
    """
    mappings = expand_mappings(df.columns, spec)
    columns, problems = [], []
    for m in mappings:
        value, problem = _value(m, df, run_id, segments)
        columns.append(value.alias(m.to))
        problems += [problem] if problem else []
    wanted = [m for m in mappings if m.lookup_object]
    checked = bool(problems or wanted or keep_rejects)
    if checked:
        reason, value = first_problem(problems)
        columns += [reason.alias(REASON), value.alias(VALUE)]
    out = df.select(*columns, *[c.alias(name) for name, c in (extra or {}).items()])
    narrow = out
    for m in wanted:
        if m.lookup_object not in (lookups or {}):
            raise SpecError(f"unknown lookup object {m.lookup_object!r}")
        constant = constant_text(m.constant) if m.type == "constant" else None
        out = resolve_lookup(out, m.to, lookups[m.lookup_object], m.lookup_field, constant, spread, narrow)
    fields = [m.to for m in mappings]
    if checked and not keep_rejects:
        out = out.filter(F.col(REASON).isNull())
    ordered = order_fields(out.select(*[quoted(c) for c in fields]), spec.field_order).columns
    return out.select(*[quoted(c) for c in ordered], *(extra or {}), *([REASON, VALUE] if keep_rejects else []))
