"""Record keys: a record needs a non-null key that no other record of the batch carries."""

from __future__ import annotations

from collections.abc import Mapping as Dict, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.columns import has_map, quoted
from syncloom.operators.policies import WritePolicy
from syncloom.operators.skew import join_unique
from syncloom.session import fits_broadcast, scratch_path, stored

REASON, VALUE, WHY = "reject_reason", "rejected_value", "__why"
NULL_KEY, DUPLICATE_KEY = "null_key", "duplicate_key"


def _no_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The non-null keys that occur more than once. Counts are combined map-side; only key columns are read."""
    return (
        df.filter(~_no_key(keys))
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
        .drop("__n")
    )


def single_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is theirs alone. Rows of one key collapse map-side, so a hot key costs one row per task."""
    rest = [c for c in df.columns if c not in keys]
    n, row = F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*[quoted(c) for c in rest])).alias("__row")
    grouped = df.groupBy(*[quoted(k) for k in keys]).agg(n, *([row] if rest else [])).filter("__n = 1")
    fields = [F.col("__row").getField(c).alias(c) for c in rest]
    return grouped.select(*[quoted(k) for k in keys], *fields).select(*[quoted(c) for c in df.columns])


def labelled_rows(df: DataFrame, keys: Sequence[str], duplicates: DataFrame) -> DataFrame:
    """All rows with the reason their key is refused, or null, as ``WHY``, in one pass."""
    columns = [quoted(c) for c in df.columns]
    joined = df.join(duplicates.select(*[quoted(k) for k in keys], F.lit(True).alias("__twice")), list(keys), "left")
    reason = F.when(_no_key(keys), F.lit(NULL_KEY)).when(F.col("__twice"), F.lit(DUPLICATE_KEY))
    return joined.select(*columns, reason.alias(WHY))


def split_by_key(
    df: DataFrame, keys: Sequence[str], duplicates: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rejected rows carry ``null_key`` or ``duplicate_key`` (every row of a duplicated key).

    ``duplicates`` is the stored result of :func:`duplicate_keys`; it is computed and stored here when not given. While
    that table is small, one pass over the rows labels each of them, and both results are filters of it. When it is
    not, valid rows come from one pre-aggregated grouping and rejected ones from a join that spreads hot keys.
    """
    keys = list(keys)
    missing = _no_key(keys)
    present = df.filter(~missing)
    if duplicates is None:
        duplicates = stored(duplicate_keys(df, keys), scratch_path(df.sparkSession, "duplicate-keys"))
    columns = [quoted(c) for c in df.columns]
    if fits_broadcast(duplicates):
        labelled = labelled_rows(df, keys, duplicates)
        refused = labelled.filter(F.col(WHY).isNotNull()).withColumn(REASON, F.col(WHY))
        return labelled.filter(F.col(WHY).isNull()).drop(WHY), refused.drop(WHY)
    valid = single_rows(present, keys)
    doubled = join_unique(present, duplicates, keys, "left_semi").select(*columns)
    rejected = (
        df.filter(missing)
        .withColumn(REASON, F.lit(NULL_KEY))
        .unionByName(doubled.withColumn(REASON, F.lit(DUPLICATE_KEY)))
    )
    return valid, rejected


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policies: Dict[str, WritePolicy] | None = None
) -> DataFrame:
    """One row per key: the last by ``order``. All of it combines map-side, so hot keys collapse before the shuffle.

    Fields whose policy keeps existing values take the first non-null value instead, fields that skip nulls the last
    non-null one. Rows that tie on ``order`` are told apart by their other columns, so a repeated run agrees.
    """
    policies = policies or {}
    rest = [c for c in df.columns if c not in keys]
    loose = {f.name for f in df.schema.fields if has_map(f.dataType)}  # maps have no order
    ordered = F.struct(*[quoted(c) for c in [*order, *[c for c in rest if c not in order and c not in loose]]])
    picks: dict[str, Column] = {c: F.max_by(quoted(c), ordered) for c in rest if c in loose}
    for c in rest:
        policy = policies.get(c, WritePolicy())
        at = F.when(quoted(c).isNotNull(), ordered)
        if policy.preserve:
            picks[c] = F.min_by(quoted(c), at)
        elif not policy.sync_nulls:
            picks[c] = F.max_by(quoted(c), at)
    names = {c: f"__f{i}" for i, c in enumerate(picks)}
    grouped = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.max(ordered).alias("__row"), *[pick.alias(names[c]) for c, pick in picks.items()]
    )
    values = [(F.col(names[c]) if c in picks else F.col("__row").getField(c)).alias(c) for c in rest]
    return grouped.select(*[quoted(k) for k in keys], *values).select(*[quoted(c) for c in df.columns])
