"""Destination field rules: required fields must be present, typed fields must be castable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.columns import quoted, spark_type
from syncloom.operators.keys import REASON, VALUE
from syncloom.plans.spec import Field


def typed(column: Column, type_name: str | None) -> Column:
    return column if type_name is None else column.try_cast(spark_type(type_name))


def first_problem(problems: Sequence[tuple[Column, str, Column]]) -> tuple[Column, Column]:
    """Reason and offending text of the first problem that holds; both null when none does."""
    if not problems:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    reason = F.coalesce(*[F.when(test, F.lit(text)) for test, text, _ in problems])
    value = F.coalesce(
        *[F.when(test, F.struct(raw.cast("string").alias("v"))) for test, _, raw in problems]
    ).getField("v")
    return reason, value


def validate_fields(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """One narrow pass: cast the fields, and name the first broken rule of each row in ``reject_reason``.

    Rows without one keep a null reason. ``rejected_value`` holds the text that could not be cast. Reasons already
    present on the input stand.
    """
    rules: list[tuple[Column, str, Column]] = []
    casts: dict[str, Column] = {}
    for f in fields:
        raw = quoted(f.name)
        if f.required:
            rules.append((raw.isNull(), f"missing_required:{f.name}", raw))
        if f.type is not None:
            casts[f.name] = typed(raw, f.type)
            rules.append((raw.isNotNull() & casts[f.name].isNull(), f"bad_type:{f.name}", raw))
    reason, value = first_problem(rules)
    body = [c for c in df.columns if c not in (REASON, VALUE)]
    if REASON in df.columns:
        earlier = F.col(VALUE) if VALUE in df.columns else F.lit(None).cast("string")
        value = F.when(F.col(REASON).isNotNull(), earlier).otherwise(value)
        reason = F.coalesce(F.col(REASON), reason)
    return df.select(
        *[casts.get(c, quoted(c)).alias(c) for c in body], reason.alias(REASON), value.alias(VALUE)
    )
