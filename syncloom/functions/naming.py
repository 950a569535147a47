"""Destination field names for automatically mapped columns, and field order. Names are driver-side, spec-sized."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from syncloom.functions.columns import quoted
from syncloom.plans.spec import SpecError

_BREAK = re.compile(r"[_\s\-]+|(?<=[a-z])(?=[A-Z])|(?<=[0-9])(?=[A-Z][a-z])")


def words(name: str) -> list[str]:
    """Split at ``_``, ``-``, spaces and where a lower-case letter, or a digit, meets a capitalized word."""
    return [w for w in _BREAK.split(name) if w]


def _camel(parts: list[str]) -> str:
    head, *rest = [p.lower() for p in parts]
    return head + "".join(p.capitalize() for p in rest)


_STYLES = {
    "start_case": lambda p: " ".join(w.capitalize() for w in p),
    "lower_case": lambda p: " ".join(p).lower(),
    "upper_case": lambda p: " ".join(p).upper(),
    "camel_case": _camel,
    "snake_case": lambda p: "_".join(p).lower(),
}


def normalize(name: str, mode: str) -> str:
    parts = words(name)
    return name if mode == "match_source_names" or not parts else _STYLES[mode](parts)


def normalized_names(columns: Iterable[str], mode: str) -> dict[str, str]:
    """Source column -> destination field; two columns that end up with one name are an error."""
    out: dict[str, str] = {}
    taken: dict[str, str] = {}
    for c in columns:
        new = normalize(c, mode)
        if new in taken:
            raise SpecError(f"columns {taken[new]} and {c} both become {new}")
        taken[new] = c
        out[c] = new
    return out


def order_fields(df: DataFrame, mode: str) -> DataFrame:
    """Fields in alphabetical order, or left in the order of the mappings."""
    if mode == "mapping_order":
        return df
    return df.select(*[quoted(c) for c in sorted(df.columns)])
