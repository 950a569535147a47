"""Text templates over a record, compiled to one Column expression on the driver (no UDF).

Supported: literal text, ``{{ name }}``, ``{{ record['name'] }}``, ``{{ record["name"] }}``, and the filter ``upcase``.
Anything else is refused rather than guessed at. A null value renders as empty text.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column, functions as F

from syncloom.functions.columns import quoted
from syncloom.plans.spec import SpecError

_TAG = re.compile(r"\{\{(.*?)\}\}", re.S)
_RECORD = re.compile(r"""record\[\s*(?:'([^']*)'|"([^"]*)")\s*\]""")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
FILTERS = {"upcase": F.upper}


def _value(tag: str, columns: Collection[str]) -> Column:
    head, *filters = [part.strip() for part in tag.split("|")]
    record = _RECORD.fullmatch(head)
    if record:
        name = record.group(1) if record.group(1) is not None else record.group(2)
    elif _NAME.fullmatch(head):
        name = head
    else:
        raise SpecError(f"unsupported template expression: {tag.strip()!r}")
    if name not in columns:
        raise SpecError(f"template names the unknown column {name!r}")
    value = F.coalesce(quoted(name).cast("string"), F.lit(""))
    for f in filters:
        if f not in FILTERS:
            raise SpecError(f"unsupported template filter: {f!r}")
        value = FILTERS[f](value)
    return value


def compile_template(text: str, columns: Collection[str]) -> Column:
    parts: list[Column] = []
    at = 0
    for m in _TAG.finditer(text):
        parts += [F.lit(text[at : m.start()])] if m.start() > at else []
        parts.append(_value(m.group(1), columns))
        at = m.end()
    rest = text[at:]
    if "{%" in text or "{{" in rest:
        raise SpecError("unsupported template syntax")
    if rest or not parts:
        parts.append(F.lit(rest))
    return F.concat(*parts)
