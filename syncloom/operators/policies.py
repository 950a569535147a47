"""Per-field write policies: what a source value may do to an existing destination value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from syncloom.plans.spec import Mapping


@dataclass(frozen=True)
class WritePolicy:
    """``preserve`` keeps any existing value; without ``sync_nulls`` a source null does not overwrite one."""

    preserve: bool = False
    sync_nulls: bool = True

    def merged(self, new: Column, old: Column) -> Column:
        if self.preserve:
            return F.coalesce(old, new)
        return new if self.sync_nulls else F.coalesce(new, old)


def policies_of(mappings: Sequence[Mapping], force_nulls: bool = False) -> dict[str, WritePolicy]:
    return {m.to: WritePolicy(m.preserve_values, m.sync_null_values or force_nulls) for m in mappings}
