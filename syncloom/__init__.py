"""Declarative warehouse-to-destination syncs as Spark DataFrame jobs."""

from syncloom.plans.spec import (
    AlertSpec,
    DatasetSpec,
    Field,
    Mapping,
    ScheduleSpec,
    SegmentSpec,
    SourceSpec,
    SpecError,
    SyncSpec,
)

__all__ = [
    "AlertSpec",
    "DatasetSpec",
    "Field",
    "Mapping",
    "ScheduleSpec",
    "SegmentSpec",
    "SourceSpec",
    "SpecError",
    "SyncSpec",
]
