"""The sync language: what a sync reads, how fields map, how the destination changes, when to alert.

A spec is plain driver-side configuration (its size is the number of fields, segments, alerts, never the data).
``SyncSpec.from_config`` takes the nested attribute form that sync definitions are written in; empty strings, ``None``
and a cohort id of 0 count as unset.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field as dc_field, fields as dc_fields
from typing import Any

# The closed sets of the sync language.
OPERATIONS = ("upsert", "update", "insert", "append", "mirror")
MAPPING_TYPES = ("direct", "hash", "constant", "sync_metadata", "segment_membership", "liquid_template")
FIELD_BEHAVIORS = ("specific_properties", "sync_all_properties")
NORMALIZATIONS = ("start_case", "lower_case", "upper_case", "camel_case", "snake_case", "match_source_names")
FIELD_ORDERS = ("alphabetical_column_name", "mapping_order")
BEHAVIOR_FAMILIES = ("activateEvents", "mapRecords")
HISTORICAL_OPERATIONS = ("skip_current_records", "backfill_all_records")
MIRROR_STRATEGIES = ("sync_updates_and_deletes", "sync_updates_and_nulls", "upload_and_swap")
SOURCE_KINDS = ("table", "dataset", "model", "topic", "segment", "cohort")
ALERT_TYPES = (
    "FailureAlertConfiguration",
    "InvalidRecordPercentAlertConfiguration",
    "FullSyncTriggerAlertConfiguration",
    "RecordCountDeviationAlertConfiguration",
    "RuntimeAlertConfiguration",
    "StatusAlertConfiguration",
)
ALERT_SEND_FOR = ("first_time", "every_time")
ALERT_UNITS = ("minutes", "hours")
ALERT_START_TYPES = ("actual", "scheduled")
ALERT_STATUSES = ("started", "completed")
RECORD_TYPES = (
    "source_record_count",
    "records_updates",
    "records_deletes",
    "records_invalid",
    "records_processed",
    "records_updated",
    "records_failed",
)
RUN_MODES = ("live", "triggered")
FREQUENCIES = ("never", "continuous", "quarter_hourly", "hourly", "daily", "weekly", "expression")
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
SYNC_METADATA_KEYS = ("sync_run_id",)
SEGMENT_IDENTIFIERS = ("name",)
LIVE_SOURCE_TYPES = ("kafka", "materialize")


class SpecError(ValueError):
    """A sync definition that cannot be run."""


def _member(value: Any, allowed: tuple[str, ...], what: str) -> None:
    if value not in allowed:
        raise SpecError(f"{what} must be one of {', '.join(allowed)}; got {value!r}")


def set_values(config: dict[str, Any]) -> dict[str, Any]:
    """The entries of a config block that are set: no ``None``, no empty string, no ``cohort_id`` of 0."""
    return {k: v for k, v in config.items() if v is not None and v != "" and not (k == "cohort_id" and v in (0, "0"))}


def _block(value: Any) -> dict[str, Any]:
    """A config block given as a dict, as JSON text, or as the one-element list a nested block turns into."""
    if value is None or value == "" or value == []:
        return {}
    if isinstance(value, str):
        value = json.loads(value)
    if isinstance(value, list):
        if len(value) != 1:
            raise SpecError("expected exactly one block")
        value = value[0]
    if not isinstance(value, dict):
        raise SpecError(f"expected a block, got {type(value).__name__}")
    return set_values(value)


@dataclass(frozen=True)
class Field:
    """A destination field. ``type`` is a destination type (text, number, boolean, date) or any Spark type name."""

    name: str
    type: str | None = None
    required: bool = False


@dataclass(frozen=True)
class Mapping:
    """One destination field and where its value comes from."""

    to: str
    from_: str | None = None
    type: str = "direct"
    constant: Any = None
    sync_metadata_key: str | None = None
    segment_identify_by: str | None = None
    liquid_template: str | None = None
    is_primary_identifier: bool = False
    lookup_object: str | None = None
    lookup_field: str | None = None
    preserve_values: bool = False
    generate_field: bool = False
    sync_null_values: bool = True
    array_field: bool = False
    field_type: str | None = None
    follow_source_type: bool = False

    # which option each mapping type needs
    _NEEDS = {
        "direct": "from_",
        "hash": "from_",
        "constant": "constant",
        "sync_metadata": "sync_metadata_key",
        "segment_membership": "segment_identify_by",
        "liquid_template": "liquid_template",
    }

    def __post_init__(self) -> None:
        if not self.to:
            raise SpecError("a mapping needs a destination field")
        _member(self.type, MAPPING_TYPES, f"mapping type of {self.to}")
        need = self._NEEDS[self.type]
        if getattr(self, need) is None:
            raise SpecError(f"{self.type} mapping of {self.to} needs {need.rstrip('_')}")
        for kind, option in self._NEEDS.items():
            if option not in ("from_", need) and getattr(self, option) is not None:
                raise SpecError(f"mapping of {self.to} sets {option}, which needs type {kind}")
        if self.type not in ("direct", "hash") and self.from_ is not None:
            raise SpecError(f"{self.type} mapping of {self.to} takes no source column")
        if self.sync_metadata_key is not None:
            _member(self.sync_metadata_key, SYNC_METADATA_KEYS, "sync_metadata_key")
        if self.segment_identify_by is not None:
            _member(self.segment_identify_by, SEGMENT_IDENTIFIERS, "segment_identify_by")
        if (self.lookup_object is None) != (self.lookup_field is None):
            raise SpecError(f"lookup of {self.to} needs both lookup_object and lookup_field")

    @classmethod
    def from_config(cls, config: dict[str, Any]) -> Mapping:
        values = set_values(config)
        if "from" in values:
            values["from_"] = values.pop("from")
        known = {f.name for f in dc_fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise SpecError(f"unknown mapping options: {', '.join(unknown)}")
        return cls(**values)


@dataclass(frozen=True)
class DatasetSpec:
    """A named SQL query over source tables."""

    name: str
    query: str
    type: str = "sql"
    description: str | None = None

    def __post_init__(self) -> None:
        _member(self.type, ("sql",), "dataset type")


@dataclass(frozen=True)
class SegmentSpec:
    """A saved filter on a dataset."""

    name: str
    predicate: str


@dataclass(frozen=True)
class SourceSpec:
    """What a sync reads. Segment and cohort sources are datasets with a restriction."""

    kind: str
    id: str | None = None
    table: str | None = None
    schema: str | None = None
    catalog: str | None = None
    segment_id: str | None = None
    cohort_id: str | None = None
    #: Which connection's table it is; no part of equality.
    connection: str | None = dc_field(default=None, compare=False)

    def __post_init__(self) -> None:
        _member(self.kind, ("table", "dataset", "model", "topic"), "source kind")
        if self.kind == "table" and not self.table:
            raise SpecError("a table source needs table_name")
        if self.kind != "table" and not self.id:
            raise SpecError(f"a {self.kind} source needs an id")
        if (self.segment_id or self.cohort_id) and self.kind != "dataset":
            raise SpecError("segments and cohorts restrict datasets only")

    @classmethod
    def from_config(cls, config: Any) -> SourceSpec:
        attributes = _block(config)
        obj = _block(attributes.get("object"))
        kind = obj.get("type")
        _member(kind, SOURCE_KINDS, "source type")
        segment = attributes.get("filter_segment_id")
        cohort = attributes.get("cohort_id")
        ident = obj.get("id")
        if kind == "segment":
            # id is the segment when a dataset is named beside it, else the dataset under filter_segment_id
            if "dataset_id" in obj:
                segment, ident = ident, obj["dataset_id"]
            kind = "dataset"
        elif kind == "cohort":
            cohort, ident, kind = ident, obj.get("dataset_id"), "dataset"
        text = lambda v: None if v is None else str(v)
        if kind == "table":
            return cls(kind, None, obj.get("table_name"), obj.get("table_schema"), obj.get("table_catalog"), connection=text(attributes.get("connection_id")))
        return cls(kind, text(ident), segment_id=text(segment), cohort_id=text(cohort))


@dataclass(frozen=True)
class ScheduleSpec:
    frequency: str
    day: str | None = None
    hour: int = 0
    minute: int = 0

    def __post_init__(self) -> None:
        _member(self.frequency, FREQUENCIES, "frequency")
        if self.day is not None:
            _member(self.day, WEEKDAYS, "day")
        if self.frequency == "weekly" and self.day is None:
            raise SpecError("a weekly schedule needs a day")
        if not 0 <= self.hour <= 24:
            raise SpecError("hour must be between 0 and 24")
        if not 0 <= self.minute <= 59:
            raise SpecError("minute must be between 0 and 59")

    @classmethod
    def from_config(cls, config: dict[str, Any]) -> ScheduleSpec:
        c = set_values(config)
        return cls(c.get("frequency", ""), c.get("day"), int(c.get("hour", 0)), int(c.get("minute", 0)))


@dataclass(frozen=True)
class AlertSpec:
    type: str
    send_for: str = "first_time"
    should_send_recovery: bool = True
    threshold: float | None = None
    record_type: str | None = None
    unit: str = "minutes"
    start_type: str = "actual"
    status_name: str | None = None

    def __post_init__(self) -> None:
        _member(self.type, ALERT_TYPES, "alert type")
        _member(self.send_for, ALERT_SEND_FOR, "send_for")
        if self.type.startswith(("InvalidRecordPercent", "RecordCountDeviation", "Runtime")):
            if self.threshold is None:
                raise SpecError(f"{self.type} needs a threshold")
            if not self.type.startswith("Runtime") and not 0 <= self.threshold <= 100:
                raise SpecError("a percentage threshold lies between 0 and 100")
        if self.type.startswith("RecordCountDeviation"):
            _member(self.record_type, RECORD_TYPES, "record_type")
        if self.type.startswith("Runtime"):
            _member(self.unit, ALERT_UNITS, "unit")
            _member(self.start_type, ALERT_START_TYPES, "start_type")
        if self.type.startswith("Status"):
            _member(self.status_name, ALERT_STATUSES, "status_name")

    @classmethod
    def from_config(cls, config: dict[str, Any]) -> AlertSpec:
        c = set_values(config)
        options = set_values(c.get("options") or {})
        kwargs: dict[str, Any] = {k: c[k] for k in ("type", "send_for", "should_send_recovery") if k in c}
        kwargs |= {k: options[k] for k in ("record_type", "unit", "start_type", "status_name") if k in options}
        if "threshold" in options:
            try:
                kwargs["threshold"] = float(options["threshold"])
            except (TypeError, ValueError):
                raise SpecError(f"threshold is not a number: {options['threshold']!r}") from None
        return cls(**kwargs)


@dataclass(frozen=True)
class SyncSpec:
    """One sync: source, destination object, mappings, operation, alerts, run mode."""

    name: str
    source: SourceSpec
    object: str
    mappings: tuple[Mapping, ...] = ()
    operation: str = "upsert"
    field_behavior: str = "specific_properties"
    field_normalization: str = "match_source_names"
    field_order: str = "alphabetical_column_name"
    sync_behavior_family: str | None = None
    advanced_configuration: dict[str, Any] = dc_field(default_factory=dict)
    high_water_mark_attribute: str | None = None
    historical_sync_operation: str = "backfill_all_records"
    mirror_strategy: str = "sync_updates_and_deletes"
    lead_union_insert_to: str | None = None
    alerts: tuple[AlertSpec, ...] = ()
    run_mode: str = "triggered"
    schedule: ScheduleSpec | None = None
    source_type: str | None = None

    def __post_init__(self) -> None:
        _member(self.operation, OPERATIONS, "operation")
        _member(self.field_behavior, FIELD_BEHAVIORS, "field_behavior")
        _member(self.field_normalization, NORMALIZATIONS, "field_normalization")
        _member(self.field_order, FIELD_ORDERS, "field_order")
        _member(self.historical_sync_operation, HISTORICAL_OPERATIONS, "historical_sync_operation")
        _member(self.mirror_strategy, MIRROR_STRATEGIES, "mirror_strategy")
        _member(self.run_mode, RUN_MODES, "run mode")
        if self.high_water_mark_attribute and self.operation != "append":
            raise SpecError("high_water_mark_attribute applies to append syncs only")
        if self.sync_behavior_family is not None:
            _member(self.sync_behavior_family, BEHAVIOR_FAMILIES, "sync_behavior_family")
            live = self.run_mode == "live"
            if self.sync_behavior_family == "activateEvents" and not (live and self.source.kind == "topic"):
                raise SpecError("activateEvents needs a live sync of a streaming source")
            if self.sync_behavior_family == "mapRecords" and live and self.source_type == "materialize":
                raise SpecError("mapRecords is not available for live syncs from Materialize")
        names = [m.to for m in self.mappings]
        if len(set(names)) != len(names):
            raise SpecError("two mappings write the same destination field")
        keys = len(self.keys)
        optional = self.replaces_object or self.sync_behavior_family == "activateEvents"
        if keys > 1 or (keys == 0 and not optional):
            raise SpecError("exactly one mapping must be the primary identifier")

    @property
    def keys(self) -> list[str]:
        return [m.to for m in self.mappings if m.is_primary_identifier]

    @property
    def exports_file(self) -> bool:
        return "file_format" in self.advanced_configuration

    @property
    def replaces_object(self) -> bool:
        """The whole object is written afresh on every run, so records need no identifier."""
        return self.exports_file or (self.operation == "mirror" and self.mirror_strategy == "upload_and_swap")

    @classmethod
    def from_config(cls, config: dict[str, Any]) -> SyncSpec:
        c = set_values(config)
        dest = _block(c.get("destination_attributes"))
        mode = _block(c.get("run_mode"))
        triggers = _block(mode.get("triggers"))
        schedule = _block(triggers.get("schedule"))
        passed = (
            "operation", "field_behavior", "field_normalization", "field_order", "sync_behavior_family",
            "high_water_mark_attribute", "historical_sync_operation", "mirror_strategy", "source_type",
        )
        return cls(
            name=c.get("name", ""),
            source=SourceSpec.from_config(c.get("source_attributes")),
            object=dest.get("object") or c.get("destination_object") or "",
            mappings=tuple(Mapping.from_config(m) for m in c.get("field_mapping", ())),
            advanced_configuration=_block(c.get("advanced_configuration")),
            lead_union_insert_to=dest.get("lead_union_insert_to"),
            alerts=tuple(AlertSpec.from_config(a) for a in c.get("alert", ())),
            run_mode=mode.get("type", "triggered"),
            schedule=ScheduleSpec.from_config(schedule) if schedule else None,
            **{k: c[k] for k in passed if k in c},
        )
