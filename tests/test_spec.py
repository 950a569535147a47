"""Parsing sync definitions."""

import pytest

from syncloom import AlertSpec, DatasetSpec, Mapping, ScheduleSpec, SourceSpec, SpecError, SyncSpec
from syncloom.operators.mapping import constant_text, expand_mappings
from syncloom.plans.spec import set_values

KEY = {"from": "email", "to": "Email", "is_primary_identifier": True}


def config(**more):
    return {
        "name": "users",
        "source_attributes": {"connection_id": 1, "object": {"type": "table", "table_name": "users"}},
        "destination_attributes": {"connection_id": 2, "object": "Contact"},
        "field_mapping": [KEY, {"from": "first_name", "to": "FirstName"}],
        **more,
    }


@pytest.mark.parametrize("given, want", [
    (KEY, Mapping("Email", "email", is_primary_identifier=True)),
    ({"from": "first_name", "to": "FirstName"}, Mapping("FirstName", "first_name")),
    ({"from": "a", "to": "b", "type": "direct"}, Mapping("b", "a")),
    ({"from": "email", "to": "h", "type": "hash"}, Mapping("h", "email", type="hash")),
    ({"to": "Source", "type": "constant", "constant": "Website"}, Mapping("Source", type="constant", constant="Website")),
    ({"to": "Priority", "type": "constant", "constant": 1}, Mapping("Priority", type="constant", constant=1)),
    ({"to": "N", "type": "liquid_template", "liquid_template": "{{ a }} {{ b }}"},
     Mapping("N", type="liquid_template", liquid_template="{{ a }} {{ b }}")),
    ({"to": "R", "type": "sync_metadata", "sync_metadata_key": "sync_run_id"},
     Mapping("R", type="sync_metadata", sync_metadata_key="sync_run_id")),
    ({"to": "S", "type": "segment_membership", "segment_identify_by": "name"},
     Mapping("S", type="segment_membership", segment_identify_by="name")),
    ({"from": "phone", "to": "Phone", "preserve_values": True, "sync_null_values": False},
     Mapping("Phone", "phone", preserve_values=True, sync_null_values=False)),
    ({"from": "t", "to": "T", "generate_field": True, "array_field": True, "field_type": "text", "lookup_object": ""},
     Mapping("T", "t", generate_field=True, array_field=True, field_type="text")),
])
def test_mapping(given, want):
    assert Mapping.from_config(given) == want


@pytest.mark.parametrize("bad", [
    {"to": "x"},
    {"to": "x", "type": "constant"},
    {"to": "x", "from": "a", "constant": "v"},  # a constant without its type
    {"to": "x", "type": "sync_metadata", "sync_metadata_key": "other"},
    {"to": "x", "type": "nope", "from": "a"},
    {"to": "x", "from": "a", "lookup_object": "o"},
    {"to": "x", "from": "a", "colour": "red"},
    {"from": "a"},
])
def test_mapping_refused(bad):
    with pytest.raises((SpecError, TypeError)):
        Mapping.from_config(bad)


def test_constant_text():
    assert [constant_text(v) for v in ("a", 1, 2.0, 2.5, True)] == ["a", "1", "2", "2.5", "true"]


def test_source_kinds():
    table = SourceSpec.from_config('{"connection_id": 1, "object": {"type": "table", "table_name": "users", '
                                   '"table_schema": "public", "table_catalog": "dev", "id": ""}}')
    assert table == SourceSpec("table", None, "users", "public", "dev")
    assert SourceSpec.from_config({"object": {"type": "dataset", "id": 5951}}) == SourceSpec("dataset", "5951")
    assert SourceSpec.from_config([{"object": [{"type": "model", "id": "21130"}]}]) == SourceSpec("model", "21130")
    segment = SourceSpec("dataset", "5951", segment_id="3060")
    assert SourceSpec.from_config({"object": {"type": "segment", "id": 3060, "dataset_id": 5951}}) == segment
    assert SourceSpec.from_config({"filter_segment_id": 3060, "object": {"type": "dataset", "id": "5951"}}) == segment
    cohort = SourceSpec.from_config({"object": {"type": "cohort", "id": 9, "dataset_id": 5951}})
    assert cohort == SourceSpec("dataset", "5951", cohort_id="9")
    unset = SourceSpec.from_config({"cohort_id": 0, "filter_segment_id": "", "object": {"type": "dataset", "id": 1}})
    assert unset == SourceSpec("dataset", "1")


def test_set_values():
    assert set_values({"a": "", "b": None, "cohort_id": 0, "zero": 0, "no": False, "x": "y"}) == {
        "zero": 0, "no": False, "x": "y"}
    assert set_values({"cohort_id": 7}) == {"cohort_id": 7}
    assert set_values({}) == {}


def test_sync_defaults():
    spec = SyncSpec.from_config(config())
    assert (spec.operation, spec.field_behavior, spec.field_order) == (
        "upsert", "specific_properties", "alphabetical_column_name")
    assert (spec.mirror_strategy, spec.historical_sync_operation) == ("sync_updates_and_deletes", "backfill_all_records")
    assert spec.keys == ["Email"] and spec.object == "Contact"


@pytest.mark.parametrize("bad", [
    {"operation": "merge"},
    {"field_mapping": [{"from": "a", "to": "A"}]},
    {"field_mapping": [KEY, {"from": "id", "to": "Id", "is_primary_identifier": True}]},
    {"field_mapping": [KEY, {"from": "id", "to": "Email"}]},
    {"high_water_mark_attribute": "updated_at"},
    {"sync_behavior_family": "activateEvents"},
    {"mirror_strategy": "burn"},
    {"source_attributes": {"object": {"type": "table"}}},
])
def test_sync_refused(bad):
    with pytest.raises(SpecError):
        SyncSpec.from_config(config(**bad))


def test_families():
    topic = {"object": {"type": "topic", "id": "t"}}
    live = config(source_attributes=topic, run_mode={"type": "live"})
    assert SyncSpec.from_config({**live, "sync_behavior_family": "activateEvents"}).run_mode == "live"
    SyncSpec.from_config({**live, "sync_behavior_family": "mapRecords", "source_type": "kafka"})
    with pytest.raises(SpecError):
        SyncSpec.from_config({**live, "sync_behavior_family": "mapRecords", "source_type": "materialize"})


def test_key_is_optional_where_the_object_is_replaced():
    plain = [{"from": "email", "to": "EMAIL"}]
    SyncSpec.from_config(config(field_mapping=plain, operation="mirror", mirror_strategy="upload_and_swap"))
    spec = SyncSpec.from_config(config(field_mapping=plain, operation="mirror",
                                       advanced_configuration='{"file_format": "Parquet", "csv_delimiter": ","}'))
    assert spec.exports_file and spec.advanced_configuration["csv_delimiter"] == ","


def test_schedules():
    assert ScheduleSpec.from_config({"frequency": "hourly", "minute": 0}) == ScheduleSpec("hourly")
    assert ScheduleSpec.from_config({"frequency": "daily", "hour": 8, "minute": 30, "day": ""}) == ScheduleSpec(
        "daily", None, 8, 30)
    assert ScheduleSpec.from_config({"frequency": "weekly", "day": "Monday", "hour": 24}).hour == 24
    for bad in ({"frequency": "manual"}, {"frequency": "weekly"}, {"frequency": "daily", "hour": 25},
                {"frequency": "hourly", "minute": 60}, {"frequency": "weekly", "day": "Mon"}):
        with pytest.raises(SpecError):
            ScheduleSpec.from_config(bad)
    spec = SyncSpec.from_config(config(run_mode={"type": "triggered", "triggers": {"schedule": {
        "frequency": "daily", "hour": 8}}}))
    assert spec.schedule == ScheduleSpec("daily", hour=8)


def test_alerts():
    assert AlertSpec.from_config({"type": "FailureAlertConfiguration"}) == AlertSpec(
        "FailureAlertConfiguration", "first_time", True)
    runtime = AlertSpec.from_config({
        "type": "RuntimeAlertConfiguration", "send_for": "every_time", "should_send_recovery": False,
        "options": {"threshold": "30", "unit": "hours", "start_type": "scheduled"}})
    assert (runtime.threshold, runtime.unit, runtime.start_type) == (30.0, "hours", "scheduled")
    assert not runtime.should_send_recovery
    for bad in (
        {"type": "Other"},
        {"type": "InvalidRecordPercentAlertConfiguration", "options": {}},
        {"type": "InvalidRecordPercentAlertConfiguration", "options": {"threshold": "half"}},
        {"type": "InvalidRecordPercentAlertConfiguration", "options": {"threshold": "101"}},
        {"type": "RecordCountDeviationAlertConfiguration", "options": {"threshold": "5", "record_type": "rows"}},
        {"type": "StatusAlertConfiguration", "options": {"status_name": "paused"}},
        {"type": "FailureAlertConfiguration", "send_for": "always"},
    ):
        with pytest.raises(SpecError):
            AlertSpec.from_config(bad)


def test_datasets_are_sql():
    with pytest.raises(SpecError):
        DatasetSpec("d", "select 1", type="python")


def test_all_properties():
    spec = SyncSpec.from_config(config(field_behavior="sync_all_properties", field_normalization="camel_case"))
    got = [(m.from_, m.to) for m in expand_mappings(["email", "first_name", "last_name", "zip"], spec)]
    assert got == [("email", "Email"), ("first_name", "FirstName"), ("last_name", "lastName"), ("zip", "zip")]
