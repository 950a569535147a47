"""Whole runs: state between runs, commits, rejected records, first runs, exports."""

import pathlib
from datetime import datetime, timedelta

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from syncloom.operators.mapping import LookupObject
from syncloom.plans.run import Members, SyncRunner
from syncloom.plans.spec import DatasetSpec, Field, SegmentSpec, SpecError, SyncSpec
from syncloom.session import rereadable
from syncloom.sinks.files import export_file, render_path
from syncloom.sources.readers import Catalog

T0 = datetime(2024, 5, 1, 6)

pytestmark = pytest.mark.usefixtures("few_partitions")


class Bench:
    """A runner over a view that the test replaces between runs."""

    def __init__(self, spark, root, files=False, **kwargs):
        self.spark, self.n, self.files = spark, 0, f"{root}-source" if files else None
        catalog = Catalog(models={"m": DatasetSpec("model", "select * from people")})
        self.runner = SyncRunner(spark, root, catalog, clock=lambda: T0 + timedelta(days=self.n, hours=1), **kwargs)

    def run(self, spec, schema, *data, run_id=None, **kwargs):
        self.n += 1
        source = self.spark.createDataFrame(list(data), schema)
        if self.files:
            source.write.parquet(f"{self.files}/{self.n}")
            source = self.spark.read.parquet(f"{self.files}/{self.n}")
        source.createOrReplaceTempView("people")
        return self.runner.run(spec, run_id or f"run-{self.n}", T0 + timedelta(days=self.n), **kwargs)

    def state(self, spec):
        return rows(self.runner.store.read(spec.object, spec.keys))


def sync(mappings=({"from": "name", "to": "name"},), **options):
    return SyncSpec.from_config({
        "name": "s", "source_attributes": {"object": {"type": "model", "id": "m"}},
        "destination_attributes": {"object": "Person"},
        "field_mapping": [{"from": "id", "to": "id", "is_primary_identifier": True}, *mappings], **options})


PEOPLE = "id int, name string"


@pytest.fixture(params=[False, True], ids=["computed", "files"])
def files(request):
    """Sources that are written down first, and sources that are read again."""
    return request.param


def test_what_is_read_again(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    t = spark.read.parquet(path)
    small = spark.read.parquet(path).groupBy("id").count()
    assert rereadable(t) and rereadable(t.filter("id > 3").selectExpr("id + 1 as x"))
    assert rereadable(t.join(small, "id", "left"))
    assert not rereadable(t.withColumn("r", F.rand())) and not rereadable(small)
    assert not rereadable(spark.createDataFrame([(1,)], "id int"))


def test_mirror_over_three_runs(spark, root, files):
    b, spec = Bench(spark, root, files), sync(operation="mirror")
    assert b.run(spec, PEOPLE, (1, "a"), (2, "b")).counters["records_succeeded"] == 2
    second = b.run(spec, PEOPLE, (1, "a"), (3, "c"))
    assert b.state(spec) == [(1, "a"), (3, "c")]
    assert (second.counters["records_deletes"], second.counters["records_processed"]) == (1, 2)
    again = b.run(spec, PEOPLE, (1, "a"), (3, "c"))
    assert again.counters["records_processed"] == 0 and b.state(spec) == [(1, "a"), (3, "c")]
    assert b.run(spec, PEOPLE, (2, "z"), (3, "c")).counters["records_deletes"] == 1
    assert b.state(spec) == [(2, "z"), (3, "c")]


@pytest.mark.parametrize("operation, want", [
    ("upsert", [(1, "A"), (2, "b"), (3, "c")]), ("insert", [(1, "a"), (2, "b"), (3, "c")]),
    ("update", [(1, "A"), (2, "b")]), ("append", [(1, "a"), (2, "b"), (3, "c")])])
def test_operations(spark, root, operation, want):
    b = Bench(spark, root)
    b.run(sync(), PEOPLE, (1, "a"), (2, "b"))  # upsert fills the object
    spec = sync(operation=operation)
    b.run(spec, PEOPLE, (1, "A"), (3, "c"))
    assert b.state(spec) == want


def test_changes_and_appends_apply_in_order(spark, root):
    b = Bench(spark, root)
    b.run(sync(), PEOPLE, (1, "a"))
    b.run(sync(), PEOPLE, (1, "b"))
    log = sync(operation="append", name="log")
    b.run(log, PEOPLE, (1, "c"))
    assert b.state(log) == [(1, "b"), (1, "c")]  # appended after the change, so not covered by it


def test_a_committed_run_is_not_run_again(spark, root):
    b, spec = Bench(spark, root), sync()
    first = b.run(spec, PEOPLE, (1, "a"), run_id="r")
    repeat = b.run(spec, PEOPLE, (1, "other"), run_id="r")
    assert repeat == first and b.state(spec) == [(1, "a")]


def test_a_failed_run_leaves_the_object_and_can_be_repeated(spark, root):
    b, spec = Bench(spark, root), sync()
    b.run(spec, PEOPLE, (1, "a"))
    with pytest.raises(Exception):
        b.run(spec, "id int, other string", (1, "b"), run_id="r")
    assert b.state(spec) == [(1, "a")]
    failed = b.runner.store.runs().filter("status = 'failed'").first()
    assert failed.run_id == "r" and "name" in failed.error_message
    b.run(spec, PEOPLE, (1, "b"), run_id="r")
    assert b.state(spec) == [(1, "b")]


def test_rejected_records(spark, root, files):
    b = Bench(spark, root, files, fields=[Field("name", "text", required=True), Field("age", "number")])
    spec = sync([{"from": "name", "to": "name"}, {"from": "age", "to": "age"}])
    result = b.run(spec, "id int, name string, age string", (1, "a", "30"), (2, "b", "old"), (3, None, "4"),
                   (None, "n", "1"), (5, "x", "1"), (5, "y", "2"))
    assert b.state(spec) == [(30.0, 1, "a")]
    got = rows(b.runner.store.rejected("s", "run-1"), "id", "reject_reason", "rejected_value")
    assert got == [(2, "bad_type:age", "old"), (3, "missing_required:name", None), (5, "duplicate_key", None),
                   (5, "duplicate_key", None), (None, "null_key", None)]
    assert (result.counters["records_invalid"], result.counters["source_record_count"]) == (5, 6)


def test_append_by_mark(spark, root, files):
    b = Bench(spark, root, files)
    spec = sync([{"from": "at", "to": "at"}], operation="append", high_water_mark_attribute="at")
    schema = "id int, at int"
    assert b.run(spec, schema, (1, 10), (2, 20), (3, None)).high_water_mark == "20"
    assert b.run(spec, schema, (1, 10), (2, 20), (4, 20), (5, 30)).counters["records_succeeded"] == 1
    assert b.run(spec, schema, (1, 10)).high_water_mark == "30"
    assert b.state(spec) == [(10, 1), (20, 2), (30, 5)]
    full = b.run(spec, schema, (4, 20), (5, 30), force_full=True)
    assert full.counters["records_succeeded"] == 2 and len(b.state(spec)) == 5


def test_sources_without_usable_records(spark, root, files):
    b = Bench(spark, root, files)
    spec = sync(operation="mirror")
    none = b.run(spec, PEOPLE, (None, "a"), (None, "b"))
    assert (none.counters["source_record_count"], none.counters["records_invalid"]) == (2, 2) and b.state(spec) == []
    assert b.run(spec, PEOPLE).counters == dict.fromkeys(none.counters, 0)
    assert b.run(spec, PEOPLE, (1, "a")).counters["records_succeeded"] == 1
    gone = b.run(spec, PEOPLE)
    assert gone.counters["records_deletes"] == 1 and b.state(spec) == []
    swap = sync(operation="mirror", mirror_strategy="upload_and_swap", name="swap", field_mapping=[{"from": "id", "to": "id"}])
    assert b.run(swap, PEOPLE, (1, "a"), (1, "b")).counters["source_record_count"] == 2
    assert b.run(swap, PEOPLE).counters["source_record_count"] == 0


def test_append_may_skip_what_is_there(spark, root):
    for n, mark in enumerate(({}, {"high_water_mark_attribute": "at"})):
        b = Bench(spark, f"{root}-{n}")
        spec = sync([{"from": "at", "to": "at"}], operation="append",
                    historical_sync_operation="skip_current_records", **mark)
        assert b.run(spec, "id int, at int", (1, 10), (2, 20)).counters["records_succeeded"] == 0
        assert b.state(spec) == []
        b.run(spec, "id int, at int", (1, 10), (2, 20), (3, 30))
        assert b.state(spec) == [(30, 3)]


def test_full_sync_sends_everything_and_repairs(spark, root):
    b, spec = Bench(spark, root), sync()
    b.run(spec, PEOPLE, (1, "a"), (2, "b"))
    other = sync(name="other")
    b.run(other, PEOPLE, (1, "edited elsewhere"))
    b.run(spec, PEOPLE, (1, "a"), (2, "b"))
    assert b.state(spec) == [(1, "edited elsewhere"), (2, "b")]  # the source did not change
    b.run(spec, PEOPLE, (1, "a"), (2, "b"), force_full=True)
    assert b.state(spec) == [(1, "a"), (2, "b")]
    assert [r.full_sync for r in b.runner.store.runs().orderBy("seq").collect()] == [False, False, False, True]


def test_mirror_strategies(spark, root):
    b = Bench(spark, root)
    nulls = sync([{"from": "name", "to": "name", "sync_null_values": False}], operation="mirror",
                 mirror_strategy="sync_updates_and_nulls")
    b.run(nulls, PEOPLE, (1, "a"), (2, "b"))
    b.run(nulls, PEOPLE, (1, None))
    assert b.state(nulls) == [(1, None), (2, "b")]
    swap = sync(operation="mirror", mirror_strategy="upload_and_swap")
    b.run(swap, PEOPLE, (7, "z"))
    assert b.state(swap) == [(7, "z")]


def test_metadata_moves_with_changes_only(spark, root):
    b = Bench(spark, root)
    spec = sync([{"from": "name", "to": "name"}, {"to": "run", "type": "sync_metadata", "sync_metadata_key": "sync_run_id"}])
    b.run(spec, PEOPLE, (1, "a"), (2, "b"))
    b.run(spec, PEOPLE, (1, "a"), (2, "c"))
    assert b.state(spec) == [(1, "a", "run-1"), (2, "c", "run-2")]


def test_lookup_segments_and_nested_fields(spark, root):
    members = Members(table(spark, "who int, seg string", (1, "vip"), (1, "new"), (1, "vip")), "who", "seg")
    lookups = {"teams": LookupObject(table(spark, "id int, code string", (11, "red"), (12, "blue")))}
    b = Bench(spark, root, members=members, lookups=lookups)
    spec = sync([{"from": "team", "to": "details.team", "lookup_object": "teams", "lookup_field": "code"},
                 {"to": "details.segments", "type": "segment_membership", "segment_identify_by": "name"}])
    b.run(spec, "id int, team string", (1, "red"), (2, "blue"), (3, "green"))
    stored = spark.read.parquet(b.runner.store.place("Person", "s", "run-1"))
    assert rows(stored.select("id", F.col("details.team").alias("t"), F.col("details.segments").alias("s"))) == [
        (1, 11, "new,vip"), (2, 12, "")]
    assert rows(b.runner.store.rejected("s", "run-1"), "id", "reject_reason") == [(3, "lookup_miss:details.team")]
    b.run(spec, "id int, team string", (1, "blue"), (2, "blue"))
    assert sorted(r.asDict()["details.team"] for r in b.runner.store.read("Person", ["id"]).collect()) == [12, 12]


def test_segment_membership_needs_segments(spark, root):
    spec = sync([{"to": "seg", "type": "segment_membership", "segment_identify_by": "name"}])
    with pytest.raises(SpecError):
        Bench(spark, root).run(spec, PEOPLE, (1, "a"))
    b = Bench(spark, root, segments=[SegmentSpec("named", "name is not null")])
    b.run(spec, PEOPLE, (1, "a"), (2, None))
    assert b.state(spec) == [(1, "named"), (2, "")]


def test_fields_come_and_change_type(spark, root):
    b = Bench(spark, root)
    b.run(sync(), PEOPLE, (1, "a"), (2, "b"))
    grown = sync([{"from": "name", "to": "name"},
                  {"from": "size", "to": "size", "generate_field": True, "follow_source_type": True}])
    b.run(grown, "id int, name string, size string", (1, "a", "10"))
    assert rows(b.runner.store.read("Person", ["id"]), "id", "name", "size") == [(1, "a", "10"), (2, "b", None)]
    b.run(grown, "id int, name string, size int", (1, "a", 10), (3, "c", 7))
    now = b.runner.store.read("Person", ["id"])
    assert dict(now.dtypes)["size"] == "int"
    assert rows(now, "id", "name", "size") == [(1, "a", 10), (2, "b", None), (3, "c", 7)]


def test_compaction_keeps_the_object(spark, root):
    b, spec = Bench(spark, root, compact_after=2), sync(operation="mirror")
    for data in ([(1, "a"), (2, "b")], [(1, "x"), (2, "b")], [(2, "c")], [(2, "c"), (4, "d")]):
        b.run(spec, PEOPLE, *data)
    assert b.state(spec) == [(2, "c"), (4, "d")]
    # a base has the number of the last change it holds
    kinds = [r.writes for r in b.runner.store.runs().orderBy("seq", F.desc("writes")).collect()]
    assert kinds == ["base", "changes", "changes", "base", "changes"]


def test_tidy_history(spark, root):
    b, spec = Bench(spark, root), sync(operation="mirror")
    for data in ([(1, "a")], [(1, "b")], [(1, "c")]):
        b.run(spec, PEOPLE, *data)
    before = rows(b.runner.store.runs())
    for _ in range(2):
        b.runner.store.tidy_history((T0 + timedelta(days=3)).date())
        assert rows(b.runner.store.runs()) == before
    b.run(spec, PEOPLE, (2, "d"))
    assert b.state(spec) == [(2, "d")]


def test_nothing_temporary_is_left(spark, root):
    b, spec = Bench(spark, root, compact_after=1), sync(operation="mirror")
    for data in ([(1, "a"), (2, "b")], [(1, "b")], [(1, "c")]):
        b.run(spec, PEOPLE, *data)
    left = {p.name: sorted(c.name for c in p.glob("*/*")) for p in pathlib.Path(root).iterdir()}
    assert left["state"] == ["run-3"] and not left["staging"] and not left["duplicates"]
    b.runner.store.vacuum("Person")
    assert [p.name for p in pathlib.Path(root, "objects", "Person").glob("*/*")] == ["s-run-3-base"]
    assert b.state(spec) == [(1, "c")]


def test_uncommitted_writes_are_not_read(spark, root):
    b, spec = Bench(spark, root), sync()
    b.run(spec, PEOPLE, (1, "a"))
    b.runner.store.write("Person", "s", "lost", table(spark, PEOPLE, (9, "ghost")))
    assert b.state(spec) == [(1, "a")]


def test_sync_all_properties(spark, root):
    b = Bench(spark, root)
    spec = sync([], field_behavior="sync_all_properties", field_normalization="start_case")
    b.run(spec, "id int, first_name string", (1, "a"))
    assert b.runner.store.read("Person", ["id"]).columns == ["First Name", "id"]


def test_file_export(spark, root, files):
    b = Bench(spark, root, files)
    spec = SyncSpec.from_config({
        "name": "export", "source_attributes": {"object": {"type": "model", "id": "m"}},
        "destination_object": "path_to_file/data_%m-%d-%y.parquet", "operation": "mirror",
        "field_behavior": "sync_all_properties", "field_normalization": "match_source_names",
        "field_mapping": [{"from": "name", "to": "NAME"}],
        "advanced_configuration": '{"file_format": "Parquet", "csv_delimiter": ",", "csv_include_header": true}'})
    result = b.run(spec, PEOPLE, (1, "a"), (1, "a"))
    assert result.counters["records_succeeded"] == 2
    assert rows(spark.read.parquet(f"{root}/path_to_file/data_05-02-24.parquet"), "NAME", "id") == [("a", 1), ("a", 1)]


def test_csv_export(spark, root):
    df = table(spark, PEOPLE, (1, "a;b"), (2, None))
    path = export_file(df, "x_%Y.csv", {"file_format": "CSV", "csv_delimiter": ";", "csv_include_header": "false"}, T0, root)
    assert path.endswith("/x_2024.csv")
    assert rows(spark.read.schema(PEOPLE).option("sep", ";").csv(path)) == [(1, "a;b"), (2, None)]
    with pytest.raises(SpecError):
        export_file(df, "x", {"file_format": "XLSX"}, T0, root)
    assert render_path("a/%m-%d-%y/%H", T0) == "a/05-01-24/06"


def test_union_of_two_objects(spark, root):
    b = Bench(spark, root, unions={"Person": ("Lead", "Contact")})
    b.run(sync(destination_attributes={"object": "Lead"}, name="leads"), PEOPLE, (1, "lead"), (2, "both"))
    b.run(sync(destination_attributes={"object": "Contact"}, name="contacts"), PEOPLE, (2, "both"), (3, "contact"))
    spec = sync(destination_attributes={"object": "Person", "lead_union_insert_to": "Contact"})
    result = b.run(spec, PEOPLE, (1, "A"), (2, "B"), (3, "C"), (4, "D"))
    assert (result.counters["records_updates"], result.counters["records_succeeded"]) == (3, 4)
    assert rows(b.runner.store.read("Lead", ["id"])) == [(1, "A"), (2, "B")]
    assert rows(b.runner.store.read("Contact", ["id"])) == [(2, "both"), (3, "C"), (4, "D")]
    again = b.run(spec, PEOPLE, (1, "A"), (2, "B"), (3, "C"), (4, "E"))
    assert again.counters["records_updates"] == 1
    assert rows(b.runner.store.read("Contact", ["id"])) == [(2, "both"), (3, "C"), (4, "E")]
    with pytest.raises(SpecError):
        b.run(sync(operation="mirror"), PEOPLE, (1, "A"))


def test_alerts_and_missed_runs_of_a_sync(spark, root):
    b = Bench(spark, root)
    spec = sync(
        alert=[{"type": "FailureAlertConfiguration"},
               {"type": "InvalidRecordPercentAlertConfiguration", "options": {"threshold": "40"}}],
        run_mode={"type": "triggered", "triggers": {"schedule": {"frequency": "daily", "hour": 6}}})
    b.run(spec, PEOPLE, (1, "a"), (None, "b"), (None, "c"))
    with pytest.raises(Exception):
        b.run(spec, "id int, other string", (1, "b"))
    b.n += 1
    b.run(spec, PEOPLE, (1, "b"))
    got = rows(b.runner.notifications(spec), "run_id", "alert", "kind")
    assert got == [("run-1", "InvalidRecordPercentAlertConfiguration", "violation"),
                   ("run-2", "FailureAlertConfiguration", "violation"),
                   ("run-2", "InvalidRecordPercentAlertConfiguration", "recovery"),
                   ("run-4", "FailureAlertConfiguration", "recovery")]
    assert rows(b.runner.missed(spec, T0, T0 + timedelta(days=5)), "slot") == [(T0,), (T0 + timedelta(days=3),)]


def test_a_crash_between_union_parts_loses_nothing(spark, root):
    unions = {"Both": ("Lead", "Contact")}
    b, spec = Bench(spark, root, unions=unions), sync(destination_attributes={"object": "Both"}, operation="upsert")
    commit, crashed = b.runner.store.commit, []

    def once(rows):
        if not crashed and any(r.get("status") == "completed" for r in rows):
            crashed.append(True)
            raise OSError("lost")
        commit(rows)

    b.runner.store.commit = once
    with pytest.raises(OSError):
        b.run(spec, PEOPLE, (1, "a"), (2, "b"), run_id="again")
    assert b.runner.store.read("Lead", ["id"]) is None
    done = b.run(spec, PEOPLE, (1, "a"), (2, "b"), run_id="again")
    assert done.counters["records_processed"] == 2 and rows(b.runner.store.read("Lead", ["id"])) == [(1, "a"), (2, "b")]


def test_long_errors_are_kept_whole(spark, root):
    b = Bench(spark, root)
    with pytest.raises(Exception) as error:
        b.run(sync(mappings=({"from": "x" * 3000, "to": "name"},), operation="upsert"), PEOPLE, (1, "a"))
    assert b.runner.store.runs().filter("status = 'failed'").first().error_message == str(error.value)


def test_marks_do_not_depend_on_the_time_zone(spark, root):
    b, spec = Bench(spark, root), sync(mappings=({"from": "at", "to": "at"},), operation="append", high_water_mark_attribute="at")
    late = "timestamp '2024-11-03 06:30:00+00:00'"  # the repeated hour in New York
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for n in range(2):
            b.n += 1
            spark.range(1).selectExpr("cast(1 as int) as id", f"{late} as at").createOrReplaceTempView("people")
            b.runner.run(spec, f"run-{n}", T0 + timedelta(days=n))
        assert b.runner.store.read("Person").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
