"""Laws and edge rows of change detection and operations."""

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from syncloom.operators import changes as ch
from syncloom.operators.fields import validate_fields
from syncloom.operators.keys import split_by_key
from syncloom.operators.mapping import LookupObject, project, resolve_lookup, with_membership
from syncloom.operators.policies import WritePolicy, policies_of
from syncloom.operators.runs import run_counters
from syncloom.plans.spec import Field, Mapping, SegmentSpec, SourceSpec, SpecError, SyncSpec
from workload.fixtures import fixture

KEYS = ["ext_id"]


@pytest.fixture
def sides(spark, sf_dir):
    return [fixture(spark, sf_dir, n) for n in ("src", "dst", "prev")]


def labels(df, column="change"):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_counts_add_up(sides):
    src, dst, _ = sides
    n = labels(ch.diff(src, dst, KEYS))
    assert n["insert"] + n["update"] + n["unchanged"] == src.count()
    assert n["delete"] + n["update"] + n["unchanged"] == dst.count()


@pytest.mark.parametrize("apply", [ch.apply_insert, ch.apply_update, ch.apply_upsert, ch.apply_mirror])
def test_a_second_time_changes_nothing(sides, apply):
    src, dst, _ = sides
    once = apply(src, dst, KEYS)
    assert rows(apply(src, once, KEYS), *once.columns) == rows(once)


def test_nothing_is_sent_twice(sides):
    src, _, _ = sides
    assert ch.changed_since(src, ch.snapshot(src, KEYS), KEYS).isEmpty()
    assert labels(ch.source_state(src, ch.snapshot(src, KEYS), KEYS), "_change") == {"unchanged": src.count()}


def test_upsert_then_mirror_is_mirror(sides):
    src, dst, prev = sides
    mirrored = ch.apply_mirror(src, dst, KEYS, prev)
    assert rows(ch.apply_mirror(src, ch.apply_upsert(src, dst, KEYS), KEYS, prev), *mirrored.columns) == rows(mirrored)


def test_swap_equals_mirror_on_own_rows(sides):
    src, _, prev = sides
    mirrored = ch.apply_mirror(src, prev, KEYS, prev)
    assert rows(mirrored, *src.columns) == rows(ch.apply_mirror(src, prev, KEYS, strategy="upload_and_swap"))


def test_state_agrees_with_its_parts(sides):
    src, _, prev = sides
    state = ch.source_state(src, ch.snapshot(prev, KEYS), KEYS)
    assert state.columns == ["ext_id", "_fingerprint", "_change"]
    sent = ch.of_keys(src, state.filter("_change in ('insert', 'update')"), KEYS)
    assert rows(sent, *src.columns) == rows(ch.changed_since(src, ch.snapshot(prev, KEYS), KEYS))
    assert rows(sent.filter("_change = 'insert'"), *src.columns) == rows(ch.new_records(src, prev, KEYS))
    assert rows(state.filter("_change = 'delete'"), "ext_id") == rows(ch.gone_since(src, prev, KEYS))
    kept = state.filter("_change <> 'delete'")
    assert rows(kept, "ext_id", "_fingerprint") == rows(ch.snapshot(src, KEYS), "ext_id", "_fingerprint")


def test_empty_sides(sides):
    src, dst, _ = sides
    nothing = src.filter(F.lit(False))
    assert rows(ch.apply_upsert(src, nothing, KEYS)) == rows(src)
    assert rows(ch.apply_upsert(nothing, dst, KEYS)) == rows(dst)
    assert ch.apply_update(src, nothing, KEYS).isEmpty()
    assert rows(ch.apply_mirror(nothing, src, KEYS, src)) == []


def test_unchanged_is_decided_after_policies(spark):
    src = table(spark, "k int, a string, b string", (1, "new", None), (2, "x", "y"))
    dst = table(spark, "k int, a string, b string", (1, "old", "kept"), (2, None, "y"))
    policies = {"a": WritePolicy(preserve=True), "b": WritePolicy(sync_nulls=False)}
    got = rows(ch.plan_changes(src, dst, ["k"], policies))
    assert got == [(1, "old", "kept", "unchanged"), (2, "x", "y", "update")]


def test_run_metadata_alone_is_no_update(spark):
    src = table(spark, "k int, a string, run string", (1, "x", "r2"), (2, "z", "r2"), (3, "n", "r2"))
    dst = table(spark, "k int, a string, run string", (1, "x", "r1"), (2, "y", "r1"))
    got = rows(ch.plan_changes(src, dst, ["k"], ignore=["run"]))
    assert got == [(1, "x", "r1", "unchanged"), (2, "z", "r2", "update"), (3, "n", "r2", "insert")]


def test_mirror_leaves_rows_it_does_not_own(spark):
    src, prev = table(spark, "k int, v int", (1, 1)), table(spark, "k int, v int", (1, 1), (2, 2))
    dst = table(spark, "k int, v int", (1, 0), (2, 2), (9, 9))
    assert rows(ch.apply_mirror(src, dst, ["k"], prev)) == [(1, 1), (9, 9)]
    assert rows(ch.apply_mirror(src, dst, ["k"])) == [(1, 1), (2, 2), (9, 9)]


def test_mark_ties_and_nulls(spark):
    src = table(spark, "k int, t int", (1, 5), (2, 6), (3, None), (4, 7))
    assert rows(ch.appended(src, mark_column="t", mark=6)) == [(4, 7)]
    assert rows(ch.appended(src, mark_column="t", mark=6, first_run=True)) == [(1, 5), (2, 6), (4, 7)]
    assert ch.appended(src, mark_column="t", mark=6, first_run=True, historical="skip_current_records").isEmpty()


def test_a_returning_key_is_new_again(spark):
    src, prev = table(spark, "k int", (1,), (2,)), table(spark, "k int", (2,))
    dst = table(spark, "k int", (1,), (2,))
    assert rows(ch.apply_append(src, dst, ["k"], previous=prev)) == [(1,), (1,), (2,)]


def test_composite_keys(spark):
    src = table(spark, "a int, b int, v string", (1, 1, "x"), (1, 2, "y"))
    dst = table(spark, "a int, b int, v string", (1, 1, "o"), (2, 1, "z"))
    assert rows(ch.apply_upsert(src, dst, ["a", "b"])) == [(1, 1, "x"), (1, 2, "y"), (2, 1, "z")]


def test_dotted_names_all_the_way(spark):
    src = table(spark, "id int, v string", (1, "n"), (2, "m"), (2, "m"), (None, "q"))
    spec = SyncSpec("s", SourceSpec("table", table="t"), "o", (
        Mapping("user.id", "id", is_primary_identifier=True), Mapping("user.v", "v", sync_null_values=False)))
    valid, rejected = split_by_key(project(src, spec), spec.keys)
    assert rows(valid) == [(1, "n")] and rejected.count() == 3
    out = ch.apply_upsert(valid, valid.withColumn("user.v", F.lit("old")), spec.keys, policies_of(spec.mappings))
    assert rows(out) == [(1, "n")]
    assert ch.changed_since(valid, ch.snapshot(valid, spec.keys), spec.keys).isEmpty()


def test_validate_fields_keeps_earlier_reasons(spark):
    df = table(spark, "k int, n string, reject_reason string, rejected_value string",
               (1, "5", None, None), (2, "x", None, None), (3, None, None, None), (4, "x", "lookup_miss:o", "raw"))
    got = rows(validate_fields(df, [Field("n", "number", required=True)]))
    assert got == [(1, 5.0, None, None), (2, None, "bad_type:n", "x"), (3, None, "missing_required:n", None),
                   (4, None, "lookup_miss:o", "raw")]


def test_arrays(spark):
    df = spark.sql("select 1 as k, array('1', 'x') as a, '3' as s union all select 2, array('4'), 'y' union all select 3, null, null")
    spec = SyncSpec("s", SourceSpec("table", table="t"), "o", (
        Mapping("k", "k", is_primary_identifier=True),
        Mapping("a", "a", generate_field=True, array_field=True, field_type="number"),
        Mapping("s", "s", generate_field=True, array_field=True, field_type="number")))
    got = {r.k: (r.a, r.s, r.reject_reason) for r in project(df, spec, keep_rejects=True).collect()}
    assert got == {1: ([1.0, None], [3.0], "bad_type:a"), 2: ([4.0], None, "bad_type:s"), 3: (None, None, None)}


def test_lookups(spark):
    objects = LookupObject(table(spark, "id int, code string", (5, "a"), (3, "a"), (9, "b"), (1, None)))
    df = table(spark, "k int, c string", (1, "a"), (2, "b"), (3, "zz"), (4, None))
    want = [(1, 3, None, None), (2, 9, None, None), (3, None, "lookup_miss:c", "zz"), (4, None, None, None)]
    for spread in (False, True):
        assert rows(resolve_lookup(df, "c", objects, "code", spread=spread), "k", "c", "reject_reason", "rejected_value") == want
    spec = SyncSpec("s", SourceSpec("table", table="t"), "o", (
        Mapping("k", "k", is_primary_identifier=True),
        Mapping("list", type="constant", constant="6600827417", lookup_object="user_list", lookup_field="id")))
    numbers = LookupObject(spark.sql("select 6600827417L as id"))
    assert rows(project(df, spec, lookups={"user_list": numbers}), "list") == [(6600827417,)] * 4
    none = LookupObject(spark.sql("select 1L as id"))
    assert {r.reject_reason for r in project(df, spec, lookups={"user_list": none}, keep_rejects=True).collect()} == {
        "lookup_miss:list"}
    with pytest.raises(SpecError):
        project(df, spec)


def test_two_lookups(spark):
    df = spark.range(0, 600, 1, 4).selectExpr("id as k", "if(id % 3 = 0, 1, id % 50) as a", "if(id % 3 = 1, 2, id % 70) as b")
    objects = {"as": LookupObject(spark.range(40).selectExpr("id * 10 as id", "id as n")),
               "bs": LookupObject(spark.range(60).selectExpr("id * 100 as id", "id as n"))}
    spec = SyncSpec("s", SourceSpec("table", table="t"), "o", (
        Mapping("k", "k", is_primary_identifier=True), Mapping("a", "a", lookup_object="as", lookup_field="n"),
        Mapping("b", "b", lookup_object="bs", lookup_field="n")))
    want = [(r.k, r.a * 10, r.b * 100) for r in df.collect() if r.a < 40 and r.b < 60]
    for spread in (False, True):
        got = project(df, spec, lookups=objects, spread=spread)
        assert rows(got, "k", "a", "b") == sorted(want, key=repr)


def test_membership(spark):
    df = table(spark, "k int, seg string", (1, ""), (2, ""))
    members = table(spark, "who int, name string", (1, "b"), (1, "a"), (1, "a"), (1, "b"), (3, "z"))
    assert rows(with_membership(df, "seg", "k", members, "who", "name")) == [(1, "a,b"), (2, "")]
    spec = SyncSpec("s", SourceSpec("table", table="t"), "o", (
        Mapping("k", "k", is_primary_identifier=True),
        Mapping("seg", type="segment_membership", segment_identify_by="name")))
    segments = [SegmentSpec("vip", "k > 1"), SegmentSpec("all", "k > 0"), SegmentSpec("odd", "seg = 'x'")]
    assert rows(project(df, spec, segments=segments)) == [(1, "all"), (2, "all,vip")]


def test_counters(spark):
    src = table(spark, "k int, v int", (1, 1), (2, 2), (3, 3), (4, 4), (4, 4), (None, 0))
    dst = table(spark, "k int, v int", (1, 1), (2, 0), (8, 8))
    valid, rejected = split_by_key(src, ["k"])
    gone = table(spark, "k int", (8,))
    row = run_counters(ch.plan_changes(valid, dst, ["k"], gone=gone), rejected).first().asDict()
    assert row == {"source_record_count": 6, "records_updates": 1, "records_deletes": 1, "records_invalid": 3,
                   "records_processed": 6, "records_updated": 1, "records_failed": 3}
