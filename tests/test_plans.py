"""Physical plans: no Python in the data path, no cartesian products, pushed filters, pruned columns, few shuffles."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from syncloom.operators import changes as ch
from syncloom.operators.keys import duplicate_keys, split_by_key
from workload.fixtures import fixture, over_tables, tables
from workload.registry import QUERIES

STATELESS = [n for n in QUERIES if not n.startswith(("live_", "sync_", "sink_", "run_", "mirror_keeps", "append_fields", "src_formats"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", STATELESS)
def test_no_python_and_no_pairs(spark, sf_dir, name):
    p = plan(entry.queries()[name](spark, sf_dir))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", p)


def test_mark_reaches_the_scan(spark, sf_dir):
    p = plan(entry.queries()["op_append_hwm"](spark, sf_dir))
    assert "GreaterThan(ts,2024-01-25T00:00)" in p and "props" not in p and "Exchange" not in p


def test_segment_reaches_the_scan(spark, sf_dir):
    p = plan(entry.queries()["src_segment"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,250000.0)" in p and "EqualTo(o_orderstatus,O)" in p


def test_only_mapped_columns_are_read(spark, sf_dir):
    p = plan(entry.queries()["map_direct"](spark, sf_dir))
    read = re.search(r"ReadSchema: struct<([^>]*)", p).group(1)
    assert "o_orderpriority" not in read and "o_custkey" not in read


@pytest.mark.parametrize("name, shuffles", [
    ("op_diff", 2), ("op_upsert", 2), ("op_insert", 2), ("op_update", 2), ("op_append_diff", 2),
    ("op_mirror_deletes", 3), ("op_union_route", 3), ("op_full_sync", 2), ("map_direct", 0), ("validate_fields", 0)])
def test_one_shuffle_per_side(spark, sf_dir, shuffled, name, shuffles):
    assert plan(entry.queries()[name](spark, sf_dir)).count("Exchange hashpartitioning") == shuffles


def test_validated_sources_join_without_another_shuffle(spark, sf_dir, shuffled):
    valid, _ = split_by_key(over_tables(spark, sf_dir, "select l_orderkey as k, l_tax as v from lineitem"), ["k"])
    dst = over_tables(spark, sf_dir, "select o_orderkey as k, o_totalprice as v from orders")
    assert plan(ch.apply_upsert(valid, dst, ["k"])).count("Exchange hashpartitioning") == 2


def test_small_duplicate_tables_need_no_shuffle(spark, sf_dir, tmp_path):
    src = fixture(spark, sf_dir, "src_dirty")
    duplicate_keys(src, ["ext_id"]).write.parquet(str(tmp_path / "twice"))
    valid, rejected = split_by_key(src, ["ext_id"], spark.read.parquet(str(tmp_path / "twice")))
    assert "hashpartitioning" not in plan(valid) and "hashpartitioning" not in plan(rejected)


def test_counting_reads_no_columns(spark, sf_dir):
    assert "ReadSchema: struct<>" in plan(entry.queries()["dataset_profile"](spark, sf_dir))


def test_narrow_alerts_do_not_shuffle_history(spark, sf_dir, tmp_path):
    from syncloom.operators.alerts import evaluate
    from syncloom.plans.spec import AlertSpec

    fixture(spark, sf_dir, "runs").write.parquet(str(tmp_path / "runs"))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    alert = AlertSpec("FailureAlertConfiguration", "every_time", should_send_recovery=False)
    assert "Exchange" not in plan(evaluate(runs, alert))


def test_no_field_is_exchanged_to_find_changes(spark, sf_dir, shuffled):
    from syncloom.operators import changes as ch

    src, prev = fixture(spark, sf_dir, "src"), fixture(spark, sf_dir, "prev")
    state = ch.source_state(src, ch.snapshot(prev, ["ext_id"]), ["ext_id"])
    shown = [a.name() for a in _outputs(state)]
    assert set(shown) <= {"ext_id", "_fingerprint", "__was", "__s", "__p"}


def _outputs(df):
    """The columns of all exchanges of a plan."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName() == "Exchange":
            out += [node.output().apply(i) for i in range(node.output().size())]
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert out
    return out
