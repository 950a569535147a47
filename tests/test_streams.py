"""Live syncs: late and repeated records, restarts, replays."""

from datetime import datetime

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from syncloom.operators.policies import WritePolicy
from syncloom.plans.spec import Mapping, SourceSpec, SyncSpec
from syncloom.sinks.objects import ObjectStore
from syncloom.sources.readers import read_topic
from syncloom.streaming.live import Folder, live_activate_events, live_map_records

SCHEMA = "k int, at int, v string, w string"

pytestmark = pytest.mark.usefixtures("few_partitions")


def spec(*mappings):
    return SyncSpec("live", SourceSpec("topic", id="t"), "Thing",
                    (Mapping("k", "k", is_primary_identifier=True), *(mappings or (Mapping("v", "v"),))),
                    run_mode="live", sync_behavior_family="mapRecords", source_type="kafka")


def test_batches_fold(spark, root):
    store, s = ObjectStore(spark, root), spec(Mapping("v", "v"), Mapping("w", "w", sync_null_values=False))
    batches = [
        [(1, 5, "a", "w1"), (1, 4, "old", "w0"), (2, 1, "b", None), (None, 1, "x", "x")],
        [(1, 3, "late", "late"), (2, 2, "c", None), (3, 1, "n", "z")],
        [(3, 2, "m", None), (2, 9, None, "y")],
    ]
    for n, data in enumerate(batches):
        for _ in range(2):  # every batch is replayed once, as after a restart
            Folder(s, store, ["at"], compact_after=2)(table(spark, SCHEMA, *data), n)
    got = rows(store.read("Thing", ["k"], {"w": WritePolicy(sync_nulls=False)}), "k", "v", "w")
    assert got == [(1, "a", "w1"), (2, None, "y"), (3, "m", "z")]
    runs = store.runs().filter("sync_id = 'live'").orderBy("seq").collect()
    assert [r.records_invalid for r in runs] == [1, 0, 0] and [r.source_record_count for r in runs] == [4, 3, 2]
    assert store.runs().filter("writes = 'base'").count() == 1


def test_one_start_folds_many_batches(spark, root):
    store, s = ObjectStore(spark, root), spec()
    store.create_object("Thing", table(spark, "k int, v string").schema, "made", datetime(2024, 1, 1))
    fold = Folder(s, store, ["at"], compact_after=2)
    for n in range(5):
        fold(table(spark, SCHEMA, (n % 2, n, f"v{n}", "")), n)
    assert rows(store.read("Thing", ["k"]), "k", "v") == [(0, "v4"), (1, "v3")]
    assert [r.writes for r in store.writes_since_base("Thing")] == ["base", "changes"]
    Folder(s, store, ["at"])(table(spark, SCHEMA, (1, 9, "again", "")), 5)
    assert rows(store.read("Thing", ["k"]), "k", "v") == [(0, "v4"), (1, "again")]


def test_restart_from_checkpoint(spark, root):
    store, s, path, checkpoint = ObjectStore(spark, root), spec(), f"{root}/in", f"{root}/cp"
    for data in ([(1, 1, "a", ""), (2, 1, "b", "")], [(1, 2, "c", ""), (3, 1, "d", "")]):
        table(spark, SCHEMA, *data).coalesce(1).write.mode("append").parquet(path)
        live_map_records(read_topic(spark, "parquet", {}, SCHEMA, path), s, store, ["at"], checkpoint).awaitTermination()
    assert rows(store.read("Thing", ["k"]), "k", "v") == [(1, "c"), (2, "b"), (3, "d")]
    assert store.runs().filter("sync_id = 'live'").count() == 2


def test_events_arrive_once(spark, root):
    events = SyncSpec("ev", SourceSpec("topic", id="t"), "Event", (Mapping("id", "id"), Mapping("kind", "kind")),
                      run_mode="live", sync_behavior_family="activateEvents", source_type="kafka")
    path, checkpoint, store = f"{root}/in", f"{root}/cp", ObjectStore(spark, f"{root}/out")
    # half of all rows are copies of one event
    df = spark.range(0, 2000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"), F.lit("k").alias("kind"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("ts"))
    for _ in range(2):
        df.repartition(4).write.mode("append").parquet(path)
        stream = read_topic(spark, "parquet", {"maxFilesPerTrigger": "3"}, df.schema, path)
        live_activate_events(stream, events, store, "id", "ts", checkpoint).awaitTermination()
    back = store.read("Event")
    assert back.count() == back.select("id").distinct().count() == 1001


def test_records_without_an_order_are_refused(spark, root, tmp_path):
    from syncloom.plans.run import SyncRunner
    from syncloom.plans.spec import SpecError
    from syncloom.sources.readers import Catalog, TopicSpec

    table(spark, SCHEMA, (1, 1, "zzz", ""), (1, 2, "aaa", "")).coalesce(1).write.parquet(f"{root}/topic")
    source = SyncSpec("live", SourceSpec("topic", id="t"), "Thing", spec().mappings, run_mode="live", sync_behavior_family="mapRecords", source_type="kafka")
    with pytest.raises(SpecError, match="order"):
        SyncRunner(spark, root, Catalog(topics={"t": TopicSpec("parquet", SCHEMA, f"{root}/topic")})).start(source, f"{root}/c0")
    runner = SyncRunner(spark, root, Catalog(topics={"t": TopicSpec("parquet", SCHEMA, f"{root}/topic", order=("at",))}))
    runner.start(source, f"{root}/c1").awaitTermination()
    assert rows(runner.store.read("Thing", ["k"]), "k", "v") == [(1, "aaa")]


def test_ids_of_days_are_folded_and_still_known(spark, root):
    from datetime import date

    from syncloom.streaming.live import Appender, tidy_event_ids

    s = SyncSpec("events", SourceSpec("topic", id="t"), "Event", (Mapping("k", "k"),), run_mode="live", sync_behavior_family="activateEvents", source_type="kafka")
    store = ObjectStore(spark, root)
    day = lambda k, d: (k, datetime(2024, 1, d))
    for n, some in enumerate([[day(1, 1), day(2, 1), day(3, 2)], [day(1, 1), day(4, 1), day(3, 3)]]):
        Appender(s, store, "k", "at")(table(spark, "k int, at timestamp", *some), n)
    tidy_event_ids(store, "events", date(2024, 1, 3))
    Appender(s, store, "k", "at")(table(spark, "k int, at timestamp", day(1, 1), day(4, 1), day(3, 2), day(5, 9)), 2)
    # an event is known by its id and day
    assert rows(store.read("Event"), "k") == [(1,), (2,), (3,), (3,), (4,), (5,)]
