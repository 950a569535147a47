"""Live syncs run over the events as a file stream, then read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from syncloom.operators.mapping import LookupObject
from syncloom.plans.run import SyncRunner
from syncloom.plans.spec import Mapping, SegmentSpec, SourceSpec, SyncSpec
from syncloom.session import scratch_path
from syncloom.sinks.objects import ObjectStore
from syncloom.sources.readers import Catalog, TopicSpec, read_topic
from syncloom.streaming.live import live_activate_events, live_map_records
from workload.fixtures import fixture, tables
from workload.registry import register

TOPIC = SourceSpec("topic", id="events")


def event_stream(spark, sf_dir, copies: int = 1, where: str = "true"):
    """The events table as a stream of files, each event in as many files as there are copies."""
    path = scratch_path(spark, "topic")
    events = tables(spark, sf_dir, "events").table("events").where(where)
    copied = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    copied.repartition(8).write.parquet(path)
    return read_topic(spark, "parquet", {"maxFilesPerTrigger": "3"}, events.schema, path)


@register("live_map_records", """
    select user_id, event_type as last_event, cast(value as varchar) as last_value
    from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
    where rn = 1""")
def live_map_records_query(spark, sf_dir):
    spec = SyncSpec(
        "users", TOPIC, "User",
        (Mapping("user_id", "user_id", is_primary_identifier=True), Mapping("last_event", "event_type"),
         Mapping("last_value", type="liquid_template", liquid_template="{{ value }}")),
        sync_behavior_family="mapRecords", run_mode="live", source_type="kafka",
    )
    store = ObjectStore(spark, scratch_path(spark, "live"))
    query = live_map_records(event_stream(spark, sf_dir), spec, store, ["ts", "event_id"],
                             scratch_path(spark, "live-checkpoint"), compact_after=2)
    query.awaitTermination()
    return store.read("User", ["user_id"])


@register("live_activate_events", """
    select event_id, user_id, upper(event_type) as name, 'web' as channel from events""")
def live_activate_events_query(spark, sf_dir):
    spec = SyncSpec(
        "activity", TOPIC, "Event",
        (Mapping("event_id", "event_id"), Mapping("user_id", "user_id"),
         Mapping("name", type="liquid_template", liquid_template="{{ event_type | upcase }}"),
         Mapping("channel", type="constant", constant="web")),
        sync_behavior_family="activateEvents", run_mode="live", source_type="kafka",
    )
    store = ObjectStore(spark, scratch_path(spark, "events"))
    query = live_activate_events(event_stream(spark, sf_dir, copies=2), spec, store, "event_id", "ts",
                                 scratch_path(spark, "events-checkpoint"))
    query.awaitTermination()
    return store.read("Event")


@register("live_restart", """
    select user_id, event_type as last_event from (
      select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def live_restart_query(spark, sf_dir):
    """Two streams with checkpoints of their own, over the same topic, fold into one object: nothing is lost."""
    spec = SyncSpec(
        "users", TOPIC, "User",
        (Mapping("user_id", "user_id", is_primary_identifier=True), Mapping("last_event", "event_type")),
        sync_behavior_family="mapRecords", run_mode="live", source_type="kafka",
    )
    store = ObjectStore(spark, scratch_path(spark, "live"))
    for half in ("ts < timestamp '2024-01-15'", "ts >= timestamp '2024-01-15'"):
        part = event_stream(spark, sf_dir, where=half)
        live_map_records(part, spec, store, ["ts", "event_id"], scratch_path(spark, "live-checkpoint")).awaitTermination()
    return store.read("User", ["user_id"])


class Dying(ObjectStore):
    """A store whose driver dies in place of the second commit, after the batch's ids and records are written."""

    commits = 0

    def record(self, **values):
        self.commits += 1
        if self.commits == 2:
            raise RuntimeError("the driver died")
        super().record(**values)


@register("live_events_restart", "select event_id, event_type as name from events")
def live_events_restart_query(spark, sf_dir):
    """A stream dies between a batch's ids and its commit; one with a new checkpoint over the same topic sends every event once."""
    spec = SyncSpec(
        "activity", TOPIC, "Event", (Mapping("event_id", "event_id"), Mapping("name", "event_type")),
        sync_behavior_family="activateEvents", run_mode="live", source_type="kafka",
    )
    root, stream = scratch_path(spark, "events"), event_stream(spark, sf_dir, copies=2)
    lost = live_activate_events(stream, spec, Dying(spark, root), "event_id", "ts", scratch_path(spark, "events-checkpoint"))
    try:
        lost.awaitTermination()
    except StreamingQueryException as error:
        if "the driver died" not in str(error):
            raise
    store = ObjectStore(spark, root)
    live_activate_events(stream, spec, store, "event_id", "ts", scratch_path(spark, "events-checkpoint")).awaitTermination()
    return store.read("Event")


@register("live_rejects", """
    select case when value < 50 then 'kept' when event_id % 10 = 0 then 'null_key' else 'bad_type:amount' end as outcome, count(*) as n
    from events group by all""")
def live_rejects_query(spark, sf_dir):
    """Events without an id or with a value that does not fit are kept as rejects: kept and rejected are all events."""
    spec = SyncSpec(
        "activity", TOPIC, "Event", (Mapping("event", "event"), Mapping("amount", "amount", field_type="number")),
        sync_behavior_family="activateEvents", run_mode="live", source_type="kafka",
    )
    store = ObjectStore(spark, scratch_path(spark, "events"))
    stream = event_stream(spark, sf_dir)
    fits = F.col("value") < 50
    nameless = ~fits & (F.col("event_id") % 10 == 0)
    stream = stream.select(
        "ts", F.when(~nameless, F.col("event_id")).alias("event"),
        F.when(fits | nameless, F.col("value").cast("string")).otherwise(F.lit("many")).alias("amount"),
    )
    live_activate_events(stream, spec, store, "event", "ts", scratch_path(spark, "events-checkpoint")).awaitTermination()
    kept = store.read("Event").select(F.lit("kept").alias("outcome"))
    runs = [r.run_id for r in store.runs().select("run_id").toLocalIterator()]
    rejected = spark.read.parquet(*[store.path("rejected", "activity", r) for r in runs]).select(F.col("reject_reason").alias("outcome"))
    return kept.unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("live_spec_lookup_segment", """
    select user_id, 'acct-' || cast(user_id as varchar) as account, case when event_type = 'purchase' then 'buyers' else '' end as segments
    from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
    join customer on c_custkey = user_id and c_acctbal >= 0 where rn = 1""")
def live_spec_lookup_segment(spark, sf_dir):
    """A live sync started from its definition, with a lookup (misses are rejected) and segments."""
    path = scratch_path(spark, "topic")
    events = tables(spark, sf_dir, "events").table("events")
    events.repartition(8).write.parquet(path)
    spec = SyncSpec(
        "users", TOPIC, "User",
        (Mapping("user_id", "user_id", is_primary_identifier=True),
         Mapping("account", "user_id", lookup_object="accounts", lookup_field="number"),
         Mapping("segments", type="segment_membership", segment_identify_by="name")),
        sync_behavior_family="mapRecords", run_mode="live", source_type="kafka",
    )
    runner = SyncRunner(
        spark, scratch_path(spark, "live"), Catalog(topics={"events": TopicSpec("parquet", events.schema, path)}),
        lookups={"accounts": LookupObject(fixture(spark, sf_dir, "accounts"))},
        segments=[SegmentSpec("buyers", "event_type = 'purchase'")],
    )
    runner.start(spec, scratch_path(spark, "live-checkpoint"), order=["ts", "event_id"]).awaitTermination()
    return runner.store.read("User", ["user_id"])


def message_topic(spark, sf_dir, value: str) -> str:
    """The events as messages of a topic that was written down: four partitions, offsets in the order of time."""
    path = scratch_path(spark, "messages")
    tables(spark, sf_dir, "events").sql(f"""
        select cast({value} as binary) as value, cast(user_id % 4 as int) as partition,
               row_number() over (partition by user_id % 4 order by ts, event_id) as offset from events
    """).repartition(8).write.parquet(path)
    return path


@register("live_default_order", """
    select user_id, event_type as last_event from (
      select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def live_default_order(spark, sf_dir):
    """A live sync started without an order: the messages' offsets order the records of a key."""
    path = message_topic(spark, sf_dir, "to_json(named_struct('user_id', user_id, 'event_type', event_type))")
    topic = TopicSpec("parquet", "user_id bigint, event_type string", path, {"maxFilesPerTrigger": "3"}, messages=True)
    runner = SyncRunner(spark, scratch_path(spark, "live"), Catalog(topics={"events": topic}))
    spec = SyncSpec(
        "users", TOPIC, "User", (Mapping("user_id", "user_id", is_primary_identifier=True), Mapping("last_event", "event_type")),
        sync_behavior_family="mapRecords", run_mode="live", source_type="kafka",
    )
    runner.start(spec, scratch_path(spark, "live-checkpoint")).awaitTermination()
    return runner.store.read("User", spec.keys)


@register("live_bad_messages", """
    select case when event_id % 7 < 2 then 'undecodable' else 'kept' end as outcome,
           case event_id % 7 when 0 then 'no json ' || cast(event_id as varchar)
                when 1 then '{"event_id":"x' || cast(event_id as varchar) || '"}' else cast(event_id as varchar) end as value
    from events""")
def live_bad_messages(spark, sf_dir):
    """Messages that are no JSON, or do not fit the records' schema, are rejects with their text."""
    path = message_topic(spark, sf_dir, """
        case event_id % 7 when 0 then concat('no json ', event_id) when 1 then concat('{"event_id":"x', event_id, '"}')
             else to_json(named_struct('event_id', event_id, 'ts', ts)) end""")
    topic = TopicSpec("parquet", "event_id bigint, ts timestamp", path, {"maxFilesPerTrigger": "3"}, messages=True)
    runner = SyncRunner(spark, scratch_path(spark, "events"), Catalog(topics={"events": topic}))
    spec = SyncSpec("activity", TOPIC, "Event", (Mapping("event_id", "event_id"),), sync_behavior_family="activateEvents", run_mode="live", source_type="kafka")
    runner.start(spec, scratch_path(spark, "events-checkpoint"), event_id="event_id", event_time="ts").awaitTermination()
    store = runner.store
    kept = store.read("Event").select(F.lit("kept").alias("outcome"), F.col("event_id").cast("string").alias("value"))
    runs = [r.run_id for r in store.runs().select("run_id").toLocalIterator()]
    rejected = spark.read.parquet(*[store.path("rejected", "activity", r) for r in runs])
    return kept.unionByName(rejected.select(F.col("reject_reason").alias("outcome"), F.col("rejected_value").alias("value")))
