"""Queries over change detection and the operations that write a destination."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from syncloom.operators import changes as ch
from syncloom.operators.mapping import project
from syncloom.operators.policies import WritePolicy, policies_of
from syncloom.operators.runs import run_counters
from syncloom.operators.keys import split_by_key
from syncloom.plans.run import SyncRunner
from syncloom.plans.spec import DatasetSpec, SyncSpec
from syncloom.session import scratch_path
from syncloom.sources.readers import Catalog
from workload.fixtures import FIXTURES, fixture, over_tables, tables, with_fixtures
from workload.registry import register

KEYS = ["ext_id"]
FIELDS = ["customer_id", "status", "amount", "priority"]
ALL = "ext_id, customer_id, status, amount, priority"


def sides(spark, sf_dir, *names):
    return [fixture(spark, sf_dir, n) for n in names]


@register("op_insert", with_fixtures("src dst", f"""select {ALL} from dst
    union all select {ALL} from src where ext_id not in (select ext_id from dst)"""))
def op_insert(spark, sf_dir):
    return ch.apply_insert(*sides(spark, sf_dir, "src", "dst"), KEYS)


@register("op_update", with_fixtures("src dst", f"""select {ALL} from src where ext_id in (select ext_id from dst)
    union all select {ALL} from dst where ext_id not in (select ext_id from src)"""))
def op_update(spark, sf_dir):
    return ch.apply_update(*sides(spark, sf_dir, "src", "dst"), KEYS)


UPSERTED = with_fixtures("src dst", f"""select {ALL} from src
    union all select {ALL} from dst where ext_id not in (select ext_id from src)""")


@register("op_upsert", UPSERTED)
def op_upsert(spark, sf_dir):
    return ch.apply_upsert(*sides(spark, sf_dir, "src", "dst"), KEYS)


@register("op_append_diff", with_fixtures("src dst prev", f"""select {ALL} from dst
    union all select {ALL} from src where ext_id not in (select ext_id from prev)"""))
def op_append_diff(spark, sf_dir):
    src, dst, prev = sides(spark, sf_dir, "src", "dst", "prev")
    return ch.apply_append(src, dst, KEYS, previous=prev)


@register(
    "op_append_hwm",
    """select event_id, user_id, event_type, cast(ts as varchar) as ts from events
       where ts > timestamp '2024-01-25 00:00:00'""",
)
def op_append_hwm(spark, sf_dir):
    events = tables(spark, sf_dir, "events").table("events").select("event_id", "user_id", "event_type", "ts")
    new = ch.appended(events, mark_column="ts", mark="2024-01-25 00:00:00")
    return new.withColumn("ts", F.col("ts").cast("string"))


@register("op_append_first_skip", with_fixtures("book", f"select {ALL} from book"))
def op_append_first_skip(spark, sf_dir):
    src, dst = sides(spark, sf_dir, "src", "book")
    return ch.apply_append(src, dst, KEYS, first_run=True, historical="skip_current_records")


@register("op_append_first_backfill",
          with_fixtures("src dst", f"select {ALL} from dst union all select {ALL} from src"))
def op_append_first_backfill(spark, sf_dir):
    src, dst = sides(spark, sf_dir, "src", "dst")
    return ch.apply_append(src, dst, KEYS, first_run=True, historical="backfill_all_records")


MIRRORED = with_fixtures("src dst prev", f"""select {ALL} from src
    union all select {ALL} from dst
    where ext_id not in (select ext_id from src) and ext_id not in (select ext_id from prev)""")


@register("op_mirror_deletes", MIRRORED)
def op_mirror_deletes(spark, sf_dir):
    src, dst, prev = sides(spark, sf_dir, "src", "dst", "prev")
    return ch.apply_mirror(src, dst, KEYS, previous=prev)


@register("op_mirror_nulls", UPSERTED)
def op_mirror_nulls(spark, sf_dir):
    src, dst, prev = sides(spark, sf_dir, "src", "dst", "prev")
    skip = {"priority": WritePolicy(sync_nulls=False)}  # overruled by the strategy
    return ch.apply_mirror(src, dst, KEYS, prev, "sync_updates_and_nulls", skip)


@register("op_mirror_swap", with_fixtures("book", f"select {ALL} from book"))
def op_mirror_swap(spark, sf_dir):
    src, dst = sides(spark, sf_dir, "book", "dst")
    return ch.apply_mirror(src, dst, KEYS, strategy="upload_and_swap")


@register("op_diff", with_fixtures("src dst", """
    select coalesce(s.ext_id, d.ext_id) as ext_id,
           case when d.ext_id is null then 'insert' when s.ext_id is null then 'delete'
                when s.customer_id is distinct from d.customer_id or s.status is distinct from d.status
                  or s.amount is distinct from d.amount or s.priority is distinct from d.priority then 'update'
                else 'unchanged' end as change,
           d.status as status_before, s.status as status_after, d.amount as amount_before, s.amount as amount_after,
           d.priority as priority_before, s.priority as priority_after
    from src s full join dst d on s.ext_id = d.ext_id"""))
def op_diff(spark, sf_dir):
    labelled = ch.diff(*sides(spark, sf_dir, "src", "dst"), KEYS)
    shown = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in FIELDS[1:] for side in ("before", "after")]
    return labelled.select("ext_id", "change", *shown)


@register("op_preserve", with_fixtures("src dst", """
    select coalesce(s.ext_id, d.ext_id) as ext_id,
           case when s.ext_id is null then d.amount else s.amount end as amount,
           coalesce(d.priority, s.priority) as priority
    from src s full join dst d on s.ext_id = d.ext_id"""))
def op_preserve(spark, sf_dir):
    src, dst = [df.select("ext_id", "amount", "priority") for df in sides(spark, sf_dir, "src", "dst")]
    return ch.apply_upsert(src, dst, KEYS, {"priority": WritePolicy(preserve=True, sync_nulls=False)})


@register("op_skip_nulls", with_fixtures("src dst", """
    select coalesce(s.ext_id, d.ext_id) as ext_id,
           case when s.ext_id is null then d.amount else s.amount end as amount,
           coalesce(s.priority, d.priority) as priority
    from src s full join dst d on s.ext_id = d.ext_id"""))
def op_skip_nulls(spark, sf_dir):
    src, dst = [df.select("ext_id", "amount", "priority") for df in sides(spark, sf_dir, "src", "dst")]
    return ch.apply_upsert(src, dst, KEYS, {"priority": WritePolicy(sync_nulls=False)})


@register("op_full_sync", with_fixtures("src prev", """
    select 'full' as mode, ext_id, amount from src
    union all
    select 'incremental', s.ext_id, s.amount from src s left join prev p on s.ext_id = p.ext_id
    where p.ext_id is null or s.customer_id is distinct from p.customer_id or s.status is distinct from p.status
       or s.amount is distinct from p.amount or s.priority is distinct from p.priority"""))
def op_full_sync(spark, sf_dir):
    """What an incremental run sends, beside what a full sync sends."""
    src, prev = sides(spark, sf_dir, "src", "prev")
    sent = ch.changed_since(src, ch.snapshot(prev, KEYS), KEYS)
    shown = ["mode", "ext_id", "amount"]
    full, part = src.withColumn("mode", F.lit("full")), sent.withColumn("mode", F.lit("incremental"))
    return full.select(*shown).unionByName(part.select(*shown))


@register("op_union_route", with_fixtures("src leads contacts", """
    select s.ext_id, s.status, case when l.ext_id is not null then 'Lead' when c.ext_id is not null then 'Contact'
                                    else 'Contact' end as route,
           case when l.ext_id is null and c.ext_id is null then 'insert' else 'update' end as action
    from src s left join leads l on s.ext_id = l.ext_id left join contacts c on s.ext_id = c.ext_id"""))
def op_union_route(spark, sf_dir):
    src, leads, contacts = sides(spark, sf_dir, "src", "leads", "contacts")
    return ch.route_union(src.select("ext_id", "status"), leads, contacts, KEYS, "Contact", ("Lead", "Contact"))


@register("sync_upsert", with_fixtures("src_dirty delivered", """
    select coalesce(s.ext_id, d."External_Id") as "External_Id", coalesce(d."Quantity", s.quantity) as "Quantity",
           case when s.ext_id is null then d."Origin" else 'warehouse' end as "Origin", s.supplier as "Supplier_Hash",
           s.label as "Label"
    from (select ext_id, any_value(quantity) as quantity, any_value(sha256(cast(supplier_id as varchar))) as supplier,
                 any_value('PART ' || cast(part_id as varchar)) as label
          from src_dirty where ext_id is not null group by ext_id having count(*) = 1) s
    full join delivered d on s.ext_id = d."External_Id" """))
def sync_upsert(spark, sf_dir):
    """Shipments mapped, validated and upserted into their object: the whole path of a sync as one query."""
    spec = SyncSpec.from_config({
        "name": "shipments",
        "source_attributes": {"object": {"type": "table", "table_name": "lineitem"}},
        "destination_attributes": {"object": "Shipment"},
        "field_mapping": [
            {"from": "ext_id", "to": "External_Id", "is_primary_identifier": True},
            {"from": "quantity", "to": "Quantity", "preserve_values": True},
            {"to": "Origin", "type": "constant", "constant": "warehouse"},
            {"from": "supplier_id", "to": "Supplier_Hash", "type": "hash", "generate_field": True},
            {"to": "Label", "type": "liquid_template", "liquid_template": "PART {{ part_id }}", "generate_field": True},
        ],
    })
    mapped = project(fixture(spark, sf_dir, "src_dirty"), spec)
    valid, _ = split_by_key(mapped, spec.keys)
    dst = ch.evolve(fixture(spark, sf_dir, "delivered"), valid, spec.mappings)
    return ch.apply_upsert(valid, dst, spec.keys, policies_of(spec.mappings))


# ---- whole runs: two syncs of the same object, the second with what changed since the first

COUNTED = """
    select count(*) as source_record_count,
           sum(case when kind = 'update' then 1 else 0 end)::bigint as records_updates,
           sum(case when kind = 'delete' then 1 else 0 end)::bigint as records_deletes,
           sum(case when kind = 'invalid' then 1 else 0 end)::bigint as records_invalid,
           sum(case when kind in ('insert', 'update', 'delete', 'invalid') then 1 else 0 end)::bigint
               as records_processed,
           sum(case when kind = 'update' then 1 else 0 end)::bigint as records_updated,
           sum(case when kind = 'invalid' then 1 else 0 end)::bigint as records_failed from labelled"""

LINES = """
    select l_orderkey as ext_id, l_quantity as quantity, l_extendedprice as price from lineitem"""


@register("run_counters", f"""
    with src as ({LINES}),
    one as (select ext_id, any_value(quantity) as quantity, any_value(price) as price from src
            group by ext_id having count(*) = 1),
    dst as (select o_orderkey as ext_id, o_totalprice as price from orders),
    labels as (
        select case when d.ext_id is null then 'insert' when s.ext_id is null then 'kept'
                    when s.price is distinct from d.price then 'update' else 'unchanged' end as kind
        from one s full join dst d on s.ext_id = d.ext_id
        union all
        select 'invalid' from src where ext_id not in (select ext_id from one)),
    labelled as (select kind from labels where kind <> 'kept')
    {COUNTED}""")
def run_counters_query(spark, sf_dir):
    lines = over_tables(spark, sf_dir, LINES).select("ext_id", "price")
    orders = over_tables(spark, sf_dir, "select o_orderkey as ext_id, o_totalprice as price from orders")
    valid, rejected = split_by_key(lines, KEYS)
    return run_counters(ch.plan_changes(valid, orders, KEYS), rejected)


START = datetime(2024, 3, 1, 6, 0)


def mirror_spec(dataset: str, **options) -> SyncSpec:
    return SyncSpec.from_config({
        "name": "orders-to-crm",
        "source_attributes": {"connection_id": 1, "object": {"type": "dataset", "id": dataset}},
        "destination_attributes": {"connection_id": 2, "object": "Order"},
        "field_mapping": [
            {"from": "ext_id", "to": "ext_id", "is_primary_identifier": True},
            {"from": "customer_id", "to": "customer_id"},
            {"from": "status", "to": "status"},
            {"from": "amount", "to": "amount"},
            {"from": "priority", "to": "priority"},
            {"to": "last_run", "type": "sync_metadata", "sync_metadata_key": "sync_run_id"},
        ],
        "operation": "mirror",
        **options,
    })


def two_runs(spark, sf_dir, **options) -> SyncRunner:
    tables(spark, sf_dir, "orders")
    catalog = Catalog(datasets={n: DatasetSpec(f"orders_{n}", FIXTURES[n]) for n in ("prev", "src")})
    runner = SyncRunner(spark, scratch_path(spark, "two-runs"), catalog, clock=lambda: START + timedelta(hours=1))
    runner.run(mirror_spec("prev", **options), "run-1", START)
    runner.run(mirror_spec("src", **options), "run-2", START + timedelta(days=1))
    return runner


@register("sync_two_runs", with_fixtures("src prev", f"""
    select s.ext_id, s.customer_id, s.status, s.amount, s.priority,
           case when p.ext_id is not null and s.status is not distinct from p.status
                 and s.amount is not distinct from p.amount and s.priority is not distinct from p.priority
                then 'run-1' else 'run-2' end as last_run
    from src s left join prev p on s.ext_id = p.ext_id"""))
def sync_two_runs(spark, sf_dir):
    """A mirror run twice through the engine: staged, validated, diffed, written, committed and read back."""
    return two_runs(spark, sf_dir).store.read("Order", KEYS)


@register("run_record", with_fixtures("src prev", """
    select 'run-1' as run_id, 'orders-to-crm' as sync_id, 'completed' as status,
           (select count(*) from prev) as source_record_count, 0::bigint as records_updates,
           0::bigint as records_deletes, (select count(*) from prev) as records_processed,
           (select count(*) from prev) as records_succeeded, 0::bigint as records_failed
    union all
    select 'run-2', 'orders-to-crm', 'completed', (select count(*) from src), u.n, d.n, i.n + u.n + d.n,
           i.n + u.n + d.n, 0::bigint
    from (select count(*) as n from src where ext_id not in (select ext_id from prev)) i,
         (select count(*) as n from prev where ext_id not in (select ext_id from src)) d,
         (select count(*) as n from src s join prev p on s.ext_id = p.ext_id
          where s.status is distinct from p.status or s.amount is distinct from p.amount
             or s.priority is distinct from p.priority) u"""))
def run_record(spark, sf_dir):
    return two_runs(spark, sf_dir).store.runs().select(
        "run_id", "sync_id", "status", "source_record_count", "records_updates", "records_deletes",
        "records_processed", "records_succeeded", "records_failed",
    )
