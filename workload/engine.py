"""Queries over whole runs of the engine: commits, switches of strategy, rejects, fields that change."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from syncloom.plans.run import SyncRunner
from syncloom.plans.spec import DatasetSpec, SyncSpec
from syncloom.session import scratch_path
from syncloom.sources.readers import Catalog
from workload.fixtures import FIXTURES, tables, with_fixtures
from workload.registry import register

AT = datetime(2024, 1, 15, 6)
KEY = {"from": "ext_id", "to": "ext_id", "is_primary_identifier": True}
AMOUNT = {"from": "amount", "to": "amount"}
BOOK = f"select * from ({FIXTURES['book']})"


def runner_over(spark, sf_dir, **datasets: str) -> SyncRunner:
    catalog = Catalog(datasets={name: DatasetSpec(name, query) for name, query in datasets.items()})
    return SyncRunner(tables(spark, sf_dir, "orders"), scratch_path(spark, "engine"), catalog)


def sync(dataset: str, name: str = "orders", to: str = "Order", mappings=(KEY, AMOUNT), **options) -> SyncSpec:
    return SyncSpec.from_config({
        "name": name, "source_attributes": {"object": {"type": "dataset", "id": dataset}},
        "destination_attributes": {"object": to}, "field_mapping": list(mappings), **options})


@register("run_two_syncs", with_fixtures("book", """
    select case when status = 'O' then 'Open' else 'Closed' end as object, ext_id, amount from book"""))
def run_two_syncs(spark, sf_dir):
    """Two syncs under the same run id."""
    runner = runner_over(spark, sf_dir, open=f"{BOOK} where status = 'O'", closed=f"{BOOK} where status <> 'O'")
    parts = []
    for name, to in (("open", "Open"), ("closed", "Closed")):
        spec = sync(name, name, to, operation="upsert")
        runner.run(spec, "2024-01-15T06", AT)
        parts.append(runner.store.read(to, spec.keys).select(F.lit(to).alias("object"), "ext_id", "amount"))
    return parts[0].unionByName(parts[1])


@register("run_swap_then_mirror", with_fixtures("src", "select ext_id, amount from src"))
def run_swap_then_mirror(spark, sf_dir):
    """A sync that replaced its object goes on as a mirror: what left the source since is deleted."""
    runner = runner_over(spark, sf_dir, before=FIXTURES["prev"], now=FIXTURES["src"])
    runner.run(sync("before", operation="mirror", mirror_strategy="upload_and_swap"), "run-1", AT)
    spec = sync("now", operation="mirror", mirror_strategy="sync_updates_and_deletes")
    runner.run(spec, "run-2", AT)
    return runner.store.read("Order", spec.keys)


@register("mirror_keeps_rejected", with_fixtures("book", """
    select 'incremental' as mode, ext_id, amount from book union all select 'full', ext_id, amount from book"""))
def mirror_keeps_rejected(spark, sf_dir):
    """Records that turn into duplicates are refused, not gone: the mirror keeps them, in an incremental and in a full run."""
    parts = []
    for full in (False, True):
        runner = runner_over(spark, sf_dir, good=BOOK, twice=f"{BOOK} union all {BOOK} where status = 'P'")
        spec = sync("good", operation="mirror", mirror_strategy="sync_updates_and_deletes")
        runner.run(spec, "run-1", AT)
        runner.run(sync("twice", operation="mirror", mirror_strategy="sync_updates_and_deletes"), "run-2", AT, force_full=full)
        whole = runner.store.read("Order", spec.keys)
        parts.append(whole.select(F.lit("full" if full else "incremental").alias("mode"), "ext_id", "amount"))
    return parts[0].unionByName(parts[1])


@register("append_fields_change", with_fixtures("book", """
    select ext_id, case when amount < 200000 then status end as status,
           case when amount < 200000 then cast(customer_id as varchar) else 'c-' || cast(customer_id as varchar) end as owner
    from book"""))
def append_fields_change(spark, sf_dir):
    """An append object whose later runs no longer write one field and write another as text."""
    runner = runner_over(spark, sf_dir, small=f"{BOOK} where amount < 200000",
                         all=f"select ext_id, amount, 'c-' || cast(customer_id as string) as owner from ({FIXTURES['book']})")
    first = sync("small", mappings=(KEY, {"from": "status", "to": "status"}, {"from": "customer_id", "to": "owner"}), operation="append")
    runner.run(first, "run-1", AT)
    later = sync("all", mappings=(KEY, {"from": "owner", "to": "owner"}), operation="append")
    runner.run(later, "run-2", AT)
    return runner.store.read("Order", later.keys).select("ext_id", "status", "owner")


def appended_twice(spark, sf_dir, before: str, after: str):
    """Orders below an amount with one form of a field, folded into a base, then all of them with another form."""
    runner = runner_over(spark, sf_dir, small=f"select ext_id, {before} as v from ({FIXTURES['book']}) where amount < 200000",
                         all=f"select ext_id, {after} as v from ({FIXTURES['book']})")
    for run_id, dataset in (("run-1", "small"), ("run-2", "all")):
        spec = sync(dataset, mappings=(KEY, {"from": "v", "to": "v"}), operation="append")
        runner.run(spec, run_id, AT)
        runner.store.compact("Order", spec.keys, f"{run_id}-base", AT, runner.store.standing(spec.name, run_id)[2] - 1)
    return runner.store.read("Order", spec.keys).select("ext_id", "v")


@register("append_text_to_number", with_fixtures("book", """
    select ext_id, case when amount < 200000 then 'c-' else '' end || cast(customer_id as varchar) as v from book"""))
def append_text_to_number(spark, sf_dir):
    """A field written as text that is no number, later as a number: all of it stays, as text."""
    return appended_twice(spark, sf_dir, "'c-' || cast(customer_id as string)", "customer_id")


@register("append_double_to_integer", with_fixtures("book", """
    select ext_id, case when amount < 200000 then amount + 0.25 else floor(amount) end as v from book"""))
def append_double_to_integer(spark, sf_dir):
    """A field written with fractions, later as an integer: the fractions stay."""
    return appended_twice(spark, sf_dir, "cast(amount as double) + 0.25", "cast(floor(amount) as int)")


class Lost(BaseException):
    """The driver is gone: nothing handles this, and nothing is recorded any more."""


def losing(runner: SyncRunner, commits: int) -> SyncRunner:
    """The runner with a store whose driver is lost at a run's commit, the first ``commits`` times."""
    store, commit, left = runner.store, runner.store.commit, [commits]

    def dying(rows):  # noqa: ANN001, ANN202
        if left[0] and any(r["status"] == "completed" for r in rows):
            left[0] -= 1
            raise Lost
        commit(rows)

    store.commit = dying
    return runner


@register("run_driver_lost", with_fixtures("book", """
    select 'run-1' as run_id, 'started' as status, cast(null as bigint) as source_record_count
    union all select 'run-2', 'completed', count(*) from book"""))
def run_driver_lost(spark, sf_dir):
    """A run whose driver is lost before its commit stays in the history as one that started; the next run completes."""
    runner = losing(runner_over(spark, sf_dir, book=BOOK), 1)
    spec = sync("book", operation="upsert")
    try:
        runner.run(spec, "run-1", AT)
    except Lost:
        pass
    runner.run(spec, "run-2", AT)
    return runner.store.runs().select("run_id", "status", "source_record_count")


@register("run_union_crash", with_fixtures("leads contacts src", """
    select 'leads' as object, ext_id from leads
    union all select 'leads', ext_id from src where ext_id not in (select ext_id from leads) and ext_id not in (select ext_id from contacts)
    union all select 'contacts', ext_id from contacts"""))
def run_union_crash(spark, sf_dir):
    """A run over a union of two objects loses its driver at the commit: neither write counts, and the repeated run makes both."""
    runner = runner_over(spark, sf_dir, leads=FIXTURES["leads"], contacts=FIXTURES["contacts"], src=f"select ext_id from ({FIXTURES['src']})")
    key = (KEY,)
    for name in ("leads", "contacts"):
        runner.run(sync(name, name, name, key, operation="upsert"), "run-0", AT)
    runner.unions = {"Person": ("leads", "contacts")}
    spec = sync("src", "people", "Person", key, operation="upsert", advanced_configuration={"lead_union_insert_to": "leads"})
    losing(runner, 1)
    try:
        runner.run(spec, "run-1", AT)
    except Lost:
        pass
    runner.run(spec, "run-1", AT)
    parts = [runner.store.read(n, ["ext_id"]).select(F.lit(n).alias("object"), "ext_id") for n in ("leads", "contacts")]
    return parts[0].unionByName(parts[1])
