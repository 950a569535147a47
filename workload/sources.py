"""Queries over sources, datasets and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from syncloom.plans.spec import DatasetSpec, SegmentSpec, SourceSpec
from syncloom.session import scratch_path
from syncloom.sinks.files import export_file
from syncloom.sinks.objects import ObjectStore
from syncloom.sources.readers import Catalog, ConnectionSpec, profile_dataset, read_cohort, read_dataset
from workload.fixtures import FIXTURES, fixture, tables, with_fixtures
from workload.registry import register

RUN_AT = datetime(2024, 1, 15, 8, 30)


@register("src_table", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def src_table(spark, sf_dir):
    source = SourceSpec.from_config({"connection_id": 1, "object": {"type": "table", "table_name": "customer"}})
    return Catalog().resolve(tables(spark, sf_dir, "customer"), source)


ACTIVE_USERS = """
    select c_custkey, c_name, c_acctbal from customer where c_mktsegment = 'BUILDING' and c_acctbal > 0"""


@register("src_dataset", ACTIVE_USERS)
def src_dataset(spark, sf_dir):
    catalog = Catalog(datasets={"5951": DatasetSpec("active_customers", ACTIVE_USERS)})
    return catalog.resolve(
        tables(spark, sf_dir, "customer"), SourceSpec.from_config({"object": {"type": "dataset", "id": 5951}})
    )


@register(
    "src_model",
    "select p_brand, count(*) as parts, round(avg(p_retailprice), 4) as avg_price from part group by p_brand",
)
def src_model(spark, sf_dir):
    query = "select p_brand, count(*) as parts, round(avg(p_retailprice), 4) as avg_price from part group by p_brand"
    catalog = Catalog(models={"21130": DatasetSpec("brands", query)})
    return catalog.resolve(
        tables(spark, sf_dir, "part"), SourceSpec.from_config({"object": {"type": "model", "id": "21130"}})
    )


@register("src_segment", with_fixtures("book", "select * from book where amount > 250000 and status = 'O'"))
def src_segment(spark, sf_dir):
    catalog = Catalog(
        datasets={"7": DatasetSpec("order_book", FIXTURES["book"])},
        segments={"3060": SegmentSpec("large_open", "amount > 250000 and status = 'O'")},
    )
    source = SourceSpec.from_config({"filter_segment_id": 3060, "object": {"type": "dataset", "id": 7}})
    return catalog.resolve(tables(spark, sf_dir, "orders"), source)


COHORT = with_fixtures(
    "book members", "select * from book where customer_id in (select customer_id from members)"
)


@register("src_cohort", COHORT)
def src_cohort(spark, sf_dir):
    members = fixture(spark, sf_dir, "members")
    catalog = Catalog(
        datasets={"7": DatasetSpec("order_book", FIXTURES["book"])}, cohorts={"12": (members, "customer_id")}
    )
    source = SourceSpec.from_config({"object": {"type": "cohort", "id": 12, "dataset_id": 7}})
    return catalog.resolve(spark, source)


@register("src_cohort_spread", COHORT)
def src_cohort_spread(spark, sf_dir):
    """The cohort join in the form taken beyond the broadcast threshold: hot customers spread over salts."""
    members = fixture(spark, sf_dir, "members")
    return read_cohort(fixture(spark, sf_dir, "book"), members, "customer_id", spread=True)


@register(
    "src_formats",
    """select c_custkey, c_name, c_acctbal, 'csv' as format from customer
       union all select c_custkey, c_name, c_acctbal, 'json' from customer
       union all select c_custkey, c_name, c_acctbal, 'orc' from customer
       union all select c_custkey, c_name, c_acctbal, 'parquet' from customer""",
)
def src_formats(spark, sf_dir):
    """Four connections with one table each; definitions name them by id."""
    given = tables(spark, sf_dir, "customer").table("customer").select("c_custkey", "c_name", "c_acctbal")
    connections = {}
    for fmt in ("csv", "json", "orc", "parquet"):
        root = scratch_path(spark, f"connection-{fmt}")
        given.write.format(fmt).save(f"{root}/crm/customer")
        connections[fmt] = ConnectionSpec(fmt, root=root, schemas={"customer": given.schema} if fmt in ("csv", "json") else {})
    catalog = Catalog(connections=connections)
    out = None
    for fmt in connections:
        source = SourceSpec.from_config({"connection_id": fmt, "object": {"type": "table", "table_schema": "crm", "table_name": "customer"}})
        part = catalog.resolve(spark, source).withColumn("format", F.lit(fmt))
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "dataset_profile",
    """select c.name, c.data_type, (select count(*) from orders) as record_count
       from (values ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
                    ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string'))
            as c(name, data_type)""",
)
def dataset_profile(spark, sf_dir):
    return profile_dataset(tables(spark, sf_dir, "orders").table("orders"))


# ---- dataset SQL. The as-of date is written out, so that results repeat.

RECENT = """
    select event_id, user_id, event_type, value from events
    where event_type <> 'error' and ts > cast('2024-01-31' as date) - interval '10 days'"""


@register("ds_recent_filter", RECENT)
def ds_recent_filter(spark, sf_dir):
    return read_dataset(tables(spark, sf_dir, "events"), DatasetSpec("recent_events", RECENT))


@register(
    "ds_join_group_having",
    """select c.c_custkey, c.c_name, c.c_mktsegment, round(sum(o.o_totalprice), 2) as lifetime_value,
              count(o.o_orderkey) as order_count
       from customer c join orders o on c.c_custkey = o.o_custkey
       group by c.c_custkey, c.c_name, c.c_mktsegment having sum(o.o_totalprice) > 1000000""",
)
def ds_join_group_having(spark, sf_dir):
    # orders are summed per customer before the join, so a customer with very many orders is combined map-side
    query = """
        with spent as (
            select o_custkey, sum(o_totalprice) as total, count(o_orderkey) as order_count
            from orders group by o_custkey having sum(o_totalprice) > 1000000)
        select c.c_custkey, c.c_name, c.c_mktsegment, round(s.total, 2) as lifetime_value, s.order_count
        from customer c join spent s on c.c_custkey = s.o_custkey"""
    return read_dataset(tables(spark, sf_dir, "customer", "orders"), DatasetSpec("high_value_customers", query))


ENGAGEMENT = """
    with user_activity as (
        select user_id, count(distinct cast(ts as date)) as days_active, count(*) as total_events
        from events where ts > cast('2024-04-01' as date) - interval '90 days' group by user_id)
    select u.c_custkey, u.c_name, ua.days_active, ua.total_events,
           round((ua.days_active::double / 90) * 100, 2) as engagement_score
    from customer u join user_activity ua on u.c_custkey = ua.user_id
    where ua.days_active >= 5"""


@register("ds_cte_engagement", ENGAGEMENT)
def ds_cte_engagement(spark, sf_dir):
    return read_dataset(tables(spark, sf_dir, "customer", "events"), DatasetSpec("engagement", ENGAGEMENT))


@register("ds_select_star", "select * from supplier")
def ds_select_star(spark, sf_dir):
    return read_dataset(tables(spark, sf_dir, "supplier"), DatasetSpec("all_suppliers", "select * from supplier"))


PROJECTION = "select c_custkey as id, c_name as name, c_mktsegment as market from customer where (c_acctbal > 0) = true"


@register("ds_projection", PROJECTION)
def ds_projection(spark, sf_dir):
    return read_dataset(tables(spark, sf_dir, "customer"), DatasetSpec("solvent_customers", PROJECTION))


# ---- sinks read back what they wrote


@register("sink_object", with_fixtures("book", "select ext_id, customer_id, status, amount, priority from book"))
def sink_object(spark, sf_dir):
    dst = fixture(spark, sf_dir, "book")
    store = ObjectStore(spark, scratch_path(spark, "sink-object"))
    store.create_object("Order", dst.schema, "create", RUN_AT)
    store.write("Order", "orders", "run-1", dst)
    store.record(run_id="run-1", sync_id="orders", status="completed", created_at=RUN_AT, started_at=RUN_AT,
                 completed_at=RUN_AT, object="Order", writes="append", seq=2)
    store.write("Order", "orders", "run-2", dst)  # never committed: not part of the object
    return store.read("Order", ["ext_id"])


EXPORTED = with_fixtures("book", "select ext_id, customer_id, status, amount, priority, '{}' as file from book")


@register("sink_file_parquet", EXPORTED.replace("{}", "data_01-15-24.parquet"))
def sink_file_parquet(spark, sf_dir):
    root = scratch_path(spark, "export")
    book = fixture(spark, sf_dir, "book")
    path = export_file(book, "path_to_file/data_%m-%d-%y.parquet", {"file_format": "Parquet"}, RUN_AT, root)
    return spark.read.parquet(path).withColumn("file", F.lit(path.rsplit("/", 1)[1]))


@register("sink_file_csv", EXPORTED.replace("{}", "orders_2024-01-15.csv"))
def sink_file_csv(spark, sf_dir):
    root = scratch_path(spark, "export")
    book = fixture(spark, sf_dir, "book")
    config = {"file_format": "CSV", "csv_delimiter": "|", "csv_include_header": "true"}
    path = export_file(book, "orders_%Y-%m-%d.csv", config, RUN_AT, root)
    back = spark.read.schema(book.schema).option("sep", "|").option("header", True).csv(path)
    return back.withColumn("file", F.lit(path.rsplit("/", 1)[1]))
