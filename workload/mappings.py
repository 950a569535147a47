"""Queries over field mappings, names, order and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncloom.functions.columns import nest
from syncloom.functions.naming import normalize
from syncloom.operators.changes import apply_upsert, evolve
from syncloom.operators.fields import validate_fields
from syncloom.operators.keys import REASON, VALUE, split_by_key
from syncloom.operators.mapping import LookupObject, project, with_membership
from syncloom.operators.policies import policies_of
from syncloom.plans.spec import NORMALIZATIONS, Field, Mapping, SegmentSpec, SourceSpec, SyncSpec
from workload.fixtures import fixture, over_tables, with_fixtures
from workload.registry import register

KEY = Mapping(to="External_Id", from_="ext_id", is_primary_identifier=True)
RUN_ID = "run-42"


def sync(*mappings: Mapping, **options) -> SyncSpec:
    return SyncSpec("orders", SourceSpec("table", table="orders"), "Order", mappings or (KEY,), **options)


def mapped(spark, sf_dir, *mappings, source="book", **kwargs):
    return project(fixture(spark, sf_dir, source), sync(KEY, *mappings), RUN_ID, **kwargs)


@register("map_direct", with_fixtures("book", 'select ext_id as "External_Id", status as "Status", amount as "Amount" from book'))
def map_direct(spark, sf_dir):
    return mapped(spark, sf_dir, Mapping("Status", "status"), Mapping("Amount", "amount"))


@register(
    "map_hash",
    with_fixtures("book", """select ext_id as "External_Id", sha256(cast(customer_id as varchar)) as customer_hash,
        sha256(priority) as priority_hash, sha256(cast(amount as varchar)) as amount_hash from book"""),
)
def map_hash(spark, sf_dir):
    hashes = [Mapping(f"{n}_hash", c, type="hash")
              for n, c in (("customer", "customer_id"), ("priority", "priority"), ("amount", "amount"))]
    return mapped(spark, sf_dir, *hashes)


@register("map_constant", with_fixtures("book", """select ext_id as "External_Id", 'Website' as lead_source, '1' as rank from book"""))
def map_constant(spark, sf_dir):
    constants = Mapping("lead_source", type="constant", constant="Website"), Mapping("rank", type="constant", constant=1)
    return mapped(spark, sf_dir, *constants)


@register("map_sync_metadata", with_fixtures("book", """select ext_id as "External_Id", 'run-42' as last_run from book"""))
def map_sync_metadata(spark, sf_dir):
    return mapped(spark, sf_dir, Mapping("last_run", type="sync_metadata", sync_metadata_key="sync_run_id"))


SEGMENTS = [SegmentSpec("vip", "amount > 250000"), SegmentSpec("open", "status = 'O'"),
            SegmentSpec("urgent", "priority = '1-URGENT'")]


@register(
    "map_segment_membership",
    with_fixtures("book", """select ext_id as "External_Id", concat_ws(',',
        case when status = 'O' then 'open' end, case when priority = '1-URGENT' then 'urgent' end,
        case when amount > 250000 then 'vip' end) as segments from book"""),
)
def map_segment_membership(spark, sf_dir):
    return mapped(spark, sf_dir, Mapping("segments", type="segment_membership", segment_identify_by="name"),
                  segments=SEGMENTS)


@register(
    "map_segment_membership_table",
    with_fixtures("book order_segments", """select s.ext_id as "External_Id", coalesce(m.names, '') as segments
        from book s left join (select ext_id, string_agg(segment, ',' order by segment) as names
                              from (select distinct ext_id, segment from order_segments) group by ext_id) m
        on s.ext_id = m.ext_id"""),
)
def map_segment_membership_table(spark, sf_dir):
    base = mapped(spark, sf_dir)
    return with_membership(base, "segments", "External_Id", fixture(spark, sf_dir, "order_segments"), "ext_id", "segment")


@register(
    "map_liquid",
    with_fixtures("book", """select ext_id as "External_Id",
        'Order ' || cast(ext_id as varchar) || ' (' || upper(coalesce(priority, '')) || ')' as label,
        status || ' ' || cast(customer_id as varchar) as pair from book"""),
)
def map_liquid(spark, sf_dir):
    return mapped(
        spark, sf_dir,
        Mapping("label", type="liquid_template",
                liquid_template="Order {{ ext_id }} ({{ record['priority'] | upcase }})"),
        Mapping("pair", type="liquid_template", liquid_template='{{ record["status"] }} {{ customer_id }}'),
    )


ACCOUNT = Mapping("account", "customer_id", lookup_object="accounts", lookup_field="number")
LOOKED_UP = with_fixtures("book accounts", """
    select s.ext_id as "External_Id", a.id as account,
           case when a.id is null then 'lookup_miss:account' end as reject_reason,
           case when a.id is null then cast(s.customer_id as varchar) end as rejected_value
    from book s left join accounts a on s.customer_id = a.number""")


def _lookup(spark, sf_dir, spread):
    accounts = LookupObject(fixture(spark, sf_dir, "accounts"))
    return mapped(spark, sf_dir, ACCOUNT, lookups={"accounts": accounts}, keep_rejects=True, spread=spread)


@register("map_lookup", LOOKED_UP)
def map_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir, None)


@register("map_lookup_spread", LOOKED_UP)
def map_lookup_spread(spark, sf_dir):
    """The lookup join in the form taken beyond the broadcast threshold: hot references spread over salts."""
    return _lookup(spark, sf_dir, True)


@register(
    "map_lookup_smallest",
    with_fixtures("book shipments", """select s.ext_id as "External_Id", m.id as part
        from book s join (select order_id, min(id) as id from shipments group by order_id) m on s.ext_id = m.order_id"""),
)
def map_lookup_smallest(spark, sf_dir):
    """Several records match: the smallest id counts. Records without a match are left out."""
    part = Mapping("part", "ext_id", lookup_object="shipments", lookup_field="order_id")
    return mapped(spark, sf_dir, part, lookups={"shipments": LookupObject(fixture(spark, sf_dir, "shipments"))})


@register(
    "map_lookup_constant",
    with_fixtures("book accounts", """select ext_id as "External_Id",
        (select min(id) from accounts where market = 'BUILDING') as owner from book"""),
)
def map_lookup_constant(spark, sf_dir):
    owner = Mapping("owner", type="constant", constant="BUILDING", lookup_object="accounts", lookup_field="market")
    return mapped(spark, sf_dir, owner, lookups={"accounts": LookupObject(fixture(spark, sf_dir, "accounts"))})


@register(
    "map_nested",
    with_fixtures("book", """select sha256(cast(customer_id as varchar)) as hashed_customer, status, ext_id as order_id,
        amount from book"""),
)
def map_nested(spark, sf_dir):
    spec = sync(
        Mapping("identifier.order_id", "ext_id", is_primary_identifier=True),
        Mapping("identifier.hashed_customer", "customer_id", type="hash"),
        Mapping("details.state.status", "status"),
        Mapping("amount", "amount"),
    )
    nested = nest(project(fixture(spark, sf_dir, "book"), spec))
    return nested.select("identifier.order_id", "identifier.hashed_customer", "details.state.status", "amount")


@register(
    "map_all_properties",
    with_fixtures("book", """select ext_id as "External_Id", customer_id, upper(status) as status, amount, priority,
        'bulk' as origin from book"""),
)
def map_all_properties(spark, sf_dir):
    spec = sync(
        KEY, Mapping("status", type="liquid_template", liquid_template="{{ status | upcase }}"),
        Mapping("origin", type="constant", constant="bulk"), field_behavior="sync_all_properties",
    )
    return project(fixture(spark, sf_dir, "book"), spec)


# How the column c_mktsegment, a column "acctBalance" and a column "Nation-Key" are written in each style.
STYLED = {
    "start_case": ("C Mktsegment", "Acct Balance", "Nation Key"),
    "lower_case": ("c mktsegment", "acct balance", "nation key"),
    "upper_case": ("C MKTSEGMENT", "ACCT BALANCE", "NATION KEY"),
    "camel_case": ("cMktsegment", "acctBalance", "nationKey"),
    "snake_case": ("c_mktsegment", "acct_balance", "nation_key"),
    "match_source_names": ("c_mktsegment", "acctBalance", "Nation-Key"),
}


def _normalized(style):
    names = STYLED[style]
    sql = f"""select c_custkey as "id", c_mktsegment as "{names[0]}", c_acctbal as "{names[1]}",
                     c_nationkey as "{names[2]}" from customer"""

    @register("norm_" + style.removesuffix("_case").removesuffix("_source_names"), sql)
    def run(spark, sf_dir):
        df = over_tables(
            spark, sf_dir, "select c_custkey, c_mktsegment, c_acctbal as acctBalance, c_nationkey as `Nation-Key` from customer"
        )
        key = Mapping("id", "c_custkey", is_primary_identifier=True)
        return project(df, sync(key, field_behavior="sync_all_properties", field_normalization=style))


for _style in NORMALIZATIONS:
    assert normalize("acctBalance", _style) == STYLED[_style][1]
    _normalized(_style)


def _ordered(spark, sf_dir, order):
    spec = sync(KEY, Mapping("Status", "status"), Mapping("Amount", "amount"), Mapping("Customer", "customer_id"),
                field_order=order)
    df = project(fixture(spark, sf_dir, "book"), spec)
    return df.withColumn("fields", F.lit(",".join(df.columns)))


ORDERED = with_fixtures("book", """select ext_id as "External_Id", status as "Status", amount as "Amount",
    customer_id as "Customer", '{}' as fields from book""")


@register("order_alpha", ORDERED.replace("{}", "Amount,Customer,External_Id,Status"))
def order_alpha(spark, sf_dir):
    return _ordered(spark, sf_dir, "alphabetical_column_name")


@register("order_mapping", ORDERED.replace("{}", "External_Id,Status,Amount,Customer"))
def order_mapping(spark, sf_dir):
    return _ordered(spark, sf_dir, "mapping_order")


@register(
    "map_generate_field",
    with_fixtures("book dst", """select coalesce(s.ext_id, d.ext_id) as ext_id, coalesce(s.status, d.status) as status,
        s.priority as tier, s.amount as score from dst d full join book s on s.ext_id = d.ext_id"""),
)
def map_generate_field(spark, sf_dir):
    """The destination gains typed fields that the source maps but it does not have yet, and the upsert fills them."""
    key = Mapping("ext_id", "ext_id", is_primary_identifier=True)
    mappings = [
        Mapping("status", "status"),
        Mapping("tier", "priority", generate_field=True),
        Mapping("score", "amount", generate_field=True, field_type="number"),
    ]
    book = project(fixture(spark, sf_dir, "book"), sync(key, *mappings))
    dst = evolve(fixture(spark, sf_dir, "dst").select("ext_id", "status"), book, mappings)
    return apply_upsert(book, dst, ["ext_id"], policies_of(mappings))


@register(
    "map_field_type",
    with_fixtures("typed", """select ext_id as "External_Id", try_cast(size_text as double) as size,
        case when size_text = 'n/a' then 'bad_type:size' end as reject_reason,
        case when size_text = 'n/a' then size_text end as rejected_value from typed"""),
)
def map_field_type(spark, sf_dir):
    size = Mapping("size", "size_text", generate_field=True, field_type="number")
    return mapped(spark, sf_dir, size, source="typed", keep_rejects=True)


@register(
    "map_array_field",
    with_fixtures("book", """select ext_id as "External_Id", priority as tags,
        case when priority is not null then 1 end as n from book"""),
)
def map_array_field(spark, sf_dir):
    tags = Mapping("tags", "priority", generate_field=True, array_field=True)
    df = mapped(spark, sf_dir, tags)
    size = F.when(F.col("tags").isNotNull(), F.size("tags"))
    return df.select("External_Id", F.array_join("tags", "|").alias("tags"), size.alias("n"))


@register(
    "map_follow_type",
    with_fixtures("typed", """select ext_id, try_cast(size_text as integer) as size from typed"""),
)
def map_follow_type(spark, sf_dir):
    """The source column became a number: the destination's text field follows, what cannot be cast turns null."""
    dst = fixture(spark, sf_dir, "typed").select("ext_id", F.col("size_text").alias("size"))
    book = over_tables(spark, sf_dir, "select p_partkey as ext_id, p_size as size from part")
    return evolve(dst, book, [Mapping("size", "size", generate_field=True, follow_source_type=True)])


@register(
    "validate_keys",
    with_fixtures("src_dirty", """select ext_id, part_id, supplier_id, quantity, price,
        case when ext_id is null then 'null_key'
             when count(*) over (partition by ext_id) > 1 then 'duplicate_key' end as reject_reason from src_dirty"""),
)
def validate_keys(spark, sf_dir):
    valid, rejected = split_by_key(fixture(spark, sf_dir, "src_dirty"), ["ext_id"])
    return valid.withColumn(REASON, F.lit(None).cast("string")).unionByName(rejected)


@register(
    "validate_fields",
    with_fixtures("typed", """select ext_id, try_cast(size_text as double) as size_text, name,
        case when name is null then 'missing_required:name'
             when size_text = 'n/a' then 'bad_type:size_text' end as reject_reason,
        case when name is not null and size_text = 'n/a' then size_text end as rejected_value from typed"""),
)
def validate_fields_query(spark, sf_dir):
    rules = [Field("name", "text", required=True), Field("size_text", "number")]
    return validate_fields(fixture(spark, sf_dir, "typed"), rules).select("ext_id", "size_text", "name", REASON, VALUE)
