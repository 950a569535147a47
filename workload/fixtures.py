"""Inputs of the registered queries: the given tables, and views of them written once in SQL both engines read.

Every fixture is computed over whole tables. Where a source, a previous snapshot and a
destination are compared, they are the order book as seen at different times: the source has let go of orders before July
1995, the previous run saw orders from April 1995 up to the end of 2000, the destination received what was ordered
before 2001.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

FIXTURES = {
    # the whole order book, for what does not compare two states
    "book": """
        select o_orderkey as ext_id, o_custkey as customer_id, o_orderstatus as status, o_totalprice as amount,
               case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as priority
        from orders""",
    # the source as extracted now
    "src": """
        select o_orderkey as ext_id, o_custkey as customer_id, o_orderstatus as status, o_totalprice as amount,
               case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as priority
        from orders where o_orderdate >= date '1995-07-01'""",
    # the destination object: late orders still open, some amounts provisional, low priority never recorded
    "dst": """
        select o_orderkey as ext_id, o_custkey as customer_id,
               case when o_orderstatus = 'F' and o_orderdate >= date '2000-07-01' then 'O'
                    else o_orderstatus end as status,
               case when o_orderstatus = 'P' and o_orderdate >= date '1999-01-01' then o_totalprice + 1
                    else o_totalprice end as amount,
               case when o_orderpriority = '5-LOW' then null else o_orderpriority end as priority
        from orders where o_orderdate < date '2001-01-01'""",
    # the source as the previous run saw it
    "prev": """
        select o_orderkey as ext_id, o_custkey as customer_id, o_orderstatus as status,
               case when o_orderstatus = 'O' and o_orderdate >= date '2000-01-01' then o_totalprice - 1
                    else o_totalprice end as amount,
               case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as priority
        from orders
        where o_orderdate >= date '1995-04-01' and o_orderdate < date '2001-01-01'""",
    # shipments: keys repeat in the data itself, returned and filled lines have none
    "src_dirty": """
        select case when l_returnflag = 'R' and l_linestatus = 'F' then null
                    else cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20)) end as ext_id,
               l_partkey as part_id, l_suppkey as supplier_id, l_quantity as quantity, l_extendedprice as price
        from lineitem""",
    # the object those shipments are synced to: what was delivered before 2000
    "delivered": """
        select cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20)) as "External_Id",
               max(l_quantity) as "Quantity", 'import' as "Origin"
        from lineitem where l_shipdate < date '2000-01-01' group by l_orderkey, l_linenumber""",
    # cohort: customers with money; a customer is listed once per order
    "members": """
        select o_custkey as customer_id from orders join customer on o_custkey = c_custkey where c_acctbal > 0""",
    # lookup object: accounts in good standing, found by customer number
    "accounts": """
        select 'acct-' || cast(c_custkey as varchar(20)) as id, c_custkey as number, c_mktsegment as market
        from customer where c_acctbal >= 0""",
    # lookup object with several records per order
    "shipments": """
        select l_partkey as id, l_orderkey as order_id from lineitem where l_returnflag = 'A'""",
    # (record, segment) rows, repeating
    "order_segments": """
        select l_orderkey as ext_id,
               case when l_returnflag = 'R' then 'returned' when l_discount > 0.05 then 'bargain' else 'regular' end
                   as segment
        from lineitem""",
    # values to cast and to require
    "typed": """
        select p_partkey as ext_id,
               case when p_type = 'PROMO' then 'n/a' else cast(p_size as varchar(20)) end as size_text,
               case when p_brand = 'Brand#7' then null else p_name end as name
        from part""",
    # two objects a destination is the union of
    "leads": """
        select o_orderkey as ext_id from orders where o_orderdate < date '1998-01-01'""",
    "contacts": """
        select o_orderkey as ext_id from orders
        where o_orderdate >= date '1997-01-01' and o_orderdate < date '2000-01-01'""",
    # run history: one sync per user, one run per user and day of activity
    "runs": """
        select 'sync-' || cast(user_id as varchar(20)) as sync_id,
               'run-' || cast(user_id as varchar(20)) || '-' || cast(cast(ts as date) as varchar(20)) as run_id,
               cast(cast(ts as date) as timestamp) as scheduled_at,
               min(ts) as started_at, max(ts) as completed_at, count(*) as records_processed,
               sum(case when value > 100 then 1 else 0 end) as records_failed,
               case when sum(case when value > 100 then 1 else 0 end) * 3 > count(*) then 'failed'
                    else 'completed' end as status,
               max(event_type) = 'signup' as full_sync
        from events group by user_id, cast(ts as date)""",
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> SparkSession:
    """Register given tables as views of this session and return it; times are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for t in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)
    return spark


def named_in(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def over_tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The result of SQL over the given tables it names; double-quoted names become Spark's backticked ones."""
    return tables(spark, sf_dir, *named_in(sql)).sql(sql.replace('"', "`"))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return over_tables(spark, sf_dir, FIXTURES[name])


def with_fixtures(names: str, body: str) -> str:
    """The oracle's SQL: the fixtures as common table expressions before the query."""
    parts = ",\n".join(f"{n} as ({FIXTURES[n]}\n)" for n in names.split())
    return f"with {parts}\n{body}"
