"""One key with a third of the rows, copies included: same results, spread over tasks."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from syncloom.operators.keys import duplicate_keys, latest_by_key, single_rows, split_by_key
from syncloom.operators.policies import WritePolicy
from syncloom.operators.skew import hot_keys, join_unique


@pytest.fixture(scope="module")
def skewed(spark):
    """9000 rows: a third on key 7 (all copies of one row), a ninth without key, the rest spread."""
    n = spark.range(0, 9000, 1, 6)
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 9 == 1, F.lit(None)).otherwise(F.col("id") % 1000)
    return n.select(key.cast("long").alias("k"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("v"))


def test_hot_keys(skewed, spark):
    hot = hot_keys(skewed, ["k"]).collect()
    seven = skewed.filter("k = 7").select(F.xxhash64("k")).first()[0]
    salts = {r[0]: r[1] for r in hot}
    assert salts[seven] >= 3 and set(salts) <= {seven, skewed.filter("k is null").select(F.xxhash64("k")).first()[0]}


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_spread_join(skewed, spark, how):
    right = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = join_unique(skewed, right, ["k"], how, spread=False)
    spread = join_unique(skewed, right, ["k"], how, spread=True)
    assert sorted(spread.columns) == sorted(plain.columns)
    assert rows(spread, *plain.columns) == rows(plain)


def test_spread_join_spreads(skewed, spark):
    right = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_unique(skewed, right, ["k"], "left")
        tasks = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r[1] for r in tasks) == skewed.filter("k = 7").count()
    assert len(tasks) > 1 and max(r[1] for r in tasks) < 3000


def test_two_column_keys(spark):
    left = spark.range(100).select((F.col("id") % 5).alias("a"), (F.col("id") % 3).alias("b"), "id")
    right = spark.range(5).select(F.col("id").alias("a"), F.lit(1).cast("long").alias("b"), F.lit("x").alias("w"))
    assert rows(join_unique(left, right, ["a", "b"], "left", True), "id", "w") == rows(
        left.join(right, ["a", "b"], "left"), "id", "w")


def test_split_by_key(skewed, spark):
    valid, rejected = split_by_key(skewed, ["k"])
    counts = {r.k: r["count"] for r in skewed.groupBy("k").count().collect()}
    single = [k for k, n in counts.items() if k is not None and n == 1]
    assert sorted(r.k for r in valid.collect()) == sorted(single)
    reasons = {r.reject_reason: r["count"] for r in rejected.groupBy("reject_reason").count().collect()}
    assert reasons["null_key"] == counts[None]
    assert reasons["duplicate_key"] == skewed.count() - counts[None] - len(single)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far_valid, far_rejected = split_by_key(skewed, ["k"])
        assert "__salt" in far_rejected._jdf.queryExecution().analyzed().toString()
        assert rows(far_valid) == rows(valid) and rows(far_rejected) == rows(rejected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_hot_keys_no_salts(spark):
    left = spark.range(0, 5000, 1, 4).withColumnRenamed("id", "k")
    joined = join_unique(left, spark.range(100).withColumnRenamed("id", "k"), ["k"], "left_semi", spread=True)
    assert "__salt" not in joined._jdf.queryExecution().analyzed().toString() and joined.count() == 100


def test_hot_keys_collapse_before_the_shuffle(skewed):
    plan = single_rows(skewed.filter("k is not null"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_any_value" if "partial_any_value" in plan else "partial_first") > plan.index("Exchange")


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", "p", None), (1, 2, None, "q", "x"), (1, 3, None, "r", None), (2, 5, "b", None, "y"), (2, 5, "c", None, "y")],
        "k int, at int, keep string, last string, skip string",
    )
    policies = {"keep": WritePolicy(preserve=True), "skip": WritePolicy(sync_nulls=False)}
    got = rows(latest_by_key(df, ["k"], ["at"], policies))
    assert got == [(1, 3, "a", "r", "x"), (2, 5, "b", None, "y")]


def test_latest_by_key_with_maps(spark):
    df = spark.sql("select 1 as k, 2 as at, map('a', 1) as m union all select 1, 3, map('b', 2) union all select 2, 1, null")
    got = {r.k: (r.at, r.m) for r in latest_by_key(df, ["k"], ["at"]).collect()}
    assert got == {1: (3, {"b": 2}), 2: (1, None)}


def test_a_key_of_a_few_partitions_is_hot_at_many(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "10000")
    try:
        df = spark.range(0, 250_000, 1, 4).select(F.when(F.col("id") % 2500 == 0, F.lit(-7)).otherwise(F.col("id")).alias("k"))
        hot = {r[0]: r[1] for r in hot_keys(df, ["k"]).collect()}
        assert hot.get(spark.range(1).select(F.xxhash64(F.lit(-7).cast("long"))).first()[0], 0) >= 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_side_partitioned_by_its_key_spreads(spark):
    left = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("long").alias("k"), "id")
    right = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_unique(left.repartition(8, "k"), right, ["k"], "left")
        tasks = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r[1] for r in tasks) == 3006 and len(tasks) > 1 and max(r[1] for r in tasks) < 2500
