"""Joins that hold when one key carries a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.columns import has_map, quoted
from syncloom.session import fits_broadcast, scratch_path, stored

_HASH, _SALT, _SALTS = "__key_hash", "__salt", "__salts"
TRACKED_PER_KEY = 10  # counters per possible hot key in a frequent-items sketch; its error stays well below one hot share
MOST_TRACKED = 1_000_000  # the most counters a sketch can have
SKETCH_GROUPS = 256  # sketches are merged in this many groups first, then to one


def hot_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """``(key hash, salts)`` for the keys that alone exceed an average shuffle partition.

    There are fewer of them than shuffle partitions, so that number sizes everything: one pass with mergeable sketches, no
    shuffle of keys, a two-level merge so that no task receives every sketch, and at most one row per partition out. Each hot key gets salts in proportion to its share, so that a salted part is about as
    large as an average shuffle partition. The counts are estimates: good enough to place rows, and used for nothing else.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    tracked = min(max(TRACKED_PER_KEY * parts, 1000), MOST_TRACKED)
    hashes = df.select(
        F.xxhash64(*[quoted(k) for k in on]).alias(_HASH), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")
    )
    count = F.count(F.lit(1)).alias("n")
    groups = hashes.groupBy("g").agg(F.expr(f"approx_top_k_accumulate({_HASH}, {tracked})").alias("sketch"), count)
    # grouped by a constant: a combine without groups fails on partitions that hold no sketch
    top = groups.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("total")
    ).select(F.expr(f"approx_top_k_estimate(sketch, {min(parts, tracked)})").alias("top"), "total")
    return (
        top.select(F.explode("top").alias("t"), "total")
        .select(F.col("t.item").alias(_HASH), F.ceil(F.col("t.count") * parts / F.col("total")).cast("int").alias(_SALTS))
        .filter(F.col(_SALTS) > 1)
    )


def _hashable(df: DataFrame) -> list[Column]:
    return [quoted(f.name) for f in df.schema.fields if not has_map(f.dataType)]


def join_unique(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, spread: bool | None = None,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Join a side that may be skewed with a side that has at most one row per key (left, left_semi or left_anti).

    A right side within the broadcast threshold is left to the optimizer, which broadcasts it by the same estimate.
    Beyond it the hot keys of the left are looked up once and kept as a small table, so that both sides of every attempt
    of every task see the same list. Without hot keys this is a plain join; otherwise their rows (null keys count as one
    key) are spread over salts, and only the right rows of hot keys are repeated, at most
    twice ``spark.sql.shuffle.partitions`` times in all. The salt comes from the row's columns and the partition it lies
    in, so rows of one key spread when they lie together, copies of one row when they do not, and a re-run task assigns
    the same salts. ``keys_of`` may give the same keys as ``left`` from
    an earlier, cheaper step.
    """
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    if spread is None:
        spread = not left.isStreaming and not fits_broadcast(right)
    if not spread:
        return left.join(right, on, how)
    hot = stored(hot_keys(left if keys_of is None else keys_of, on), scratch_path(left.sparkSession, "hot-keys"))
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = F.broadcast(hot)
    hash_of = F.xxhash64(*[quoted(k) for k in on])
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    salted_left = (
        left.withColumn(_HASH, hash_of)
        .join(hot, _HASH, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*_hashable(left)) + F.spark_partition_id(), salts))
        .drop(_HASH, _SALTS)
    )
    salted_right = (
        right.withColumn(_HASH, hash_of)
        .join(hot, _HASH, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop(_HASH, _SALTS)
    )
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)
