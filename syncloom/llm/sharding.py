"""Sharding by histogram sort: splitters from counted bytes, then one exchange. DataFrame functions only.

Rows have a key of three longs: a hash of the text, a hash of the id, and the row's number in the stored key table (for
rows that agree in all else). Equal texts are neighbours, so a group is cut only where a boundary must lie within it.
Splitters are refined digit by digit: exact bytes are counted below every candidate boundary that the next sixteen
bits give inside the intervals still open, all partitions together, until every splitter's cumulative bytes
are within the tolerance of its target.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.session import scratch_path, stored

DIGIT = 16
KEYS = ("_k1", "_k2", "_k3")
LAST = len(KEYS) * 64 // DIGIT


def _digit(k: int) -> Column:
    """The ``k``-th group of bits of the key, the highest first; hashes sort as unsigned numbers."""
    at = k * DIGIT
    return F.shiftrightunsigned(F.col(KEYS[at // 64]), 64 - DIGIT - at % 64).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int")


def _path(digits: int) -> Column:
    """The first ``digits`` digits as fixed-width text: its order is the order of the keys."""
    whole = F.concat(*[F.lpad(F.hex(F.col(k)), 16, "0") for k in KEYS])
    return F.substring(whole, 1, digits * DIGIT // 4)


def _reached(boundary: str) -> Column:
    """Whether a row's key is not below a boundary, compared as numbers word by word."""
    prefix = boundary.rstrip("~")
    value = int(prefix or "0", 16) + boundary.endswith("~")
    if not prefix or value >> 4 * len(prefix):
        return F.lit(False)
    value <<= 4 * (16 * len(KEYS) - len(prefix))
    out = F.lit(True)
    for name in reversed(KEYS):
        word, value = value & ((1 << 64) - 1), value >> 64
        signed = F.lit(word - (1 << 63)).cast("long")
        key = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order as signed
        out = (key > signed) | ((key == signed) & out)
    return out


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[str]:
    """Boundaries as hex text: a row belongs right of a boundary if its whole key, as text, is not below it.

    Each round asks for one small row per splitter; the counts stay in Spark. A splitter is done once the bytes
    below it are within ``tolerance`` shard sizes of its target, or its interval holds one key only.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    goals = {i: total * i / shards for i in range(1, shards)}
    slack = tolerance * total / shards
    found: dict[int, str] = {}  # splitter -> boundary
    open_in: dict[str, list[int]] = {"": list(goals)}  # interval (key prefix) -> splitters whose goal lies in it
    below = {"": 0}  # bytes before the interval
    spark = keys.sparkSession
    for k in range(LAST):
        if not open_in or not total:
            break
        wanted = spark.createDataFrame([(p, i, float(goals[i]), below[p]) for p, many in open_in.items() for i in many], "_p string, i int, goal double, _below long")
        heads = wanted.select("_p", "_below").distinct()
        cells = keys.withColumn("_p", _path(k)) if k else keys.withColumn("_p", F.lit(""))
        # at most shards - 1 open prefixes, so this side is a few rows
        cells = cells.join(F.broadcast(heads), "_p").groupBy("_p", "_below", _digit(k).alias("d")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
        run = Window.partitionBy("_p").orderBy("d")
        cells = cells.withColumn("hi", F.col("_below") + F.sum("b").over(run)).withColumn("lo", F.col("hi") - F.col("b"))
        # per splitter the cell that holds its goal
        near = cells.join(F.broadcast(wanted.drop("_below")), "_p").where("lo <= goal and goal < hi")
        next_open: dict[str, list[int]] = {}
        next_below: dict[str, int] = {}
        for r in near.select("_p", "i", "d", "lo", "hi", "n").collect():
            here, goal = r["_p"] + format(r["d"], "04X"), goals[r["i"]]
            left, right = goal - r["lo"], r["hi"] - goal
            if min(left, right) <= slack or r["n"] == 1 or k == LAST - 1:
                found[r["i"]] = here if left <= right else here + "~"  # before, or after, every key that begins so
            else:
                next_open.setdefault(here, []).append(r["i"])
                next_below[here] = r["lo"]
        open_in, below = next_open, next_below
    return [found.get(i, "~") for i in sorted(goals)]


def histogram_shards(docs: DataFrame, shards: int = 40, tolerance: float = 0.002, rows_per_part: int = 100_000, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: law ``bytes``, every row in one of ``shards`` shards.

    A row's size is its text's UTF-8 bytes plus 16. Shards are key ranges whose sizes differ from the mean by the tolerance, or
    by the row that straddles a boundary. ``slot`` numbers a shard's rows from 0 without gaps. ``grown_shard`` is null:
    it belongs to another law.

    A null text has size 16, the checksum of no bytes, and stands beside empty texts; a null id is a key like others.
    Ties and repeated rows, even a third of the table, are told apart by their number in the key table and may
    be cut anywhere. An empty table gives an empty result. Other columns are not read.

    The texts are read once; what is counted and exchanged is a table of about forty bytes a row.
    """
    spark = docs.sparkSession
    body = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    keys = docs.select(
        docs[f"`{key}`"].alias("doc_id"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_k1"),
        F.xxhash64(docs[f"`{key}`"]).alias("_k2"),
        F.monotonically_increasing_id().alias("_k3"),
    )
    keys = stored(keys, scratch_path(spark, "shard-keys"))
    cuts = splitters(keys, shards, tolerance)
    shard = reduce(lambda a, b: a + b, [_reached(c).cast("int") for c in cuts], F.lit(0))
    parts = max(1, -(-keys.count() // (shards * rows_per_part)))
    dealt = keys.withColumn("shard", shard).withColumn("_part", F.pmod(F.xxhash64("_k2", "_k3"), F.lit(parts)))
    # Slots without one task per shard: the rows of a part are numbered after those of the parts before it. The counts
    # are one row per part, and the rows move once.
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_part").orderBy(*KEYS)
    numbered = dealt.withColumn("_row", F.row_number().over(within) - 1).join(offsets, ["shard", "_part"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_before") + F.col("_row")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
