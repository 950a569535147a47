"""Exact top-k search: tiled matrix products, a partial selection in every tile, lists merged in a tree.

Queries and candidates are dealt over a grid. A cell multiplies its queries with its candidates, some queries at a time,
and keeps each query's best few; lists of neighbouring cells are merged, then lists of those, until one list is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.llm.rows import ship
from syncloom.session import scratch_path, stored

#: Rows of a grid cell's sides, scores worked on at once, lists merged into one per level.
QUERY_TILE, SHARD_TILE, BLOCK_SCORES, FAN_IN = 16_384, 16_384, 4_000_000, 32
CELL = "uid long, query_id long, vec_id long, score long, dim int, g int"


def components(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` as longs; beyond the range of a long, its limits."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(column), dim)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products as longs: by floating point while every sum is a whole number it can hold."""

    def most(x: np.ndarray) -> int:
        return max(int(x.max(initial=0)), -int(x.min(initial=0)))

    bound = most(queries) * most(shard) * queries.shape[1]
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ shard.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return queries @ shard.T
    exact = queries.astype(object) @ shard.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``k`` highest scores, ties to the smaller column; ``own`` columns (-1: none) are left out."""
    rows, columns = scores.shape
    width = max(1, columns)
    top = max(abs(int(scores.max(initial=0))), abs(int(scores.min(initial=0)))) + 1
    self_rows = np.flatnonzero(own >= 0)
    if top < (1 << 62) // width:
        # score and column in one number, so that a partial selection also settles the ties
        rank = scores * width + (width - 1 - np.arange(columns))
        rank[self_rows, own[self_rows]] = np.iinfo(np.int64).min
        take = min(k, columns)
        at = np.argpartition(rank, columns - take, axis=1)[:, columns - take :]
        keep = np.take_along_axis(rank, at, 1) > np.iinfo(np.int64).min
        where = np.repeat(np.arange(rows), take).reshape(rows, take)
        return where[keep], at[keep]
    out_rows, out_columns = [], []
    for r in range(rows):
        order = np.lexsort((np.arange(columns), ~scores[r]))
        order = order[order != own[r]][:k]
        out_rows.append(np.full(len(order), r))
        out_columns.append(order)
    return np.concatenate(out_rows), np.concatenate(out_columns)


def cell(k: int):  # noqa: ANN201
    def run(key: tuple, queries: pa.Table, shard: pa.Table) -> Iterator[pa.RecordBatch] | pa.Table:
        names = ["uid", "query_id", "vec_id", "score", "dim", "g"]
        dim, g = key[0].as_py(), key[1].as_py()
        empty = pa.table([pa.array([], pa.int64())] * 4 + [pa.array([], pa.int32())] * 2, names)
        if not len(queries) or not len(shard):
            return empty
        order = np.lexsort((shard["uid"].to_numpy(), shard["vec_id"].to_numpy()))
        ids, uids = shard["vec_id"].to_numpy()[order], shard["uid"].to_numpy()[order]
        vectors = matrix(shard["v"], dim)[order]
        by_uid = np.argsort(uids)
        q_uids, q_ids, q_vectors = queries["uid"].to_numpy(), queries["vec_id"].to_numpy(), matrix(queries["v"], dim)
        step = max(1, BLOCK_SCORES // len(ids))
        parts = []
        for first in range(0, len(q_uids), step):
            some = slice(first, first + step)
            scores = products(q_vectors[some], vectors)
            at = np.searchsorted(uids[by_uid], q_uids[some])
            at = by_uid[np.minimum(at, len(uids) - 1)]
            own = np.where(uids[at] == q_uids[some], at, -1)
            r, c = best(scores, own, k)
            parts.append((q_uids[some][r], q_ids[some][r], ids[c], scores[r, c]))
        columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)]
        n = len(columns[0])
        return pa.table([*columns, pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, g, np.int32))], names)

    return run


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query row its ``k`` best other rows, ties to the smaller id.

    Scores are exact inner products of ``floor(scale * x)``; a sum beyond the range of a long is held at its limits.
    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id; vectors of different lengths are not compared.
    A query with fewer than ``k`` candidates gets all. Repeated ids are rows of their own: a row never finds itself, but finds its
    copies. An empty table gives an empty result. Other columns are not read.

    A cell holds a bounded number of rows of either side, whatever the values, so no key can be hot; copies tie, and the
    selection in a tile keeps ``k`` of them.
    """
    spark = vectors.sparkSession
    ship(spark)
    column = vectors[f"`{vector}`"]
    rows = vectors.where(usable(column) & vectors[f"`{key}`"].isNotNull()).select(
        F.monotonically_increasing_id().alias("uid"), vectors[f"`{key}`"].cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), components(column, scale).alias("v")
    )
    rows = stored(rows, scratch_path(spark, "vectors")).withColumn("dim", F.size("v"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = max(1, -(-counts["n"] // SHARD_TILE), min(slots, -(-counts["n"] // 2048)))
    h = max(1, -(-counts["q"] // QUERY_TILE))
    deal = F.xxhash64("uid")
    queries = rows.where("asks").select("uid", "vec_id", "v", "dim", F.pmod(deal, F.lit(h)).cast("int").alias("h"), F.explode(F.sequence(F.lit(0), F.lit(g - 1))).alias("g"))
    # both sides come from one table: columns of their own keep the co-grouping's two schemas apart
    shards = rows.select(*[F.col(c).alias(c) for c in ("uid", "vec_id", "v", "dim")], F.pmod(deal, F.lit(g)).cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(h - 1))).alias("h"))
    found = queries.groupBy("dim", "g", "h").cogroup(shards.groupBy("dim", "g", "h")).applyInArrow(cell(k), CELL)
    order = [F.col("score").desc(), F.col("vec_id")]
    while g > FAN_IN:
        g = -(-g // FAN_IN)
        found = found.withColumn("g", F.floor(F.col("g") / FAN_IN).cast("int"))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("uid", "query_id", "g").orderBy(*order))).where(F.col("rank") <= k).drop("rank")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("uid", "query_id").orderBy(*order))).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
