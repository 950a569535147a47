"""Mixing sources to target weights by hash thresholds: histograms, no sorting of rows.

Every row has a hash. A source's budget is a threshold in hash space: rows below it are taken. The sum of words by source
and leading hash bits shows in which bucket a budget runs out; only the rows of that bucket are
counted again by their next bits, and so on. Budgets above a source's size take every row once and a second copy of those
below the threshold, so smaller budgets are always contained in larger ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from syncloom.llm.rows import per_text
from syncloom.llm.textops import SPACED, chunks, word_spans
from syncloom.session import scratch_path, stored

DIGIT = 12
#: Hashes of the id and of the text, then the row's number in the stored table for rows that agree in both.
KEYS = ("_h1", "_h2", "_h3")
LAST = len(KEYS) * 60 // DIGIT
WEIGHTS = (5.0, 2.0, 1.0)


def _digit(k: int) -> Column:
    at = k * DIGIT
    return F.shiftrightunsigned(F.col(KEYS[at // 60]), 60 - DIGIT - at % 60).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("long")


def word_counts(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    def make():  # noqa: ANN202
        def fn(texts: pa.Array) -> list[pa.Array]:
            words = np.zeros(len(texts), np.int64)
            for first, data, offsets in chunks(texts):
                _, _, owner = word_spans(data, offsets, SPACED)
                words[first : first + len(offsets) - 1] = np.bincount(owner, minlength=len(offsets) - 1)
            return [pa.array(words)]

        return fn

    return per_text(docs, make, T.StructType([T.StructField("size", T.LongType(), False)]), text, carry)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, epochs: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, take the weights in turn. Pouring ``share`` of all words in proportion to the
    weights, with a lid of ``epochs`` times a source's size, settles at one level per unit of weight: sources are
    full in the order of lid over weight, the rest share what is left. One row per source goes through the window.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    by = sizes.withColumn("_w", weight).withColumn("_lid", F.col("source_size") * F.lit(float(epochs)))
    by = by.withColumn("_fill", F.col("_lid") / F.col("_w"))
    fill = Window.orderBy("_fill", F.col("source").isNull(), "source")
    done = fill.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(F.lit(0))
    by = by.withColumn("_budget", F.sum("source_size").over(everyone) * F.lit(float(share)))
    left = F.col("_budget") - F.coalesce(F.sum("_lid").over(done), F.lit(0.0))
    others = F.sum("_w").over(everyone) - F.coalesce(F.sum("_w").over(done), F.lit(0.0))
    # the level if this source were the first that is not full; the smallest k with level <= fill is the true one
    by = by.withColumn("_level", left / others)
    by = by.withColumn("_true", F.min(F.when(F.col("_level") <= F.col("_fill"), F.struct("_fill", "_level"))).over(everyone)["_level"])
    target = F.when(F.col("_true").isNull() | (F.col("_true") * F.col("_w") >= F.col("_lid")), F.col("_lid")).otherwise(F.col("_true") * F.col("_w"))
    return by.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the key below which rows are taken, as an array of digits, so that the sum comes nearest ``_budget``.

    Each round sums words by source and the next twelve bits, only in the bucket where the budget ran out; a source is
    done when that bucket holds one row or its budget is met exactly. Tables of one row per source and bucket, no row lists.
    """
    state = budgets.select("source", "_budget", F.lit(0.0).alias("_taken"), F.array().cast("array<long>").alias("_cut"), F.lit(True).alias("_open"))
    spark = rows.sparkSession
    for k in range(LAST):
        state = stored(state, scratch_path(spark, "mix-state"))
        if not state.where("_open").take(1):
            break
        here = state.where("_open").withColumnRenamed("source", "_s")
        same = F.col("source").eqNullSafe(F.col("_s"))
        for j in range(k):
            same = same & (_digit(j) == F.element_at("_cut", j + 1))
        cells = rows.join(here, same).groupBy("source", _digit(k).alias("_d")).agg(F.sum("size").alias("_b"), F.count(F.lit(1)).alias("_n"))
        cells = cells.join(here, F.col("source").eqNullSafe(F.col("_s")))
        hi = F.col("_taken") + F.sum("_b").over(Window.partitionBy("source").orderBy("_d"))
        cells = cells.withColumn("_hi", hi).withColumn("_lo", F.col("_hi") - F.col("_b"))
        step = cells.where("_lo <= _budget and _budget < _hi").select(F.col("source").alias("_s"), "_d", "_lo", "_hi", "_n", F.col("_budget").alias("_goal"))
        last = F.lit(k == LAST - 1) | (F.col("_n") == 1)
        upper = F.col("_hi") - F.col("_goal") < F.col("_goal") - F.col("_lo")
        joined = state.join(step, F.col("source").eqNullSafe(F.col("_s")), "left")
        moved = F.col("_d").isNotNull()
        # A bucket that cannot be split further is taken whole if that comes nearer.
        cut = F.when(F.col("_open") & moved, F.concat("_cut", F.array(F.col("_d") + F.when(last & upper, 1).otherwise(0)))).otherwise(F.col("_cut"))
        # An open source whose budget exceeds all that is left in its bucket takes the bucket to its end.
        full = F.col("_open") & ~moved
        state = joined.select(
            "source",
            "_budget",
            F.when(moved, F.col("_lo").cast("double")).otherwise(F.col("_taken")).alias("_taken"),
            F.when(full, F.concat("_cut", F.array(F.lit(1 << DIGIT)))).otherwise(cut).alias("_cut"),
            (F.col("_open") & moved & (F.col("_lo") < F.col("_goal")) & ~last).alias("_open"),
        )
    return state.select("source", "_cut")


def below(cut: Column) -> Column:
    """Whether a row's digits come before the threshold's, as numbers read from the left."""
    out = F.lit(False)
    for k in reversed(range(LAST)):
        at = F.get(cut, F.lit(k))
        out = F.when(at.isNull(), F.lit(False)).when(_digit(k) != at, _digit(k) < at).otherwise(out)
    return out


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    epochs: int = 2,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``row`` (the carried columns), ``doc_id, size, source_size, target, taken, copies`` of every row.

    A row's size is its number of words; ``copies`` is how often the mix takes it, ``taken`` the words that makes. Every
    source's taken words come to its target but for half of the row at the threshold, and no row is taken more than ``epochs`` times.

    A null or empty text has no words; it is taken like others by its hash. The null source is a source, the last in order. Rows
    with equal ids are told apart by text, then by their number in the stored table, so a group of any size can be cut. An
    empty table, or one without words, takes nothing. Reruns agree: thresholds depend on ids and texts only. Columns
    other than the id, source and text are carried if asked for and never read, whatever their names.
    """
    spark = docs.sparkSession
    carry = [key] if carry is None else list(carry)
    counted = word_counts(docs.withColumn("_all", F.struct(docs[f"`{key}`"].alias("doc_id"), docs[f"`{source}`"].cast("string").alias("source"), F.xxhash64(docs[f"`{text}`"].cast("string")).alias("h"), F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row"))).select("_all", docs[f"`{text}`"].alias("_text")), "_text", ["_all"])
    top = F.lit((1 << 60) - 1)
    rows = counted.select(
        F.col("row._all.row").alias("row"),
        F.col("row._all.doc_id").alias("doc_id"),
        F.col("row._all.source").alias("source"),
        "size",
        F.xxhash64(F.lit("mix"), F.col("row._all.doc_id")).bitwiseAND(top).alias("_h1"),
        F.col("row._all.h").bitwiseAND(top).alias("_h2"),
        F.monotonically_increasing_id().bitwiseAND(top).alias("_h3"),
    )
    rows = stored(rows, scratch_path(spark, "mix-rows"))
    slim = rows.select("source", "size", *KEYS)
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(sizes, weights, share, epochs), scratch_path(spark, "mix-targets"))
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs))).otherwise(F.lit(0)).cast("int")
    plan = plan.withColumn("_whole", whole).withColumn("_budget", F.col("target") - F.col("_whole") * F.col("source_size"))
    cuts = thresholds(slim, plan.where("source_size > 0"))
    plan = plan.join(cuts.withColumnRenamed("source", "_c"), F.col("source").eqNullSafe(F.col("_c")), "left").drop("_c").withColumnRenamed("source", "_s")
    # one row per source; a hot source is a broadcast while sources are few, and split by the skew join beyond
    taken = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")))
    copies = F.least(F.col("_whole") + F.coalesce(below(F.col("_cut")), F.lit(False)).cast("int"), F.lit(epochs))
    taken = taken.withColumn("copies", copies)
    return taken.select("row", "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
