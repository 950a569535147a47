"""A training corpus from the documents: filtered, without near copies, decontaminated, mixed and sharded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncloom.llm.decontamination import decontaminate
from syncloom.llm.mixing import mix
from syncloom.llm.ngram_join import drop_near_copies
from syncloom.llm.sharding import histogram_shards
from syncloom.llm.toxicity import toxicity, train
from syncloom.session import scratch_path, stored


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones among them, does not reject."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity(docs, model, carry=tuple(docs.columns)).where("predicted = 0").select("row.*")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; the number of characters follows the text."""
    out = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once, or twice."""
    taken = mix(docs, carry=docs.columns)
    return taken.where("copies > 0").withColumn("row", F.explode(F.array_repeat("row", F.col("copies")))).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every document of the mix goes."""
    return histogram_shards(docs)


STAGES = [("toxicity", clean), ("ngram_join", distinct), ("decontamination", decontaminated), ("mixing", mixed), ("sharding", sharded)]

#: Neither trained scores nor hash thresholds can be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), scratch_path(spark, f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
