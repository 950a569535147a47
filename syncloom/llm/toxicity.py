"""Toxicity by multiple-instance learning: documents have labels, sentences get scores.

A sentence's probability is a logistic function of its words (hashed); a document's is the noisy-or of its sentences. The weights are
fitted to document labels alone, through the noisy-or, so afterwards every sentence has a score of its own and the offending ones are located.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncloom.llm.rows import per_text, ship
from syncloom.llm.textops import ALNUM, LOWER, U64, chunks, word_hash, word_spans

FEATURE_BITS = 18
#: A word counts as itself and as its first bytes, so that inflected and compound forms share what they begin with.
STEM_BYTES, PER_WORD = 4, 2
#: Sentences end at these bytes.
STOPS = np.zeros(256, bool)
STOPS[list(b".!?\n")] = True


@dataclass
class Sentences:
    """Of some texts: the hashed features, where each sentence's begin, and the sentences' texts and bytes."""

    features: np.ndarray
    firsts: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    low = LOWER[data]
    starts, ends, owner = word_spans(low, offsets, ALNUM)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Sentences(none, none, none, none, none)
    stems = ~word_hash(low, starts, np.minimum(ends, starts + STEM_BYTES))
    both = np.stack([word_hash(low, starts, ends), stems], 1).ravel()
    features = (both >> U64(64 - FEATURE_BITS)).astype(np.int32)
    stops = np.cumsum(STOPS[data])[starts]
    fresh = np.concatenate([[True], (stops[1:] != stops[:-1]) | (owner[1:] != owner[:-1])])
    firsts = np.flatnonzero(fresh)
    last = np.append(firsts[1:], len(starts)) - 1
    return Sentences(features, firsts * PER_WORD, owner[firsts], starts[firsts] - offsets[owner[firsts]], ends[last] - offsets[owner[firsts]])


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, s: Sentences) -> np.ndarray:
        if not len(s.firsts):
            return np.zeros(0)
        return np.add.reduceat(self.weights[s.features].astype(np.float64), s.firsts) + self.bias


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def telling(features: list[np.ndarray], y: np.ndarray, least_documents: int, least_z: float) -> np.ndarray:
    """Slots from 1 for the features whose presence goes with the label beyond chance, 0 for all others."""
    size = 1 << FEATURE_BITS
    here, there = np.zeros(size), np.zeros(size)
    for f, label in zip(features, y):
        (here if label else there)[np.unique(f)] += 1
    a, b = max(1, int(y.sum())), max(1, int((~y).sum()))
    share = (here + there) / (a + b)
    z = (here / a - there / b) / np.sqrt(np.maximum(share * (1 - share) * (1 / a + 1 / b), 1e-12))
    chosen = (here + there >= least_documents) & (np.abs(z) >= least_z)
    slot = np.cumsum(chosen)
    slot[~chosen] = 0
    return slot


def fit(features: list[np.ndarray], lengths: list[np.ndarray], labels: np.ndarray, steps: int = 200, rate: float = 0.1, sparsity: float = 1e-4, least_documents: int = 3, least_z: float = 3.0) -> Model:
    """Gradient steps (Adam) on the log-likelihood of the document labels through the noisy-or.

    Words in fewer than ``least_documents`` documents, or as frequent in either kind of document, have no weight; an L1 step
    removes weights that explain nothing. Without both labels, or without words, the model gives every sentence a
    probability near nothing.
    """
    keep = [k for k, f in enumerate(features) if len(f)]
    y = labels[keep].astype(bool)
    if not keep or len(set(y.tolist())) < 2:
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), -12.0)
    slot = telling([features[k] for k in keep], y, least_documents, least_z)
    n = int(slot.max()) + 1
    sizes = np.concatenate([lengths[k] for k in keep])
    per_text_ = np.array([len(lengths[k]) for k in keep])
    of_text = np.cumsum(per_text_) - per_text_
    words = slot[np.concatenate([features[k] for k in keep])].astype(np.int32)
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[words > 0]
    words = words[words > 0]
    theta, bias = np.zeros(n), -np.log(max(2.0, 4 * per_text_.mean() / max(y.mean(), 1e-3)))
    mean, var = np.zeros(n + 1), np.zeros(n + 1)
    total = len(y)
    for step in range(1, steps + 1):
        z = np.bincount(sentence, theta[words], len(sizes)) + bias
        mass = np.maximum(np.add.reduceat(softplus(z), of_text), 1e-9)
        slope = np.where(y, -1 / np.expm1(np.minimum(mass, 50)), 1.0) / total
        g = np.repeat(slope, per_text_) / (1 + np.exp(-np.clip(z, -50, 50)))
        gradient = np.append(np.bincount(words, g[sentence], n), g.sum())
        mean = 0.9 * mean + 0.1 * gradient
        var = 0.99 * var + 0.01 * gradient**2
        speed = rate / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
        move = speed * mean / (1 - 0.9**step)
        bias -= move[n]
        theta -= move[:n]
        theta = np.sign(theta) * np.maximum(np.abs(theta) - speed[:n] * sparsity, 0)
        theta[0] = 0
    return Model(theta[slot].astype(np.float32), float(bias))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """Fit on at most about ``sample`` labelled documents that are not held out, chosen by a hash of their id.

    The bound is on the driver's memory: it receives hashed words of the sampled documents, never texts of all. A
    document with several labels counts as toxic if one says so; null labels say nothing.
    """
    spark = docs.sparkSession
    known = labels.select(labels[f"`{key}`"].alias("_id"), labels[f"`{label}`"].cast("int").alias("_y")).where("_id is not null and _y is not null and not _y < 0")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
    count = known.count()
    if count > sample:
        known = known.where(F.pmod(F.xxhash64(F.lit("toxicity"), "_id"), F.lit(1 << 30)) < int(sample / count * (1 << 30)))
    # about ``sample`` rows of two numbers, whatever the input: a bounded broadcast
    few = docs.select(docs[f"`{key}`"].alias("_id"), docs[f"`{text}`"].alias("_text")).join(F.broadcast(known), "_id")
    schema = T.StructType([T.StructField("f", T.BinaryType()), T.StructField("n", T.BinaryType())])

    def make():  # noqa: ANN202
        def fn(texts: pa.Array) -> list[pa.Array]:
            words, sizes = [b""] * len(texts), [b""] * len(texts)
            for first, data, offsets in chunks(texts):
                s = sentences(data, offsets)
                lengths = np.diff(np.append(s.firsts, len(s.features)))
                at = np.searchsorted(s.texts, np.arange(len(offsets)))
                edge = np.append(s.firsts, len(s.features))[at]
                for k in range(len(offsets) - 1):
                    words[first + k] = s.features[edge[k] : edge[k + 1]].astype(np.int32).tobytes()
                    sizes[first + k] = lengths[at[k] : at[k + 1]].astype(np.int32).tobytes()
            return [pa.array(words, pa.binary()), pa.array(sizes, pa.binary())]

        return fn

    rows = per_text(few, make, schema, "_text", ("_id", "_y")).select("row._id", "row._y", "f", "n").collect()
    rows.sort(key=lambda r: (str(r["_id"]), bytes(r["f"])))
    return fit([np.frombuffer(r["f"], np.int32) for r in rows], [np.frombuffer(r["n"], np.int32) for r in rows], np.array([int(r["_y"] > 0) for r in rows]))


SCHEMA = T.StructType(
    [
        T.StructField("score", T.DoubleType(), False),
        T.StructField(
            "offending",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])),
            False,
        ),
    ]
)


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns), ``score``, ``predicted`` (1 if the score reaches ``threshold``), ``offending`` sentences.

    ``offending`` has the UTF-8 byte range and probability of every sentence whose own probability reaches the threshold. Null and empty
    texts, and texts without words, have no sentence and score 0. Very long texts are scored whole, sentence by
    sentence. Rows are independent; repeated rows get equal scores; an empty table gives an empty result. Only the text is read.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():  # noqa: ANN202
        fitted = shared.value

        def fn(texts: pa.Array) -> list[pa.Array]:
            scores = np.zeros(len(texts))
            found: list[list[dict]] = [[] for _ in range(len(texts))]
            for first, data, offsets in chunks(texts):
                s = sentences(data, offsets)
                if not len(s.firsts):
                    continue
                z = fitted.logits(s)
                mass = np.bincount(s.texts, softplus(z), len(offsets) - 1)
                scores[first : first + len(offsets) - 1] = -np.expm1(-mass)
                p = -np.expm1(-softplus(z))
                for k in np.flatnonzero(p >= threshold).tolist():
                    found[first + int(s.texts[k])].append({"start": int(s.starts[k]), "end": int(s.ends[k]), "score": float(p[k])})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            return [pa.array(scores), pa.array(found, kind)]

        return fn

    return per_text(docs, make, SCHEMA, text, carry).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
