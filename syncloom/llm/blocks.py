"""Blocks of documents asking partitions of a key space: how work on billions of keys moves as packed arrays.

A task gathers its documents into blocks. A block sorts its keys, keeps one of each (so a key that a third of all documents
share arrives once per block, not once per document), and sends every partition of the key space one row with the keys
that fall there and where in the block they stand. A partition answers each block with one row, which names places of
the block; the block's own row, which describes its documents, meets the answers by the block's name. That is made of the
documents' digests, so a task that runs again after a lost executor sends the same rows.

Rows are ``block, part, body``; a negative part marks a block's own row, which passes the partitions unread.
"""

from __future__ import annotations

import gc
import hashlib
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from syncloom.llm.rows import field, ship
from syncloom.llm.textops import U64, chunks
from syncloom.session import scratch_path, stored

BLOCK_BYTES, PART_BYTES = 24 << 20, 8 << 20
ROWS = "block binary, part int, body binary"
CAP = (1 << 15) - 1


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of queries that are over, which it does when the driver's JVM collects garbage.

    Twice, with a moment between: the Python side lets go of a plan first, then the JVM finds it unused. Nothing but the
    time at which disk is freed depends on it.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.4)
        spark.sparkContext._jvm.System.gc()


def text_classes(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, class`` of every row, and ``class, id, text`` once per different text, with its smallest id (null before all).

    Copies, however many, are left as two small columns. Which row stands for a class is decided by a join on the class,
    whose hot keys adaptive execution can split; the classes meet it pre-aggregated.
    """
    spark = docs.sparkSession
    body = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    given = docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), body.alias("text"))
    given = given.withColumn("class", F.unhex(F.md5(F.col("text").cast("binary"))))
    rows = stored(given.select("doc_id", "class"), scratch_path(spark, "rows"))
    ids = rows.groupBy("class", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    first = ids.groupBy("class").agg(F.min(F.struct(F.col("doc_id"), F.col("n"))).alias("f")).select(F.col("class").alias("_c"), F.col("f.doc_id").alias("id"), F.col("f.n").alias("n"))
    first = stored(first, scratch_path(spark, "first"))
    chosen = given.join(first, (F.col("class") == F.col("_c")) & F.col("doc_id").eqNullSafe(F.col("id")))
    texts = chosen.where("n = 1").select("class", "id", "text")
    if first.where("n > 1").take(1):  # rows that agree in id and text: one of them, brought together by class after a local choice
        again = chosen.where("n > 1").groupBy("class").agg(F.any_value("id").alias("id"), F.any_value("text").alias("text"))
        texts = texts.unionByName(again)
    path = scratch_path(spark, "texts")
    texts.write.option("compression", "zstd").parquet(path)
    return rows, spark.read.schema("class binary, id long, text string").parquet(path)


def parts_for(texts: DataFrame) -> int:
    """So many partitions of the key space that one holds what some megabytes of text give, and no fewer than the session's."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def planes(values: np.ndarray, width: int) -> bytes:
    """Whole numbers byte by byte of equal weight, so that compression finds the zeros."""
    return values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def numbers(data: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel()


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return planes(np.diff(keys, prepend=U64(0)), 8)


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(numbers(data, 8), dtype=U64)


def joined(*parts: bytes) -> bytes:
    """Byte strings with their lengths in front."""
    return np.array([len(parts), *map(len, parts)], "<i8").tobytes() + b"".join(parts)


def split(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", n, 8)
    ends = 8 + 8 * n + np.cumsum(sizes)
    return [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]


def batch_of(rows: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int32(), pa.binary()))], ["block", "part", "body"])


def own_row(classes: list[bytes], parts: int, *about: bytes) -> tuple[bytes, int, bytes]:
    """The row that names a block and describes its documents; own rows are spread over the partitions."""
    names = b"".join(classes)
    block = hashlib.md5(names).digest()
    return block, -1 - zlib.crc32(block) % parts, joined(names, *about)


#: Answers of a partition: from the blocks' bodies to as many bodies.
Answer = Callable[[list[bytes]], list[bytes]]
#: Rows of a block: from its documents' digests, its own row's other parts, and the answers.
Assemble = Callable[[list[bytes], list[bytes], list[bytes]], pa.Table]


def ask(rows: DataFrame, answer: Answer, assemble: Assemble, schema: str) -> DataFrame:
    def in_part(table: pa.Table) -> pa.Table:
        if table["part"][0].as_py() < 0:
            return table
        bodies = answer(table["body"].to_pylist())
        return pa.table([table["block"], table["part"], pa.array(bodies, pa.binary())], ["block", "part", "body"])

    def in_block(table: pa.Table) -> pa.Table:
        own, answers = [], []
        for part, body in zip(table["part"].to_pylist(), table["body"].to_pylist()):
            (own if part < 0 else answers).append(body)
        names, *about = split(own[0])
        return assemble([names[k : k + 16] for k in range(0, len(names), 16)], about, answers)

    return rows.groupBy("part").applyInArrow(in_part, ROWS).groupBy("block").applyInArrow(in_block, schema)


#: Keys of some texts (lists in order), how many each text has, and another number for each text.
KeyFunction = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
#: ``(classes, keys per document, the other number, places, documents, keys)`` of a block: the places (in the order of the documents'
#: keys, increasing) whose keys occur in several documents, in how many, and the keys if asked for.
Finish = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None], pa.Table]


def key_rows(classes: list[bytes], counts: list[np.ndarray], others: list[np.ndarray], keys: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """A block's rows: per partition its different keys, in how many of the block's documents each is, and their places."""
    every, per = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    ordered, owners = every[order], np.repeat(np.arange(len(per), dtype=np.int32), per)[order]
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    other = fresh.copy()
    other[1:] |= owners[1:] != owners[:-1]
    first = np.flatnonzero(fresh)
    documents = np.minimum(np.add.reduceat(other, first, dtype=np.int64), CAP) if len(first) else first
    edges = np.searchsorted(((ordered >> U64(32)) * U64(parts)) >> U64(32), np.arange(parts + 1))
    key_edges = np.searchsorted(first, edges)
    own = own_row(classes, parts, planes(per, 4), planes(np.concatenate(others), 8))
    rows = [own]
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b, u, v = edges[p], edges[p + 1], key_edges[p], key_edges[p + 1]
        rows.append((own[0], p, joined(pack(ordered[first[u:v]]), planes(documents[u:v], 2), planes(order[a:b], 4), np.packbits(fresh[a:b]).tobytes())))
    return batch_of(rows)


def several(with_keys: bool) -> Answer:
    """The places of a block's keys that occur in several documents of all blocks, and in how many."""

    def answer(bodies: list[bytes]) -> list[bytes]:
        asks = [split(b) for b in bodies]
        keys = [unpack(a[0]) for a in asks]
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        documents = np.bincount(inverse, np.concatenate([numbers(a[1], 2) for a in asks]), len(every))
        totals = np.minimum(documents, CAP).astype(np.uint16)[inverse]
        edges, out = np.cumsum([0, *map(len, keys)]), []
        for a, b, ks, (_, _, at, fresh) in zip(edges, edges[1:], keys, asks):
            places = numbers(at, 4)
            of = np.cumsum(np.unpackbits(np.frombuffer(fresh, np.uint8), count=len(places))) - 1
            found = totals[a:b][of]
            some = np.flatnonzero(found >= 2)
            out.append(joined(planes(places[some], 4), planes(found[some], 2), planes(ks[of[some]], 8) if with_keys else b""))
        return out

    return answer


def frequencies(texts: DataFrame, keys_of: KeyFunction, finish: Finish, schema: str, parts: int, with_keys: bool = False) -> DataFrame:
    """Rows that ``finish`` makes of each block's documents, once it is known in how many documents each key occurs."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: list[bytes] = []
        counts, others, keys = [], [], []
        size = 0
        for batch in batches:
            names = field(batch, "class").to_pylist()
            for first, data, offsets in chunks(field(batch, "text")):
                k, n, more = keys_of(data, offsets)
                classes += names[first : first + len(n)]
                keys.append(k)
                counts.append(n)
                others.append(more)
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield key_rows(classes, counts, others, keys, parts)
                    classes, counts, others, keys, size = [], [], [], [], 0
        if classes:
            yield key_rows(classes, counts, others, keys, parts)

    def assemble(classes: list[bytes], about: list[bytes], answers: list[bytes]) -> pa.Table:
        found = [split(a) for a in answers]
        places = np.concatenate([np.zeros(0, np.uint32), *(numbers(f[0], 4) for f in found)])
        order = np.argsort(places)
        documents = np.concatenate([np.zeros(0, np.uint16), *(numbers(f[1], 2) for f in found)])[order]
        keys = np.concatenate([np.zeros(0, U64), *(numbers(f[2], 8) for f in found)])[order] if with_keys else None
        return finish(classes, numbers(about[0], 4).astype(np.int64), numbers(about[1], 8).astype(np.int64), places[order].astype(np.int64), documents.astype(np.int64), keys)

    return ask(texts.select("class", "text").mapInArrow(run, ROWS), several(with_keys), assemble, schema)


def owners(per: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The documents of places in the order of the documents' keys."""
    return np.searchsorted(np.cumsum(per), places, "right")
