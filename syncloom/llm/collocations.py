"""Phrase collocations by vertical partitioning: prefix groups that fit memory, one depth-truncated suffix tree each.

1. Blocks of texts of one language ask partitions of the vocabulary how often their words occur at all. A partition numbers the
   words that are frequent enough and packs them, as one-word prefixes, into groups of at most a budget of suffixes.
   Words that no frequent phrase can hold end a suffix.
2. A prefix with more suffixes than the budget is continued by one more word, and so on; the counts of such prefixes, at most
   (all words / budget) a level, are exact and known to all.
   Pairs of neighbouring words are counted first: a bin of pairs tells each block which of its pairs are frequent, and texts
   are cut where a pair is not, for no longer frequent phrase reaches across.
3. Every block sends each group its different suffixes, three to five words of such stretches, with their counts. A group sorts what it got; runs
   of suffixes that agree in d words are the tree's nodes at depth d, and a node's total is how often its phrase occurs.
4. Frequent phrases meet the counts of their parts and of their extensions by joins on the phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from syncloom.llm.blocks import joined, numbers, pack, planes, release, split, unpack
from syncloom.llm.rows import field, ship
from syncloom.llm.textops import LOWER, U64, chunks, distinct_words, mix, word_hash, word_spans
from syncloom.operators.skew import join_unique
from syncloom.session import discard, scratch_path, stored

DEPTH, LEAST, TOP, COVER = 5, 100, 2000, 100
BLOCK_BYTES, PART_BYTES, BUDGET = 2 << 20, 8 << 20, 1 << 17
BATCH_BYTES = 4 << 20
#: At most so many prefixes of a level are continued; with more words than this times the budget the budget grows instead.
MOST_PREFIXES = 1 << 21
#: Pairs of words in a bin, and suffixes in a partition of groups, about.
BIN_PAIRS, PART_SUFFIXES = 1 << 22, 1 << 19
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAKS
WORD[[0x20, 0x09]] = False

OWN, ASK, WORDS = 0, 1, 2
ROWS = "kind int, block binary, lang string, part int, n long, body binary"
RARE, SPLIT = 0, -1  # groups of words: not frequent, or a prefix that is continued
CODEC = "zstd"


def squeezed(*parts: bytes) -> bytes:
    raw = joined(*parts)
    return np.array([len(raw)], "<i8").tobytes() + pa.Codec(CODEC).compress(raw, asbytes=True)


def unpacked(body: bytes) -> list[bytes]:
    return split(pa.Codec(CODEC).decompress(body[8:], int(np.frombuffer(body, "<i8", 1)[0]), asbytes=True))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "block", "lang", "part", "n", "body"])


def bytes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of some stretches, one behind the other."""
    length = ends - starts
    shift = np.repeat(starts - (np.cumsum(length) - length), length)
    return data[np.arange(int(length.sum())) + shift]


def block_rows(lang: str, name: bytes, texts: list[tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    """A block's rows: its words as numbers of its own vocabulary (0 between pieces, the most frequent the smallest) with their places
    there, and per partition its words and counts.
    """
    data = np.concatenate([d for d, _ in texts])
    bases = np.cumsum([0, *(len(d) for d, _ in texts)])
    offsets = np.concatenate([[0], *(o[1:] + b for (_, o), b in zip(texts, bases))])
    starts, ends, owner = word_spans(data, offsets, WORD)
    if not len(starts):
        return batch_of([])
    piece = np.cumsum(BREAKS[data])[starts] + owner
    first, number = distinct_words(data, starts, ends)
    counts = np.bincount(number, minlength=len(first))
    # words of a partition lie together in the vocabulary
    hashes = word_key(lang, data, starts[first], ends[first])
    part = ((hashes >> U64(32)) * U64(parts)) >> U64(32)
    order = np.argsort(part, kind="stable")
    first, counts, part = first[order], counts[order], part[order].astype(np.int64)
    often = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order[often]] = np.arange(len(order))
    fresh = np.flatnonzero(np.diff(piece)) + 1  # a 0 before every piece but the first
    stream = np.zeros(len(number) + len(fresh), np.int64)
    at = np.arange(len(number)) + np.searchsorted(fresh, np.arange(len(number)), "right")
    stream[at] = rank[number] + 1
    rows = [(OWN, name, lang, -1, len(number), squeezed(planes(stream, 4), planes(often, 4)))]
    edges = np.searchsorted(part, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[p], edges[p + 1]
        s, e = starts[first[a:b]], ends[first[a:b]]
        rows.append((ASK, name, lang, p, b - a, squeezed(bytes_of(data, s, e).tobytes(), planes(e - s, 4), planes(counts[a:b], 4))))
    return batch_of(rows)


def word_key(lang: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a word of a language is counted."""
    salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return mix(word_hash(data, starts, ends) ^ U64(salt))


def blocks(docs: DataFrame, text: str, lang: str, parts: int, block_bytes: int) -> DataFrame:
    ship(docs.sparkSession)
    given = docs.select(F.coalesce(docs[f"`{lang}`"].cast("string"), F.lit("und")).alias("lang"), docs[f"`{text}`"].cast("string").alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = done = 0
        task = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done
            for name in sorted(held):
                seen = hashlib.md5(f"{task} {done}".encode())
                for data, _ in held[name]:
                    seen.update(data)
                done += 1
                yield block_rows(name, seen.digest(), held[name], parts)

        for batch in batches:
            langs = field(batch, "lang").dictionary_encode()
            of = langs.indices.to_numpy(zero_copy_only=False)
            for code, name in enumerate(langs.dictionary.to_pylist()):
                for _, data, offsets in chunks(field(batch, "text").filter(pa.array(of == code))):
                    held.setdefault(name, []).append((LOWER[data], offsets))
                    size += len(data)
                    if size >= block_bytes:
                        yield from flush()
                        held, size = {}, 0
        yield from flush()

    return given.mapInArrow(run, ROWS)


def vocabulary(rows: DataFrame, least: int, budget: int) -> DataFrame:
    """Answers of the vocabulary's partitions, in rows of the same kind: to every block the number and group of each of its
    words, in its order; and the frequent words themselves with their counts, per language.

    A word's number is its partition and its place there in byte order, so it is the same whenever it is computed.
    """

    def in_part(table: pa.Table) -> pa.Table:
        out = []
        p, index, bin_ = table["part"][0].as_py(), 1, 0
        langs = table["lang"].to_pylist()
        for lang in sorted(set(langs)):
            some = table.filter(pa.array([x == lang for x in langs]))
            asks = [unpacked(b) for b in some["body"].to_pylist()]
            data = np.frombuffer(b"".join(a[0] for a in asks), np.uint8)
            ends = np.cumsum(np.concatenate([numbers(a[1], 4).astype(np.int64) for a in asks]))
            starts = np.concatenate([[0], ends[:-1]])
            first, number = distinct_words(data, starts, ends)
            counts = np.concatenate([numbers(a[2], 4).astype(np.int64) for a in asks])
            total = np.bincount(number, counts, len(first)).astype(np.int64)
            often = np.flatnonzero(total >= least)
            words = [data[a:b].tobytes() for a, b in zip(starts[first[often]].tolist(), ends[first[often]].tolist())]
            order = sorted(range(len(words)), key=words.__getitem__)
            words, often = [words[k] for k in order], often[order]
            ids, groups = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
            ids[often] = (p << 32) + index + np.arange(len(often))
            index += len(often)
            size = np.where(total[often] > budget, 0, total[often])
            reach = np.cumsum(size)
            groups[often] = np.where(total[often] > budget, SPLIT, (p << 24) + bin_ + 1 + np.maximum(reach - 1, 0) // budget)
            bin_ += 1 + int(reach[-1]) // budget if len(often) else 0
            out.append((WORDS, b"", lang, p, len(often), joined(b"".join(words), planes(np.array([len(w) for w in words], np.int64), 4), planes(ids[often], 8), planes(total[often], 8))))
            at = 0
            for block, n in zip(some["block"].to_pylist(), some["n"].to_pylist()):
                mine = number[at : at + n]
                at += n
                out.append((ASK, block, lang, p, n, squeezed(planes(ids[mine], 8), planes(groups[mine], 8))))
        return pa.Table.from_batches([batch_of(out)])

    return rows.where(F.col("kind") == ASK).groupBy("part").applyInArrow(in_part, ROWS)


ENCODED = "block binary, lang string, ids binary, groups binary, stream binary"


def encoded_row(block: bytes, lang: str, ids: np.ndarray, groups: np.ndarray, stream: np.ndarray) -> pa.Table:
    """A block with the words that its stream still has; no row without any."""
    left = np.bincount(stream, minlength=len(ids) + 1)[1:] > 0
    place = np.concatenate([[0], np.cumsum(left) * left])
    columns = [[block], [lang], [planes(ids[left], 8)], [planes(groups[left], 8)], [squeezed(planes(place[stream], 4))]]
    kinds = (pa.binary(), pa.string(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c if len(stream) else [], k) for c, k in zip(columns, kinds)], ["block", "lang", "ids", "groups", "stream"])


def decoded(ids: bytes, groups: bytes, stream: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return numbers(ids, 8).astype(np.int64), numbers(groups, 8).astype(np.int64), numbers(unpacked(stream)[0], 4).astype(np.int64)


def stretches(stream: np.ndarray, least: int) -> np.ndarray:
    """Stretches of ``least`` words at least, one 0 behind each."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], stream > 0, [False]]).astype(np.int8)))
    first, end = edge[::2], edge[1::2]
    some = end - first >= least
    step = np.zeros(len(stream) + 2, np.int64)
    step[first[some]] = 1
    step[end[some] + 1] -= 1
    return stream[np.cumsum(step)[: len(stream)] > 0]


def encoded(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Every block with its frequent words' numbers and groups, and its text as places among them from 1, 0 where a suffix ends."""

    def in_block(table: pa.Table) -> pa.Table:
        kinds, bodies, parts = (table[c].to_pylist() for c in ("kind", "body", "part"))
        own = kinds.index(OWN)
        found = [unpacked(bodies[k]) for k in sorted((k for k, kind in enumerate(kinds) if kind == ASK), key=parts.__getitem__)]
        ids = np.concatenate([numbers(f[0], 8) for f in found]).astype(np.int64)
        groups = np.concatenate([numbers(f[1], 8) for f in found]).astype(np.int64)
        stream, of = (numbers(x, 4).astype(np.int64) for x in unpacked(bodies[own]))
        if len(of) != len(ids):
            raise ValueError("a block's words have no answer: its input changed between two runs of a task")
        ids, groups = ids[of], groups[of]
        often = np.flatnonzero(ids)
        place = np.zeros(len(ids) + 1, np.int64)
        place[often + 1] = np.arange(len(often)) + 1
        return encoded_row(table["block"][own].as_py(), table["lang"][own].as_py(), ids[often], groups[often], stretches(place[stream], 2))

    both = rows.where(F.col("kind") == OWN).unionByName(answers.where(F.col("kind") == ASK))
    return both.groupBy("block").applyInArrow(in_block, ENCODED)


def pairs_of(ids: np.ndarray, groups: np.ndarray, stream: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbouring words of a block: the words' numbers in order, the different pairs in order as places among them, how often
    each occurs, its bin, where pairs begin in the stream, and which one begins there.

    Pairs go by their first word's group, those of a continued prefix by their hash.
    """
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    at = np.flatnonzero((stream[:-1] > 0) & (stream[1:] > 0))
    code, which, n = np.unique(rank[stream[at] - 1] * len(ids) + rank[stream[at + 1] - 1], return_inverse=True, return_counts=True)
    pair = np.stack(np.divmod(code, max(1, len(ids))), 1)
    names, group = ids[order], groups[order][pair[:, 0]]
    part = np.where(group == SPLIT, bin_of(names[pair], bins), (mix(group.astype(U64)) % U64(bins)).astype(np.int64))
    return names, pair, n, part, at, which


def pair_asks(texts: DataFrame, bins: int) -> DataFrame:
    """From each block to each bin one row: its different pairs, with a vocabulary of their own, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, lang, *packed = (field(batch, c)[k].as_py() for c in ("block", "lang", "ids", "groups", "stream"))
                names, pair, n, part, _, _ = pairs_of(*decoded(*packed), bins)
                order = np.argsort(part, kind="stable")
                edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
                rows = []
                for a, b in zip(edges.tolist(), edges[1:].tolist()):
                    mine = order[a:b]
                    own, inside = np.unique(pair[mine], return_inverse=True)
                    first, second = inside.reshape(-1, 2).T
                    body = squeezed(pack(names[own].astype(U64)), planes(np.diff(first, prepend=0), 4), planes(second, 4), planes(n[mine], 4))
                    rows.append((ASK, block, lang, int(part[mine[0]]), b - a, body))
                yield batch_of(rows)

    return texts.mapInArrow(run, ROWS)


def pair_answers(asks: DataFrame, least: int) -> DataFrame:
    """To every block a bit for each of its pairs, whether it is frequent; and the frequent pairs themselves with their counts."""

    def in_bin(table: pa.Table) -> pa.Table:
        bodies = [unpacked(b) for b in table["body"].to_pylist()]
        own = [unpack(b[0]) for b in bodies]
        names, place = np.unique(np.concatenate(own), return_inverse=True)
        base = np.cumsum([0, *map(len, own)]).tolist()
        first = np.concatenate([place[x + np.cumsum(numbers(b[1], 4), dtype=np.int64)] for x, b in zip(base, bodies)])
        second = np.concatenate([place[x + numbers(b[2], 4).astype(np.int64)] for x, b in zip(base, bodies)])
        code, which = np.unique(first * len(names) + second, return_inverse=True)
        total = np.bincount(which, np.concatenate([numbers(b[3], 4) for b in bodies]), len(code)).astype(np.int64)
        often = np.flatnonzero(total >= least)
        bits = (total >= least)[which]
        lang, p = table["lang"][0].as_py(), table["part"][0].as_py()
        out = [(WORDS, b"", lang, p, len(often), joined(keys_of(names[np.stack(np.divmod(code[often], len(names)), 1)]).tobytes(), planes(total[often], 8)))]
        at = 0
        for block, n in zip(table["block"].to_pylist(), table["n"].to_pylist()):
            out.append((ASK, block, lang, p, n, np.packbits(bits[at : at + n]).tobytes()))
            at += n
        return pa.Table.from_batches([batch_of(out)])

    return asks.groupBy("lang", "part").applyInArrow(in_bin, ROWS)


def pairs_from(answers: DataFrame) -> DataFrame:
    """The frequent pairs, as phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, body in zip(field(batch, "lang").to_pylist(), field(batch, "body").to_pylist()):
                keys, total = split(body)
                n = len(keys) // 16
                yield phrase_batch([lang] * n, [2] * n, [keys[16 * k : 16 * k + 16] for k in range(n)], numbers(total, 8).tolist())

    return answers.where(F.col("kind") == WORDS).select("lang", "body").mapInArrow(run, PHRASES)


def cut(texts: DataFrame, answers: DataFrame, bins: int) -> DataFrame:
    """The blocks with a 0 between the words of every pair that is not frequent, and of their stretches those of three words at least."""

    def in_block(table: pa.Table) -> pa.Table:
        parts = table["part"].to_pylist()
        own = parts.index(-1)
        block, lang, *packed = (table[c][own].as_py() for c in ("block", "lang", "ids", "groups", "stream"))
        ids, groups, stream = decoded(*packed)
        _, pair, _, part, at, which = pairs_of(ids, groups, stream, bins)
        order = np.argsort(part, kind="stable")
        if set(parts) - {-1} != set(part.tolist()):
            raise ValueError("a block's pairs have no answer")
        often = np.zeros(len(pair), bool)
        for p, bits in zip(parts, table["stream"].to_pylist()):
            if p >= 0:
                a, b = np.searchsorted(part, [p, p + 1], sorter=order)
                often[order[a:b]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        stream = np.insert(stream, at[~often[which]] + 1, 0)
        return encoded_row(block, lang, ids, groups, stretches(stream, 3))

    own = texts.withColumn("part", F.lit(-1))
    none = F.lit(None).cast("binary")
    asked = answers.where(F.col("kind") == ASK).select("block", "lang", none.alias("ids"), none.alias("groups"), F.col("body").alias("stream"), "part")
    return own.unionByName(asked).groupBy("block").applyInArrow(in_block, ENCODED)


def suffixes(stream: np.ndarray, depth: int) -> np.ndarray:
    """Each word with the words after it, ``depth`` in all, 0 behind the end; only those of two words at least."""
    padded = np.concatenate([stream, np.zeros(depth, np.int64)]).astype(np.int32)
    first = np.flatnonzero((padded[: len(stream)] > 0) & (padded[1 : len(stream) + 1] > 0))
    table = np.empty((len(first), depth), np.int32)
    for k in range(depth):
        table[:, k] = padded[first + k]
        if k > 1:
            table[table[:, k - 1] == 0, k] = 0
    return table


def counted(table: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, and how often each occurs."""
    if not len(table):
        return table, np.zeros(0, np.int64)
    order = np.lexsort(table.T[::-1])
    table = table[order]
    first = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(1)]))
    totals = np.diff(np.append(first, len(order))) if weights is None else np.add.reduceat(weights[order], first)
    return table[first], totals


def keys_of(ids: np.ndarray) -> np.ndarray:
    """Phrases as bytes: eight of each word's number."""
    return np.ascontiguousarray(ids.astype(">u8")).view(f"V{8 * ids.shape[1]}").ravel()


def members(table: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each row, as a phrase, is among the sorted known ones."""
    if not len(known) or not len(table):
        return np.zeros(len(table), bool)
    keys = np.ascontiguousarray(table.astype(">u8")).view(f"S{8 * table.shape[1]}").ravel()
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def known_phrases(keys: list[bytes], depth: int) -> np.ndarray:
    """Sorted for ``members``; numbers are below 2^63 and above 0, and numpy drops only zeros at the end of both sides alike."""
    return np.sort(np.array(keys, f"S{8 * depth}"))


PHRASES = "lang string, depth int, key binary, f long"


def phrase_batch(lang: list[str], depth: list[int], keys: list[bytes], f: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(depth, pa.int32()), pa.array(keys, pa.binary()), pa.array(f, pa.int64())], ["lang", "depth", "key", "f"])


SUFFIXES = "lang string, grp long, body binary"


def suffix_body(names: np.ndarray, table: np.ndarray, counts: np.ndarray, deep: np.ndarray) -> bytes:
    """Suffixes with a vocabulary of their own, as packed columns; the words of most suffixes have the smallest places."""
    own, inside = np.unique(table, return_inverse=True)
    order = np.argsort(-np.bincount(inside.ravel(), minlength=len(own)), kind="stable")
    place = np.empty(len(own), np.int64)
    place[order] = np.arange(len(own))
    inside = place[inside].reshape(table.shape)
    return squeezed(planes(names[own[order]], 8), planes(counts, 4), planes(deep, 1), *(planes(inside[:, k], 4) for k in range(table.shape[1])))


def bodies_of(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers in order (0 first), suffixes as places among them, their counts and continued words, of many bodies."""
    parts = [unpacked(b) for b in bodies]
    names, place = np.unique(np.concatenate([[0], *(numbers(p[0], 8).astype(np.int64) for p in parts)]), return_inverse=True)
    place = place.astype(np.int32)[1:]
    edges = np.cumsum([0, *(len(p[0]) // 8 for p in parts)])
    table = np.empty((sum(len(p[2]) for p in parts), depth), np.int32)
    at = 0
    for p, base in zip(parts, edges.tolist()):
        n = len(p[2])
        for k in range(depth):
            table[at : at + n, k] = place[base + numbers(p[3 + k], 4).astype(np.int64)]
        at += n
    counts = np.concatenate([numbers(p[1], 4) for p in parts]).astype(np.int64)
    return names, table, counts, np.concatenate([numbers(p[2], 1) for p in parts]).astype(np.int8)


def sent(lang: str, names: np.ndarray, table: np.ndarray, counts: np.ndarray, deep: np.ndarray, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each group with its suffixes, in batches of bounded size."""
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
    out, size = [], 0
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        mine = order[a:b]
        out.append((lang, int(group[mine[0]]), suffix_body(names, table[mine], counts[mine], deep[mine])))
        size += len(out[-1][2])
        if size >= BATCH_BYTES or b == len(order):
            columns = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.binary()))], ["lang", "grp", "body"])
            out, size = [], 0


def bin_of(phrases: np.ndarray, bins: int) -> np.ndarray:
    """A bin by the hash of a phrase's word numbers, a phrase a row."""
    hashed = np.zeros(len(phrases), U64)
    for k in range(phrases.shape[1]):
        hashed = mix(hashed + phrases[:, k].astype(U64))
    return (hashed % U64(bins)).astype(np.int64)


def continued(spark: SparkSession, texts: DataFrame, words: DataFrame, pairs: DataFrame, budget: int, bins: int, depth: int) -> tuple[list[np.ndarray], DataFrame]:
    """Prefixes of each length that have more suffixes than the budget, sorted, and those of three words or more with their counts.

    Words and pairs are counted already. A longer prefix's one-word continuations are counted over all blocks if it is such a prefix itself: a block
    sends each bin its different ones with their counts in one row, so a level exchanges at most one continuation per word. What comes to the driver
    is at most (all words / budget) prefixes a level, and no more than ``MOST_PREFIXES``.
    """
    levels, tables = [], [spark.createDataFrame([], PHRASES)]
    for d in range(1, depth):
        often = words if d == 1 else pairs if d == 2 else tables[-1]
        level = [bytes(r["key"]) for r in often.where(F.col("f") > budget).select("key").collect()]
        if not level:
            break
        levels.append(known_phrases(level, d))
        if d in (1, depth - 1):
            continue
        shared = spark.sparkContext.broadcast(levels)

        def run(batches: Iterator[pa.RecordBatch], d: int = d, shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                for k in range(batch.num_rows):
                    lang, *packed = (field(batch, c)[k].as_py() for c in ("lang", "ids", "groups", "stream"))
                    ids, _, stream = decoded(*packed)
                    names = np.concatenate([[0], ids])
                    known = members(names[:, None], shared.value[0])
                    table = suffixes(stream, d + 1)
                    places, n = counted(table[(table[:, d] > 0) & known[table[:, 0]]])
                    below = np.flatnonzero(members(names[places[:, :d]], shared.value[d - 1]))
                    if len(below):
                        yield from sent(lang, names, places[below], n[below], np.zeros(len(below), np.int8), bin_of(names[places[below]], bins))

        def in_bin(table: pa.Table) -> pa.Table:  # run within the loop, so d is this level
            names, places, n, _ = bodies_of(table["body"].to_pylist(), d + 1)
            places, f = counted(places, n)
            often = np.flatnonzero(f > budget)
            keys = [bytes(k) for k in keys_of(names[places[often]])] if len(often) else []
            return pa.Table.from_batches([phrase_batch([table["lang"][0].as_py()] * len(often), [d + 1] * len(often), keys, f[often].tolist())])

        counts = texts.mapInArrow(run, SUFFIXES)
        tables.append(stored(counts.groupBy("lang", "grp").applyInArrow(in_bin, PHRASES), scratch_path(spark, "prefixes")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return levels, out


def dealt(texts: DataFrame, levels: list[np.ndarray], parts: int, depth: int) -> DataFrame:
    """To each partition of groups, from each block, its different suffixes in order with their counts, and how many leading words of each
    are counted already: two, or a continued prefix.

    The group of a suffix is its first word's, or, below a continued prefix, the prefix with one more word; partitions go by its hash.
    """
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def grouped(names: np.ndarray, groups: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group, deep = groups[table[:, 0]], np.zeros(len(table), np.int8)
        hot = np.flatnonzero(group == SPLIT)
        some, level = names[table[hot]], np.ones(len(hot), np.int8)
        for d in range(2, len(shared.value) + 1):
            live = np.flatnonzero((level == d - 1) & (some[:, d - 1] > 0))
            level[live[members(some[live][:, :d], shared.value[d - 1])]] = d
        hashed = np.zeros(len(hot), U64)
        for k in range(depth):
            hashed = np.where(k <= level, mix(hashed + some[:, k].astype(U64)), hashed)
        group = (mix(group.astype(U64)) % U64(parts)).astype(np.int64)
        group[hot], deep[hot] = (hashed % U64(parts)).astype(np.int64), level
        return group, np.maximum(deep, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for k in range(given.num_rows):
                lang, *packed = (field(given, c)[k].as_py() for c in ("lang", "ids", "groups", "stream"))
                ids, groups, stream = decoded(*packed)
                names = np.concatenate([[0], ids])
                table = suffixes(stream, depth)
                table, n = counted(table[(table > 0).sum(1) > 2])
                if not len(table):
                    continue
                group, deep = grouped(names, np.concatenate([[0], groups]), table)
                some = np.flatnonzero((table > 0).sum(1) > deep)
                if len(some):
                    yield from sent(lang, names, table[some], n[some], deep[some], group[some])

    return texts.mapInArrow(run, SUFFIXES)


def subtree(table: np.ndarray, counts: np.ndarray, deep: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Nodes of the suffix tree of a group, depth by depth: their phrases and totals, those of ``least`` at least.

    Suffixes in order; a node at depth d is a run of suffixes that share d words, so runs of the next depth lie within it. Nodes at or above a
    continued prefix are known already, for their suffixes lie in several groups.
    """
    order = np.lexsort(table.T[::-1])
    table, counts, deep = table[order], counts[order], deep[order]
    edge = np.concatenate([[True], np.zeros(len(table) - 1, bool)])
    edge[1:] |= table[1:, 0] != table[:-1, 0]
    for d in range(2, table.shape[1] + 1):
        edge[1:] |= table[1:, d - 1] != table[:-1, d - 1]
        first = np.flatnonzero(edge)
        total = np.add.reduceat(counts, first)
        node = first[(total >= least) & (table[first, d - 1] > 0) & (deep[first] < d)]
        if len(node):
            yield d, table[node, :d], total[np.searchsorted(first, node)]


def phrases(dealt_out: DataFrame, least: int, depth: int) -> DataFrame:
    """``lang, depth, key, f`` of the frequent phrases of three words or more below the continued prefixes."""

    def in_group(table: pa.Table) -> pa.Table:
        names, suffix, counts, deep = bodies_of(table["body"].to_pylist(), depth)
        lang = table["lang"][0].as_py()
        out = []
        for d, places, f in subtree(suffix, counts, deep, least):
            out.append(phrase_batch([lang] * len(places), [d] * len(places), [bytes(k) for k in keys_of(names[places])], f.tolist()))
        return pa.Table.from_batches(out or [phrase_batch([], [], [], [])])

    return dealt_out.groupBy("lang", "grp").applyInArrow(in_group, PHRASES)


def words_of(answers: DataFrame) -> DataFrame:
    """``lang, word, key, f`` of every frequent word."""
    names = ["lang", "word", "key", "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, body in zip(field(batch, "lang").to_pylist(), field(batch, "body").to_pylist()):
                text, length, ids, total = split(body)
                ends = np.cumsum(numbers(length, 4).astype(np.int64))
                words = [text[e - n : e].decode("utf-8", "replace") for e, n in zip(ends.tolist(), numbers(length, 4).tolist())]
                keys = [bytes(k) for k in keys_of(numbers(ids, 8).reshape(-1, 1))] if words else []
                columns = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(keys, pa.binary()), pa.array(numbers(total, 8).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return answers.where(F.col("kind") == WORDS).select("lang", "body").mapInArrow(run, "lang string, word string, key binary, f long")


def part_of(first: int | Column, words: int | Column) -> Column:
    """The key of some words of a phrase, counted from 0."""
    return F.substring("key", F.lit(8) * first + 1, F.lit(8) * words)


def scored(found: DataFrame, words: DataFrame, totals: DataFrame, depth: int) -> DataFrame:
    """``lang, depth, key, a, l, r, n, score`` of the phrases: the cut with the lowest score, of several the first.

    A part of a frequent phrase is frequent, so its count is there. Parts meet counts by joins that spread hot parts.
    """
    spark = found.sparkSession
    wide = F.col("f").cast("decimal(20,0)")
    counts = found.select("key", "f").unionByName(words.select("key", "f"))
    counts = stored(counts.select(F.col("key").alias("part"), F.col("f").alias("of_part")), scratch_path(spark, "counts"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)))
    cuts = cuts.withColumn("first", part_of(F.lit(0), F.col("k"))).withColumn("rest", part_of(F.col("k"), F.col("depth") - F.col("k")))
    cuts = stored(cuts, scratch_path(spark, "cuts"))
    left = join_unique(cuts.withColumnRenamed("first", "part"), counts, ["part"], "left").withColumnRenamed("of_part", "l").drop("part")
    both = join_unique(left.withColumnRenamed("rest", "part"), counts, ["part"], "left").withColumnRenamed("of_part", "r").drop("part")
    both = both.join(F.broadcast(totals) if totals.count() < 10_000 else totals, "lang")
    product = F.lit(1000).cast("decimal(4,0)") * wide * F.col("n").cast("decimal(14,0)")
    score = F.call_function("div", product, F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)"))
    one = both.withColumn("score", score).groupBy("lang", "depth", "key").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("m"), F.any_value("f").alias("a"))
    return one.select("lang", "depth", "key", "a", "m.l", "m.r", "m.n", "m.score")


def covered(found: DataFrame, cover: int) -> DataFrame:
    """``key, most``: phrases inside a phrase of one word more, and how often the most frequent such occurs.

    One word more is enough: what lies inside a longer one as frequent lies inside one of the phrases between, too.
    """
    longer = found.where("depth > 2").select("f", F.explode(F.array(part_of(F.lit(0), F.col("depth") - 1), part_of(F.lit(1), F.col("depth") - 1))).alias("key"))
    return longer.groupBy("key").agg(F.max("f").alias("most")).select("key", (F.col("most") * 100).alias("most"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    cover: int = COVER,
    depth: int = DEPTH,
    text: str = "text",
    lang: str = "lang",
    budget: int = BUDGET,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of two to ``depth`` words that occur ``least`` times at least.

    Words are lower-cased (A-Z), parted by blanks and tabs within pieces that punctuation and line ends part. ``a`` counts a phrase's
    occurrences, ``n`` all words of the language; a cut into two parts that occur ``l`` and ``r`` times has the score
    floor(1000 a n / (l r)), and the cut with the lowest counts, of several the first. A phrase inside a longer one that occurs at least
    ``cover`` of a hundred times as often goes. Rank is by score, occurrences and phrase (byte order).

    Null and empty texts have no words; the null language is ``und``. Repeated rows count again. Very long texts take memory of some times
    their size. An empty table, or one without frequent phrases, gives an empty result; other columns are not read. Words are told
    apart by their bytes, phrases by their words' numbers, and numbers are exact up to 38 digits.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs[f"`{text}`"].cast("string")))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    at = {name: scratch_path(spark, name) for name in ("blocks", "vocabulary", "encoded", "pairs", "cut")}

    def over(*names: str) -> None:
        for name in names:
            discard(spark, at[name])
        release(spark)

    rows = stored(blocks(docs, text, lang, parts, block_bytes), at["blocks"])
    totals = stored(rows.where(F.col("kind") == OWN).groupBy("lang").agg(F.sum("n").alias("n")), scratch_path(spark, "totals"))
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, n_words // MOST_PREFIXES)
    answers = stored(vocabulary(rows, least, budget), at["vocabulary"])
    release(spark)
    texts = stored(encoded(rows, answers), at["encoded"])
    words = stored(words_of(answers), scratch_path(spark, "words"))
    over("blocks", "vocabulary")
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_words // BIN_PAIRS)
    answers = stored(pair_answers(pair_asks(texts, bins), least), at["pairs"])
    release(spark)
    pairs = stored(pairs_from(answers), scratch_path(spark, "phrases"))
    texts = stored(cut(texts, answers, bins), at["cut"])
    over("encoded", "pairs")
    often, hot = (x.agg(F.sum("f"), F.sum(F.when(F.col("f") > budget, F.col("f")))).first() for x in (pairs, words))
    levels, above = continued(spark, texts, words, pairs, budget, max(1, 2 * (hot[1] or 0) // budget), depth)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (often[0] or 0) // PART_SUFFIXES)
    found = phrases(dealt(texts, levels, parts, depth), least, depth).unionByName(above.where(F.col("f") >= least)).unionByName(pairs)
    found = stored(found, scratch_path(spark, "phrases"))
    over("cut")
    done = scored(found, words, totals, depth).join(covered(found, cover), "key", "left").where(F.col("most").isNull() | (F.col("most") < cover * F.col("a"))).drop("most")
    # ties at the last rank stay until phrases are spelled out
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = stored(done.withColumn("rank", F.rank().over(by)).where(F.col("rank") <= top).drop("rank"), scratch_path(spark, "first"))
    spelled = first.select("key", F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("at")).withColumn("word_key", part_of(F.col("at"), F.lit(1)))
    spelled = spelled.join(words.select(F.col("key").alias("word_key"), "word"), "word_key")
    spelled = spelled.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = first.join(spelled, "key").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
