"""Benchmark decontamination: an FM-index per shard of the corpus, searched backwards with the test phrases.

A shard's index holds the stretches of words that could be part of a phrase (every short gram in them is one of the
phrases'). All phrases are searched together, one word further left per step, with ranks from a wavelet
tree; the matches' places come from sampled suffix positions by walking the last-to-first mapping.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncloom.llm.rows import field, per_text, ship
from syncloom.llm.textops import ALNUM, LOWER, U64, binary, chunks, mix, word_hash, word_spans

SAMPLE, SLICE_BYTES, GRAM = 16, 8 << 20, 4


class WaveletTree:
    """Ranks of symbols in a sequence: one row of counted bits per binary digit, the highest first."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        here = values
        for level in reversed(range(self.bits)):
            bit = (here >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            here = np.concatenate([here[bit == 0], here[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros_like(ends), ends.copy()
        for level, (ones, zeros) in zip(reversed(range(self.bits)), zip(self.ones, self.zeros)):
            bit = (symbols >> level) & 1
            low_ones, high_ones = ones[low], ones[high]
            low = np.where(bit, zeros + low_ones, low - low_ones)
            high = np.where(bit, zeros + high_ones, high - high_ones)
        return high - low


def suffix_array(values: np.ndarray) -> np.ndarray:
    """By doubling: sort by the first symbols, then by pairs of ranks twice as far apart each time."""
    n = len(values)
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[: n - span] = rank[span:] + 1
        key = rank * (n + 2) + behind
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order
        span *= 2
        if span >= n:
            return order


class FMIndex:
    """Of symbols 1 .. ``symbols`` - 1; 0 separates stretches and closes the sequence."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        values = np.append(values, 0)
        # The last separator must be the smallest symbol of all and occur once, so the others move up by one.
        text = np.where(np.arange(len(values)) == len(values) - 1, 0, values + 1)
        order = suffix_array(text)
        self.size = len(text)
        self.bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.tree = WaveletTree(self.bwt, symbols + 1)
        self.marked = np.concatenate([[0], np.cumsum(order % SAMPLE == 0)])
        self.samples = order[order % SAMPLE == 0]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase; rows of ``phrases`` are filled from the right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        width = phrases.shape[1]
        for step in range(width):
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - step] + 1
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of the rows begin: walk left to the nearest sampled one."""
        places, rows, walked = np.zeros(len(rows), np.int64), rows.copy(), 0
        open_ = np.arange(len(rows))
        while len(open_):
            here = rows[open_]
            sampled = self.marked[here + 1] > self.marked[here]
            done = open_[sampled]
            places[done] = self.samples[self.marked[rows[done]]] + walked
            open_ = open_[~sampled]
            here = rows[open_]
            symbol = self.bwt[here]
            rows[open_] = self.before[symbol] + self.tree.rank(symbol, here)
            walked += 1
        return places


@dataclass
class Phrases:
    """The windows of one slice of the benchmark."""

    hashes: np.ndarray  # of the vocabulary, sorted
    words: list[bytes]  # the same words
    gram: int  # length of the short grams, at most that of the shortest window
    grams: np.ndarray  # hashes of all within items, sorted
    windows: np.ndarray  # word numbers from 1, filled from the right
    lengths: np.ndarray
    items: list[list[str]]  # of each window


def phrases(rows: list[tuple[str | None, str | None]], width: int) -> Phrases | None:
    """Windows of ``width`` words; an item of fewer words, but not none, is one window."""
    texts = pa.array([t for _, t in rows], pa.large_string())
    of_item: list[tuple[str | None, list[bytes]]] = []
    for first, data, offsets in chunks(texts):
        low = LOWER[data]
        starts, ends, owner = word_spans(low, offsets, ALNUM)
        words: list[list[bytes]] = [[] for _ in offsets[1:]]
        raw = low.tobytes()
        for s, e, o in zip(starts.tolist(), ends.tolist(), owner.tolist()):
            words[o].append(raw[s:e])
        of_item += [(rows[first + k][0], w) for k, w in enumerate(words) if w]
    vocabulary = sorted({w for _, ws in of_item for w in ws})
    if not vocabulary:
        return None
    joined = np.frombuffer(b"".join(vocabulary), np.uint8)
    edge = np.concatenate([[0], np.cumsum([len(w) for w in vocabulary])])
    hashes = word_hash(joined, edge[:-1], edge[1:])
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two words of the benchmark have one hash")
    order = np.argsort(hashes)
    vocabulary = [vocabulary[k] for k in order]
    number = {w: k + 1 for k, w in enumerate(vocabulary)}
    windows: dict[tuple[int, ...], set[str]] = {}
    gram = min(GRAM, width, *(len(ws) for _, ws in of_item))
    grams = set()
    for item, ws in of_item:
        ids = [number[w] for w in ws]
        grams.update(zip(*(ids[k:] for k in range(gram))))
        for k in range(max(1, len(ids) - width + 1)):
            known = windows.setdefault(tuple(ids[k : k + width]), set())
            if item is not None:
                known.add(item)
    table = np.zeros((len(windows), width), np.int64)
    for row, window in zip(table, windows):
        row[width - len(window) :] = window
    known = np.array(sorted(grams), np.int64)
    known = np.sort(gram_of(known.ravel(), np.arange(len(known)) * gram, gram))
    return Phrases(hashes[order], vocabulary, gram, known, table, np.array([len(w) for w in windows]), [sorted(i) for i in windows.values()])


def gram_of(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(at), U64)
    for k in range(n):
        total = mix(total * U64(0x9E3779B97F4A7C15) + ids[at + k].astype(U64))
    return total


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def stretches(ids: np.ndarray, owner: np.ndarray, look: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and places of the words that could be part of an occurrence, with a 0 (place -1) between stretches.

    All short grams of an occurrence are grams of the benchmark, one beginning at each word, so nothing is lost.
    """
    m = len(ids) - look.gram + 1
    none = np.zeros(0, np.int64)
    if m <= 0:
        return none, none
    valid = np.zeros(m + 2, bool)
    at = np.flatnonzero((ids[:m] > 0) & (owner[:m] == owner[look.gram - 1 :]))
    valid[at + 1] = member(gram_of(ids, at, look.gram), look.grams)
    first = np.flatnonzero(valid[1:-1] & ~valid[:-2])
    after = np.flatnonzero(valid[1:-1] & ~valid[2:]) + look.gram
    long = after - first >= look.lengths.min()
    first, sizes = first[long], (after - first)[long] + 1
    total = int(sizes.sum())
    if not total:
        return none, none
    inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = np.repeat(first, sizes) + inside
    places[inside == np.repeat(sizes - 1, sizes)] = -1
    return np.where(places < 0, 0, ids[places]), places


def occurrences(look: Phrases, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard's texts (lower-cased bytes): windows and first words of all occurrences, the words' texts, words per text."""
    starts, ends, owner = word_spans(data, offsets, ALNUM)
    words = np.bincount(owner, minlength=len(offsets) - 1)
    nothing = np.zeros(0, np.int64)
    if not len(starts):
        return nothing, nothing, owner, words
    hashes = word_hash(data, starts, ends)
    at = np.minimum(np.searchsorted(look.hashes, hashes), len(look.hashes) - 1)
    ids = np.where(look.hashes[at] == hashes, at + 1, 0)
    values, places = stretches(ids, owner, look)
    real = np.flatnonzero(places >= 0)
    raw = data.tobytes()
    for k in real.tolist():  # the few words that are left are compared byte by byte
        p = places[k]
        if raw[starts[p] : ends[p]] != look.words[values[k] - 1]:
            values[k] = 0
    if not len(real):
        return nothing, nothing, owner, words
    # A window with a word that the shard does not have cannot occur in it.
    present = np.zeros(len(look.words) + 1, bool)
    present[values] = True
    present[0] = True  # fills short windows
    sought = np.flatnonzero(present[look.windows].all(1))
    index = FMIndex(values, len(look.words) + 1)
    low, high = index.search(look.windows[sought], look.lengths[sought])
    counts = np.maximum(high - low, 0)
    window = np.repeat(sought, counts)
    rows = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    return window, places[index.locate(rows)], owner, words


SPAN = T.StructType([T.StructField("first", T.LongType(), False), T.StructField("last", T.LongType(), False)])
FOUND = T.StructType(
    [T.StructField("n_words", T.LongType(), False), T.StructField("spans", T.ArrayType(SPAN, False), False), T.StructField("items", T.ArrayType(T.StringType(), False), False)]
)


def found_in(look: Phrases, texts: pa.Array) -> list[pa.Array]:
    """Per text its words, the merged spans of hit words and the items that occur."""
    n = len(texts)
    n_words = np.zeros(n, np.int64)
    spans: list[list[dict[str, int]]] = [[] for _ in range(n)]
    items: list[list[str]] = [[] for _ in range(n)]
    for first, data, offsets in chunks(texts):
        window, word, owner, words = occurrences(look, LOWER[data], offsets)
        n_words[first : first + len(words)] = words
        if not len(window):
            continue
        start_of = np.cumsum(words) - words
        hit = np.zeros(len(owner) + 1, np.int64)
        np.add.at(hit, word, 1)
        np.add.at(hit, word + look.lengths[window], -1)
        inside = np.cumsum(hit[:-1]) > 0
        # an occurrence lies in one text, so spans are cut at the texts' ends
        edge = np.concatenate([[True], owner[1:] != owner[:-1]])
        begin = np.flatnonzero(inside & (edge | ~np.concatenate([[False], inside[:-1]])))
        end = np.flatnonzero(inside & np.concatenate([edge[1:] | ~inside[1:], [True]]))
        for a, b in zip(begin.tolist(), end.tolist()):
            text = owner[a]
            spans[first + text].append({"first": a - int(start_of[text]), "last": b - int(start_of[text])})
        pairs = np.unique(np.stack([owner[word], window], 1), axis=0)
        for text in np.unique(pairs[:, 0]):
            names = {i for w in pairs[pairs[:, 0] == text, 1] for i in look.items[w]}
            items[first + int(text)] = sorted(names)
    span = pa.struct([pa.field("first", pa.int64(), False), pa.field("last", pa.int64(), False)])
    return [pa.array(n_words), pa.array(spans, pa.list_(pa.field("element", span, False))), pa.array(items, pa.list_(pa.field("element", pa.string(), False)))]


def benchmark_slices(benchmark: DataFrame, width: int, text: str, key: str, slice_bytes: int):  # noqa: ANN201
    """Phrases of one bounded slice of the benchmark after the other, so the driver and a broadcast hold one slice each."""
    rows = benchmark.select(benchmark[f"`{key}`"].cast("string").alias("i"), benchmark[f"`{text}`"].cast("string").alias("t")).where("t is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    slices = max(1, -(-total // slice_bytes))
    for k in range(slices):
        some = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(slices)) == k)
        look = phrases([(r["i"], r["t"]) for r in some.collect()], width)
        if look is not None:
            yield look


def merged(spans: Column) -> Column:
    """Union of word spans, in order; spans that touch become one."""
    nothing = F.array().cast(T.ArrayType(SPAN, False))

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (s["first"] <= last["last"] + 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"))
        return F.when(joins, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), nothing, add)


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id", carry: tuple[str, ...] = ("doc_id",), slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``row`` (the carried columns), ``n_words``, ``spans`` (first and last word of each hit stretch), ``items`` (sorted as strings).

    Words are compared lower-cased (A-Z). Every occurrence of every window of every item counts, also overlapping ones and
    those of windows that several items share. An item of fewer than ``width`` words is one window; one without words is none.

    Null and empty texts have no words and no hits. An item without an id hits, but names no item. Repeated rows and
    items change nothing. An empty benchmark hits nothing; an empty table gives an empty result. Other columns are only carried.

    The benchmark is read in slices of at most ``slice_bytes`` of text (or one longer item); a slice's phrases are one
    broadcast, and all slices are searched in one pass over the texts, without a shuffle.
    """
    spark = docs.sparkSession
    ship(spark)
    looks = [spark.sparkContext.broadcast(look) for look in benchmark_slices(benchmark, width, text, item, slice_bytes)]
    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row"), docs[f"`{text}`"].cast("string").alias("text"))
    if not looks:
        empty = Phrases(np.zeros(1, U64), [b""], 1, np.zeros(0, U64), np.zeros((1, width), np.int64), np.array([1]), [[]])
        looks = [spark.sparkContext.broadcast(empty)]

    def make():  # noqa: ANN202
        def fn(texts: pa.Array) -> list[pa.Array]:
            parts = [found_in(look.value, texts) for look in looks]
            if len(parts) == 1:
                return parts[0]
            words, spans, items = zip(*parts)
            return [words[0], *[pa.array([sum((c[i].as_py() for c in columns), []) for i in range(len(texts))], columns[0].type) for columns in (spans, items)]]

        return fn

    found = per_text(given, make, FOUND, "text", ("row",))
    out = found.select(F.col("row.row").alias("row"), "n_words", "spans", "items")
    if len(looks) > 1:
        out = out.withColumn("spans", merged(F.col("spans"))).withColumn("items", F.array_distinct("items"))
    return out.withColumn("items", F.array_sort("items"))


def without_words(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The texts without the bytes from the first to the last word of each span."""
    out = binary(texts).to_pylist()
    todo = [k for k, s in enumerate(spans.to_pylist()) if s and out[k]]
    for k in todo:
        data = np.frombuffer(out[k], np.uint8)
        starts, ends, _ = word_spans(LOWER[data], np.array([0, len(data)]), ALNUM)
        keep, at = [], 0
        for s in spans[k].as_py():
            keep.append(out[k][at : starts[s["first"]]])
            at = int(ends[s["last"]])
        out[k] = b"".join([*keep, out[k][at:]])
    return pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` with every hit stretch of words cut out of the text; other columns and rows stay as they are.

    A text without hits is returned unchanged, a null one as null. ``contamination`` says what counts as a hit.
    """
    found = contamination(docs, benchmark, width, text, item, tuple(docs.columns))
    given = found.select("row", F.col(f"row.`{text}`").cast("string").alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([field(batch, "row"), without_words(field(batch, "text"), field(batch, "spans"))], ["row", "clean"])

    schema = T.StructType([given.schema["row"], T.StructField("clean", T.StringType())])
    done = given.mapInArrow(run, schema)
    return done.select(*[F.col("clean").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
