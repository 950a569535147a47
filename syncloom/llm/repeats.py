"""Long repeats across documents: what both substring de-duplications share.

A window is a fixed number of units (bytes or words) of one document. Every window has an anchor, its smallest gram by hash, so
equal windows have equal anchors, and a run of neighbouring windows has the same one. First all anchors are counted; those of one
document only are done with. Then the stretch around every other anchor (the windows of its run, as one piece) goes to the
partition its leading units belong to, where the windows are sorted and each one's smallest document is found. The
answers come back as bits, and a document's removed windows become spans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from syncloom.llm.blocks import ROWS, ask, batch_of, frequencies, joined, numbers, own_row, owners, parts_for, planes, release, split, text_classes
from syncloom.llm.rows import field, ship
from syncloom.llm.textops import CHUNK_BYTES, SPACED, U64, byte_grams, chunks, digests, minimizers, mix, word_hash, word_spans
from syncloom.session import scratch_path, stored

PIECE_BYTES, SAMPLE_BYTES = 12 << 20, 32 << 20


@dataclass
class Units:
    """Of some texts: each unit's bytes and text, its value, and a hash of the gram that begins there."""

    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    values: np.ndarray
    grams: np.ndarray


def chain(values: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` units, also those across texts."""
    m = max(0, len(values) - n + 1)
    total = np.zeros(m, U64)
    for k in range(n):
        total = total * U64(0xD1342543DE82EF95) + values[k : k + m]
    return mix(total)


@dataclass(frozen=True)
class Scheme:
    """Windows of ``window`` units with grams of ``gram``; units are bytes, or words between white space."""

    window: int
    gram: int
    words: bool

    def units(self, data: np.ndarray, offsets: np.ndarray) -> Units:
        if self.words:
            starts, ends, owner = word_spans(data, offsets, SPACED)
            values = word_hash(data, starts, ends)
            return Units(starts, ends, owner, values, chain(values, self.gram))
        starts = np.arange(len(data))
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        return Units(starts, starts + 1, owner, data, byte_grams(data, self.gram))

    def runs(self, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every run of windows with one anchor: its first window, the anchor, the number of windows."""
        m = len(u.owner) - self.window + 1
        none = np.zeros(0, np.int64)
        if m <= 0:
            return none, none, none
        at = minimizers(u.grams, self.window - self.gram + 1)
        valid = np.flatnonzero(u.owner[:m] == u.owner[self.window - 1 :])
        if not len(valid):
            return none, none, none
        anchors = at[valid]
        fresh = np.ones(len(valid), bool)
        fresh[1:] = (anchors[1:] != anchors[:-1]) | (valid[1:] != valid[:-1] + 1)
        first = np.flatnonzero(fresh)
        return valid[first], anchors[first], np.diff(np.append(first, len(valid)))


#: Gives the partition of each anchor: ``(units, bytes, anchors)`` to numbers.
Route = Callable[[Units, np.ndarray, np.ndarray], np.ndarray]


def anchor_keys(scheme: Scheme):  # noqa: ANN201
    def keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        u = scheme.units(data, offsets)
        _, anchors, _ = scheme.runs(u)
        n = len(offsets) - 1
        return u.grams[anchors], np.bincount(u.owner[anchors], minlength=n), np.zeros(n, np.int64)

    return keys


def repeated(classes: list[bytes], per: np.ndarray, _: np.ndarray, places: np.ndarray, documents: np.ndarray, __: np.ndarray | None) -> pa.Table:
    """Of the documents that share an anchor with another, the numbers of those anchors."""
    own = owners(per, places)
    inside = places - (np.cumsum(per) - per)[own]
    names = np.unique(own)
    edges = np.searchsorted(own, np.append(names, len(per)))
    lists = [planes(inside[a:b], 4) for a, b in zip(edges, edges[1:])]
    return pa.table([pa.array([classes[k] for k in names.tolist()], pa.binary()), pa.array(lists, pa.binary())], ["class", "anchors"])


@dataclass
class Pieces:
    """Stretches of a block around repeated anchors, as parallel arrays, with their bytes."""

    document: np.ndarray  # number in the block
    first: np.ndarray  # first window, as a unit of the document
    count: np.ndarray  # windows
    anchor: np.ndarray  # units before the anchor
    part: np.ndarray
    digest: np.ndarray  # 128 bits of the bytes and the anchor's place, in two columns
    texts: list[bytes]


def pieces_of(scheme: Scheme, route: Route, data: np.ndarray, offsets: np.ndarray, lists: list[bytes], base: int) -> Pieces:
    u = scheme.units(data, offsets)
    first, anchor, count = scheme.runs(u)
    owner = u.owner[anchor] if len(anchor) else anchor
    before = np.searchsorted(owner, np.arange(len(lists)))
    some = np.concatenate([numbers(x, 4).astype(np.int64) + b for x, b in zip(lists, before)])
    first, anchor, count, owner = first[some], anchor[some], count[some], owner[some]
    starts, ends = u.starts[first], u.ends[first + count + scheme.window - 2]
    before = np.searchsorted(u.owner, np.arange(len(lists)))
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return Pieces(owner + base, first - before[owner], count, anchor - first, route(u, data, anchor), digests(texts, anchor - first), texts)


def piece_rows(classes: list[bytes], ids: list[int], found: list[Pieces], parts: int) -> pa.RecordBatch:
    """A block's rows: per partition its different stretches, each once with its smallest document, and where they stand."""
    document, first, count, anchor, part, digest = (np.concatenate([getattr(p, n) for p in found]) for n in ("document", "first", "count", "anchor", "part", "digest"))
    contents = [t for p in found for t in p.texts]
    by_document = np.array(ids, np.int64)
    order = np.lexsort((by_document[document], digest[:, 1], digest[:, 0], part))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (digest[order][1:] != digest[order][:-1]).any(1) | (part[order][1:] != part[order][:-1])
    lead = order[fresh]  # smallest document of each different stretch
    group = np.cumsum(fresh) - 1
    smallest = by_document[document[order]] == by_document[document[lead]][group]
    own = own_row(classes, parts)
    rows = [own]
    here = part[order]
    for p in np.unique(here).tolist():
        a, b = np.searchsorted(here, [p, p + 1])
        u, v = group[a], group[b - 1] + 1
        some, at = lead[u:v], order[a:b]
        texts = [contents[k] for k in some.tolist()]
        asks = (by_document[document[some]].view(np.uint64), anchor[some], count[some], np.array([len(t) for t in texts]))
        back = (group[a:b] - u, document[at], first[at])
        rows.append((own[0], p, joined(planes(asks[0], 8), *(planes(x, 4) for x in asks[1:]), b"".join(texts), *(planes(x, 4) for x in back), np.packbits(smallest[a:b]).tobytes())))
    return batch_of(rows)


def piece_blocks(texts: DataFrame, scheme: Scheme, route: Route, parts: int) -> DataFrame:
    """The rows of all blocks."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: list[bytes] = []
        ids: list[int] = []
        found: list[Pieces] = []
        size = 0
        for batch in batches:
            names, order, lists = (field(batch, c).to_pylist() for c in ("class", "id", "anchors"))
            for start, data, offsets in chunks(field(batch, "text")):
                n = len(offsets) - 1
                pieces = pieces_of(scheme, route, data, offsets, lists[start : start + n], len(ids))
                classes += names[start : start + n]
                ids += order[start : start + n]
                found.append(pieces)
                size += sum(map(len, pieces.texts))
                if size >= PIECE_BYTES:
                    yield piece_rows(classes, ids, found, parts)
                    classes, ids, found, size = [], [], [], 0
        if classes:
            yield piece_rows(classes, ids, found, parts)

    return texts.select("class", "id", "text", "anchors").mapInArrow(run, ROWS)


#: ``(window starts among the units, the units' values)`` to the digits that tell windows apart, the leading one first.
Digits = Callable[[np.ndarray, np.ndarray], Iterator[np.ndarray]]


def smallest_of(group: np.ndarray, ids: np.ndarray, digits: Iterator[np.ndarray]) -> np.ndarray:
    """For every window the smallest id among equal ones.

    Multikey quicksort, one digit at a time: windows of a group are sorted by the next digit and fall into smaller groups;
    a group of one document needs no further look. ``digits`` are of all windows; equal windows agree in all.
    """
    least = ids.copy()
    live = np.arange(len(ids))
    for digit in digits:
        if not len(live):
            return least
        here = digit[live]
        order = np.lexsort((here, group[live]))
        live, here = live[order], here[order]
        fresh = np.ones(len(live), bool)
        fresh[1:] = (group[live][1:] != group[live][:-1]) | (here[1:] != here[:-1])
        number = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        one = np.minimum.reduceat(ids[live], first) == np.maximum.reduceat(ids[live], first)
        group[live] = number
        live = live[~one[number]]
    if len(live):
        order = np.argsort(group[live], kind="stable")
        live = live[order]
        first = np.flatnonzero(np.concatenate([[True], group[live][1:] != group[live][:-1]]))
        low = np.minimum.reduceat(ids[live], first)
        least[live] = np.repeat(low, np.diff(np.append(first, len(live))))
    return least


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each, one after another."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(first, count)


def union(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each owner as a union, those that touch made one."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    step = int(end.max(initial=0)) + 2
    reach = np.maximum.accumulate(end + owner * step) if len(end) else end
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] + owner[1:] * step > reach[:-1]
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(start)) - 1
    return owner[at], start[at], (reach - owner * step)[last] if len(at) else start


def measured(scheme: Scheme, texts: list[bytes], length: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of many stretches: all units' values, where each stretch's begin, its digest, and its anchor's gram; in chunks."""
    raw = b"".join(texts)
    data = np.frombuffer(raw, np.uint8)
    ends = np.cumsum(length)
    values, begin, gram, base, first = [], [], [], 0, 0
    digest = digests([raw[b - n : b] for b, n in zip(ends.tolist(), length.tolist())], anchor)
    while first < len(length):
        start = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, start + CHUNK_BYTES, "right")))
        some = data[start : ends[last - 1]]
        offsets = np.concatenate([[0], ends[first:last] - start])
        u = scheme.units(some, offsets)
        at = np.searchsorted(u.owner, np.arange(last - first))
        values.append(u.values)
        begin.append(at + base)
        gram.append(u.grams[at + anchor[first:last]])
        base += len(u.values)
        first = last
    return np.concatenate(values), np.concatenate(begin), digest, np.concatenate(gram)


def answer(scheme: Scheme, digits: Digits):  # noqa: ANN201
    """A partition's work: for every asked window, whether a document with a smaller id has it; as spans per document."""

    def run(bodies: list[bytes]) -> list[bytes]:
        asks = [split(b) for b in bodies]
        ids = np.concatenate([numbers(a[0], 8) for a in asks]).view(np.int64)
        anchor, count, length = (np.concatenate([numbers(a[k], 4) for a in asks]).astype(np.int64) for k in (1, 2, 3))
        values, begin, digest, gram = measured(scheme, [a[4] for a in asks], length, anchor)
        # The same stretch from several blocks counts once, with its smallest document.
        order = np.lexsort((ids, digest[:, 1], digest[:, 0]))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (digest[order][1:] != digest[order][:-1]).any(1)
        lead = order[fresh]
        piece = np.empty(len(order), np.int64)
        piece[order] = np.cumsum(fresh) - 1
        # Stretches by anchor; where all are the same one, its smallest document answers for all their windows.
        _, of_anchor, several = np.unique(gram[lead], return_inverse=True, return_counts=True)
        open_ = np.flatnonzero(several[of_anchor] > 1)
        least = np.repeat(ids[lead], count[lead])
        edge = np.cumsum(count[lead]) - count[lead]
        if len(open_):
            some = lead[open_]
            windows = spread(begin[some], count[some])
            ahead = spread(np.zeros(len(some), np.int64), count[some])
            group = np.repeat(of_anchor[open_], count[some]) * (2 * scheme.window) + (np.repeat(anchor[some], count[some]) - ahead)
            least[spread(edge[open_], count[some])] = smallest_of(group, np.repeat(ids[some], count[some]), digits(windows, values))
        bits = least[spread(edge[piece], count)] < np.repeat(ids, count)
        base = np.cumsum(count) - count
        out, entry = [], 0
        for a in asks:
            group, document, first = (numbers(a[k], 4).astype(np.int64) for k in (5, 6, 7))
            only = np.unpackbits(np.frombuffer(a[8], np.uint8), count=len(group)).astype(bool)
            of = group + entry
            n = count[of]
            # not the smallest document of its stretch: every window is repeated; else as the windows say
            gone = bits[spread(base[of], n)] | np.repeat(~only, n)
            start = spread(first, n)[gone]
            out.append(joined(*(planes(x, 4) for x in union(np.repeat(document, n)[gone], start, start + scheme.window))))
            entry += len(numbers(a[1], 4))
        return out

    return run


def spans_of(classes: list[bytes], _: list[bytes], answers: list[bytes]) -> pa.Table:
    """A block's documents with something to remove, and the spans of their units, as pairs of longs."""
    parts = [[numbers(x, 4).astype(np.int64) for x in split(a)] for a in answers]
    none = np.zeros(0, np.int64)
    owner, start, end = union(*(np.concatenate([none, *(p[k] for p in parts)]) for k in range(3)))
    pairs = np.stack([start, end], 1).astype("<i8")
    names = np.unique(owner)
    edges = np.searchsorted(owner, np.append(names, len(classes)))
    blobs = [pairs[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    return pa.table([pa.array([classes[k] for k in names.tolist()], pa.binary()), pa.array(blobs, pa.binary())], ["class", "spans"])


def sample(texts: DataFrame, scheme: Scheme, keep: Callable[[Units, np.ndarray, np.ndarray], list[bytes]]) -> list[bytes]:
    """What ``keep`` makes of the anchors of a bounded sample of texts (about ``SAMPLE_BYTES``, whole texts by hash).

    Only the balance of the partitions rests on it. A task makes one row of what it meets again and again, so frequent anchors cost no more than rare ones.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, SAMPLE_BYTES / max(1, size))
    some = texts.where(F.pmod(F.xxhash64("class"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    every = max(1, int(size * share) // 400_000)
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for _, data, offsets in chunks(field(batch, "text")):
                u = scheme.units(data, offsets)
                _, anchors, _ = scheme.runs(u)
                if len(anchors):
                    anchors = anchors[u.grams[anchors] % U64(every) == 0]
                fresh = set(keep(u, data, anchors)) - seen
                seen |= fresh
                yield pa.RecordBatch.from_arrays([pa.array(sorted(fresh), pa.binary())], ["s"])

    return [bytes(r["s"]) for r in some.mapInArrow(run, "s binary").distinct().collect()]


def cut(scheme: Scheme, text: bytes, spans: np.ndarray) -> tuple[int, int, bytes]:
    """Units of a text, units removed, and the bytes that stay (words joined by one space)."""
    if not scheme.words:
        edges = [0, *spans.ravel().tolist(), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        return len(text), len(text) - len(kept), kept
    words = text.split()  # bytes split at the same six characters
    edges = [0, *spans.ravel().tolist(), len(words)]
    kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
    return len(words), len(words) - len(kept), b" ".join(kept)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def without_repeats(docs: DataFrame, scheme: Scheme, router: Callable[[DataFrame, int], Route], digits: Digits, text: str, key: str, carry: Sequence[str]) -> DataFrame:
    """Every row: ``row`` (the carried columns), ``doc_id``, ``n_units``, the removed ``spans`` (``start`` to before
    ``end``, in units), what is ``kept``, whether it goes whole as a ``copy``; and ``n_removed``, ``n_spans``, ``kept_sha256`` of these.
    """
    spark = docs.sparkSession
    rows, texts = text_classes(docs, text, key)
    release(spark)
    parts = parts_for(texts)
    shared = stored(frequencies(texts, anchor_keys(scheme), repeated, "class binary, anchors binary", parts), scratch_path(spark, "anchors"))
    release(spark)
    # a document without an id comes before all others
    open_ = texts.withColumn("id", F.coalesce("id", F.lit(-(1 << 63)))).join(shared, "class")
    pieces = piece_blocks(open_, scheme, router(texts, parts), parts)
    spans = stored(ask(pieces, answer(scheme, digits), spans_of, "class binary, spans binary"), scratch_path(spark, "spans"))
    release(spark)
    # What is to be known of a class: its spans and, where it has several rows, its smallest id.
    copied = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marks = texts.select("class", "id").join(copied, "class", "left").join(spans, "class", "left").where("n > 1 or spans is not null")
    marks = stored(marks.select(F.col("class").alias("_c"), "id", "spans"), scratch_path(spark, "marks"))
    release(spark)
    body = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row"), docs[f"`{key}`"].cast("long").alias("doc_id"), body.alias("text"))
    given = given.withColumn("class", F.unhex(F.md5(F.col("text").cast("binary"))))
    known = given.join(marks, F.col("class") == F.col("_c"), "left")
    # A copy with a larger id loses all it has, if that is a window at least; else it is as its class.
    later = F.col("_c").isNotNull() & F.col("doc_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("id"))
    known = known.select("row", "doc_id", "text", "spans", later.alias("copy"))
    kept_type = (T.StringType(), pa.string()) if scheme.words else (T.BinaryType(), pa.binary())
    schema = T.StructType(
        [known.schema["row"], known.schema["doc_id"], T.StructField("n_units", T.LongType()), T.StructField("spans", SPANS), T.StructField("kept", kept_type[0]), T.StructField("copy", T.BooleanType())]
    )
    names = schema.names

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(field(batch, "text")).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:
                before = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
                some = batch.slice(first, last - first)
                n_units, pairs, kept, copies = [], [np.zeros((0, 2), np.int64)], [], []
                for data, gone, copy in zip(field(some, "text").cast(pa.binary()).to_pylist(), field(some, "spans").to_pylist(), field(some, "copy").to_pylist()):
                    mine = np.frombuffer(gone or b"", "<i8").reshape(-1, 2)
                    units, _, rest = cut(scheme, data, mine)
                    copy = copy and units >= scheme.window
                    n_units.append(units)
                    pairs.append(np.array([[0, units]], np.int64) if copy else mine)
                    kept.append(b"" if copy else rest)
                    copies.append(copy)
                edges = np.cumsum([len(x) for x in pairs]).astype(np.int32)
                flat = np.concatenate(pairs)
                both = pa.StructArray.from_arrays([pa.array(flat[:, 0].copy()), pa.array(flat[:, 1].copy())], ["start", "end"])
                columns = [pa.array(n_units, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), both), pa.array(kept, pa.binary()).cast(kept_type[1]), pa.array(copies, pa.bool_())]
                yield pa.RecordBatch.from_arrays([field(some, "row"), field(some, "doc_id"), *columns], names)
                first = last

    done = known.mapInArrow(finish, schema)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("*", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
