"""Fill-in-middle: texts cut at two boundaries of units and put together in another order, and back.

The boundaries of all lines of a batch of texts are one set of byte offsets in the manner of Roaring bitmaps: offsets share
a container by their high 16 bits, a container is an array, a bitmap or a list of runs, whichever is smallest, and running
cardinalities lead from a boundary's number to its container. Both cuts of all texts are found by two such selects.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncloom.llm.rows import field, ship
from syncloom.llm.textops import chunks

MARKERS = ("<P>", "<S>", "<M>")
LOW_BITS = 16
ARRAY_BYTES, RUN_BYTES, BITMAP_BYTES = 2, 4, 1 << (LOW_BITS - 3)


class ArrayContainer:
    """The low bits themselves."""

    def __init__(self, low: np.ndarray) -> None:
        self.low = low.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)


class RunContainer:
    """First member and number of members before each stretch of consecutive numbers."""

    def __init__(self, low: np.ndarray) -> None:
        at = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.first, self.before = low[at], at

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, "right") - 1
        return self.first[run] + k - self.before[run]


class BitmapContainer:
    """One bit per possible member, and the number of members before each word of 64."""

    def __init__(self, low: np.ndarray) -> None:
        bits = np.zeros(1 << LOW_BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").reshape(-1, 8)
        inside = bits.reshape(-1, 64).sum(1)
        self.before = np.cumsum(inside) - inside

    def select(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, k, "right") - 1
        members = np.cumsum(np.unpackbits(self.words[word], axis=1, bitorder="little"), axis=1)
        return word * 64 + np.argmax(members > (k - self.before[word])[:, None], axis=1)


class BoundarySet:
    """A set of offsets from which the one with a given rank is read."""

    def __init__(self, offsets: np.ndarray) -> None:
        """``offsets`` increase."""
        high = offsets >> LOW_BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.base = high[first] << LOW_BITS
        self.before = first  # members in earlier containers
        self.containers = [self._container(o - b) for o, b in zip(np.split(offsets, first[1:]), self.base.tolist())]

    @staticmethod
    def _container(low: np.ndarray) -> ArrayContainer | RunContainer | BitmapContainer:
        if not len(low):
            return ArrayContainer(low)
        runs = 1 + int((np.diff(low) != 1).sum())
        if runs * RUN_BYTES < min(len(low) * ARRAY_BYTES, BITMAP_BYTES):
            return RunContainer(low)
        return ArrayContainer(low) if len(low) * ARRAY_BYTES <= BITMAP_BYTES else BitmapContainer(low)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The members with these ranks (from 0, in any order)."""
        out = np.empty(len(ranks), np.int64)
        at = np.searchsorted(self.before, ranks, "right") - 1
        for c in np.unique(at).tolist():
            some = np.flatnonzero(at == c)
            out[some] = self.base[c] + self.containers[c].select(ranks[some] - self.before[c])
        return out


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[BoundarySet, np.ndarray, np.ndarray]:
    """Of texts laid end to end: all ends of lines and texts, the rank of each text's start, and its number of lines.

    A text's end is the next one's start, so a text of n lines has the n + 1 ranks from its start's.
    """
    ends = np.flatnonzero(data == 0x0A) + 1
    every = np.union1d(offsets, ends)
    rank = np.searchsorted(every, offsets)
    return BoundarySet(every), rank[:-1], np.diff(rank)


def holding(markers: Sequence[str], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts contain one of the markers."""
    out = np.zeros(len(offsets) - 1, bool)
    for found in re.finditer(b"|".join(re.escape(m.encode()) for m in markers), data.tobytes()):
        text = int(np.searchsorted(offsets, found.start(), "right")) - 1
        if found.end() <= offsets[text + 1]:
            out[text] = True
    return out


def check(markers: Sequence[str]) -> None:
    """Markers must not overlap each other or themselves, or a text's edge could complete one and could not be taken apart."""
    for a in markers:
        for b in markers:
            shared = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b)) if k < len(a) or k < len(b))
            if not a or shared or (a != b and a in b):
                raise ValueError(f"markers {list(markers)} overlap")


SCHEMA = [
    T.StructField("n", T.LongType(), False),
    T.StructField("form", T.StringType(), False),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType(), False),
]


def fill_middle(
    docs: DataFrame,
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    markers: Sequence[str] = MARKERS,
    text: str = "text",
    key: str = "doc_id",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``row`` (the carried columns), ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` of every row.

    A text is cut into lines (each with its line feed); two cuts, drawn from a hash of ``seed`` and the id, part it into prefix,
    middle and suffix, each of whole lines and perhaps empty. The form is ``spm`` for ``spm_rate`` of a hundred, else ``psm``.
    It is ``plain``, the output the text itself and both counts null, for all but ``rate`` of a hundred, for an empty text, and for one
    that contains a marker, so that every other output can be taken apart again (``restored``).

    A null text is an empty one, a null id the empty string in the hash. Repeated rows and rows with one id are cut alike as far as their lines
    agree. Very long texts take memory of a few times their size. An empty table gives an empty result; other columns are only carried.
    """
    check(markers)
    ship(docs.sparkSession)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[f"`{key}`"].cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(drawn, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row"), docs[f"`{text}`"].cast("string").alias("text"), *draws)
    schema = T.StructType([given.schema["row"], *SCHEMA])
    before, between, after = (m.encode() for m in markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draw = [field(batch, f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5)]
            for first, data, offsets in chunks(field(batch, "text")):
                size = len(offsets) - 1
                h1, h2, h3, h4 = (h[first : first + size] for h in draw)
                edges, start, n = boundaries(data, offsets)
                plain = (np.diff(offsets) == 0) | holding(markers, data, offsets) | (h3 % 100 >= rate)
                cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
                low, high = edges.select(start + cuts[0]), edges.select(start + cuts[1])
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                raw = data.tobytes()
                form = np.where(plain, "plain", np.where(h4 % 100 < spm_rate, "spm", "psm"))
                out = []
                for kind, a, b, c, d in zip(form.tolist(), offsets.tolist(), low.tolist(), high.tolist(), offsets[1:].tolist()):
                    if kind == "plain":
                        out.append(raw[a:d])
                    elif kind == "psm":
                        out.append(b"".join([before, raw[a:b], between, raw[c:d], after, raw[b:c]]))
                    else:
                        out.append(b"".join([between, raw[c:d], before, raw[a:b], after, raw[b:c]]))
                counts = [chars[low] - chars[offsets[:-1]], chars[high] - chars[low]]
                columns = [pa.array(n.astype(np.int64)), pa.array(form.tolist()), *[pa.array(x.astype(np.int64), mask=plain) for x in counts]]
                texts = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([field(batch, "row").slice(first, size), *columns, texts], schema.names)

    return given.mapInArrow(run, schema)


def restored(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The exact text, from an output and its form; JVM only."""
    before, between, after = markers

    def part(left: Column | None, marker: str, right: Column | None) -> Column:
        """What stands between a marker found at ``left`` and the next one at ``right``."""
        begin = left + len(marker)
        return F.substring(output, begin, F.length(output) if right is None else right - begin)

    one, two, three = (F.locate(m, output) for m in markers)
    psm = F.concat(part(one, before, two), part(three, after, None), part(two, between, three))
    spm = F.concat(part(one, before, three), part(three, after, None), part(two, between, one))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
