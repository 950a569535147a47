"""Vectorised helpers on Arrow text columns: words, rolling hashes, word windows.

A batch's texts are worked on as one byte buffer, cut into chunks of whole texts so that memory follows the chunk (or the
longest single text), never the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64

#: Bytes of words ``[^\x20\x09-\x0D]+`` and, after lower-casing A-Z, of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``. Every byte
#: of a character beyond ASCII belongs to a word in both, so bytes give the same words as characters.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: all bits of the result depend on all bits of ``x``."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def binary(column: pa.Array | pa.ChunkedArray) -> pa.LargeBinaryArray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()).cast(pa.large_binary())


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of whole texts; a null is an empty text."""
    array = binary(column)
    if array.null_count:
        array = array.fill_null(b"")
    n = len(array)
    if not n:
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + n + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words; no word crosses a text."""
    inside = kind[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = offsets[(offsets < len(data))]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[edges] = inside[edges]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0)] - 1
    end[cuts] = inside[cuts]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=object).astype(np.uint64)
LONG_WORD = 256


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number, zeros beyond the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes: eight bytes at a time go through a bijective mixer, long ones through BLAKE2.

    Up to eight bytes of one length never collide; no sums, so no family of texts collides by construction.
    """
    length = ends - starts
    at = eights(data)
    short = np.minimum(length, LONG_WORD)
    total = mix(length.astype(U64) * _STEP + _BASE)
    live, k = np.arange(len(starts)), 0
    while True:
        live = live[short[live] > k]
        if not len(live):
            break
        part = at[starts[live] + k] & _MASKS[np.minimum(length[live] - k, 8)]
        total[live] = mix((total[live] ^ part) * _BASE)
        k += 8
    for k in np.flatnonzero(length > LONG_WORD).tolist():
        total[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return total


def same_stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each stretch has the bytes of stretch ``other``, by the bytes."""
    length = ends - starts
    same = length == length[other]
    at = eights(data)
    live, k = np.flatnonzero(same & (other != np.arange(len(other)))), 0
    while True:
        live = live[length[live] > k]
        if not len(live) or k >= LONG_WORD:
            break
        differs = (at[starts[live] + k] ^ at[starts[other[live]] + k]) & _MASKS[np.minimum(length[live] - k, 8)] != 0
        same[live[differs]] = False
        live, k = live[~differs], k + 8
    for i in live.tolist():
        j = other[i]
        same[i] = bool(np.array_equal(data[starts[i] : ends[i]], data[starts[j] : ends[j]]))
    return same


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, number)``: an occurrence of each different word, and every word's number among them; decided by the bytes."""
    _, first, number = np.unique(word_hash(data, starts, ends), return_index=True, return_inverse=True)
    if same_stretches(data, starts, ends, first[number]).all():
        return first, number
    words = {}
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        words.setdefault(data[a:b].tobytes(), []).append(k)
    first, number = np.array([w[0] for w in words.values()]), np.empty(len(starts), np.int64)
    for n, places in enumerate(words.values()):
        number[places] = n
    return first, number


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` bytes (8 to 16) from each byte on, made of two numbers of eight bytes each."""
    at = eights(data)
    m = max(0, len(data) - n + 1)
    return mix(mix(at[:m]) * _STEP + at[n - 8 : n - 8 + m])


def digests(stretches: list[bytes], salts: np.ndarray) -> np.ndarray:
    """128-bit digests of byte strings with a number each, as pairs of numbers."""
    out = b"".join(hashlib.blake2b(s, digest_size=16, salt=k).digest() for s, k in zip(stretches, salt_bytes(salts)))
    return np.frombuffer(out, "<u8").reshape(-1, 2)


def salt_bytes(salts: np.ndarray) -> list[bytes]:
    raw = salts.astype("<u8").tobytes()
    return [raw[k : k + 8] for k in range(0, len(raw), 8)]


def gram_hash(words: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of one text, and the word each starts at."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = np.zeros(m, U64)
    for k in range(n):
        total = total * _STEP + words[k : k + m]
    where = np.flatnonzero(texts[:m] == texts[n - 1 :])
    return mix(total[where]), where


def bounds(texts: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` texts begins in an array ordered by text; one more for the end."""
    return np.searchsorted(texts, np.arange(n + 1))


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes, where its smallest stands (the first of equals)."""
    m = len(hashes) - width + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    best, at, span = hashes, np.arange(len(hashes)), 1
    while span * 2 <= width:
        n = len(best) - span
        later = best[span:] < best[:n]
        at = np.where(later, at[span:], at[:n])
        best = np.where(later, best[span:], best[:n])
        span *= 2
    reach = width - span
    if reach:
        n = len(best) - reach
        later = best[reach:] < best[:n]
        at = np.where(later, at[reach:], at[:n])
    return at[:m]
