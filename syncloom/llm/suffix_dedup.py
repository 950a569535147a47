"""Substring de-duplication by sorted suffixes: sampled splitters, range partitions, local multikey quicksort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from syncloom.llm.repeats import Route, Scheme, Units, sample, without_repeats

LEAD = 16


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first bytes of suffixes, as fixed-width strings in byte order."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(LEAD)]).view(f"S{LEAD}").ravel()


def splitters(texts: DataFrame, parts: int) -> Route:
    """Ranges of suffixes by their leading bytes, split at evenly spaced members of a sorted sample.

    A range holds all suffixes that begin alike, so no group of equal ones crosses a boundary.
    """
    scheme = Scheme(50, LEAD, words=False)
    some = sorted(sample(texts, scheme, lambda u, data, at: leading(data, at).tolist() if len(at) else []))
    cuts = np.array([some[len(some) * k // parts] for k in range(1, parts)] if some else [], dtype=f"S{LEAD}")

    def route(u: Units, data: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        if not len(anchors):
            return np.zeros(0, np.int64)
        return np.searchsorted(cuts, leading(data, anchors), "right")

    return route


def byte_digits(window: int):  # noqa: ANN201
    """Eight bytes a digit, the highest first; the last digit reaches the window's end and may overlap the one before."""

    def digits(starts: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
        for at in [*range(0, window - 7, 8), *([window - 8] if window % 8 else [])]:
            value = np.zeros(len(starts), np.uint64)
            for k in range(8):
                value = (value << np.uint64(8)) | values[starts + at + k]
            yield value

    return digits


def suffix_dedup(docs: DataFrame, window: int = 50, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with its removed ``spans`` and what is ``kept``: every byte goes that a ``window``-byte string covers which
    also starts in a document with a smaller id.

    Texts are UTF-8 bytes; strings never cross documents and are judged on the input, so overlapping repeats all count. Copies of a
    text keep the one with the smallest id. A null or empty text has no bytes; texts shorter than the window lose
    nothing. A row without an id comes before all others and loses nothing to rows with one. Rows that agree in id
    and text get the same result, rows with equal ids take nothing from each other. An empty table gives an empty result; other columns
    are only carried.

    ``row`` has the carried columns, ``spans`` the removed bytes from ``start`` to before ``end``, ``kept`` the bytes that stay (a span may end within a character);
    ``copy`` says that a row goes whole as a copy. ``doc_id``, ``n_units``, ``n_removed``, ``n_spans`` and ``kept_sha256`` sum these up.

    Suffixes are kept where a repeat can be (around anchors that several documents have), sorted in range partitions by
    sampled splitters. Equal stretches are known by a 64-bit digest; where an anchor has several, their windows are
    compared on the bytes.
    """
    return without_repeats(docs, Scheme(window, LEAD, words=False), splitters, byte_digits(window), text, key, carry)
