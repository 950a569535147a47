"""Substring de-duplication by suffix trees over prefix partitions: variable-length prefixes, one subtree per prefix."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from syncloom.llm.repeats import Route, Scheme, Units, chain, sample, without_repeats
from syncloom.llm.textops import U64

GRAM = 5


def prefix_parts(texts: DataFrame, parts: int, scheme: Scheme) -> Route:
    """Groups of suffixes by as many leading words as make them small enough, put together to partitions of like size.

    A prefix that a sample shows to be too frequent is replaced by its continuations with one more word, up to the anchor's
    words. Prefixes that the sample does not hold go by their hash.
    """

    def keep(u: Units, data: np.ndarray, at: np.ndarray) -> list[bytes]:
        return np.stack([chain(u.values, n)[at] for n in range(1, scheme.gram + 1)], 1).astype("<u8").view(f"V{8 * scheme.gram}").ravel().tolist() if len(at) else []

    paths = [tuple(np.frombuffer(b, "<u8").tolist()) for b in sample(texts, scheme, keep)]
    room = max(1, len(paths) // (4 * parts))
    split_at: set[int] = set()  # prefixes that are continued
    leaves: list[tuple[int, int]] = []
    level = [(paths, 0)]
    while level:
        deeper = []
        for group, depth in level:
            count = Counter(p[depth] for p in group)
            for prefix, n in count.items():
                if n > room and depth + 1 < scheme.gram:
                    split_at.add(prefix)
                else:
                    leaves.append((prefix, n))
            again = [p for p in group if p[depth] in split_at]
            if again:
                deeper.append((again, depth + 1))
        level = deeper
    # leaves in the order of their hashes fill one partition after the other
    leaves.sort()
    sizes = np.cumsum([n for _, n in leaves]) if leaves else np.zeros(0)
    of_leaf = (np.minimum(sizes - 1, sizes[-1] - 1) * parts // sizes[-1]).astype(np.int64) if leaves else np.zeros(0, np.int64)
    known = np.array([p for p, _ in leaves], U64)
    inner = np.array(sorted(split_at), U64)

    def among(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(ordered):
            return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
        return ordered[at] == values, at

    def route(u: Units, data: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(anchors), np.int64)
        live = np.arange(len(anchors))
        for n in range(1, scheme.gram + 1):
            if not len(live):
                break
            prefix = chain(u.values, n)[anchors[live]]
            goes_on = among(prefix, inner)[0] if n < scheme.gram else np.zeros(len(live), bool)
            stop, rest = live[~goes_on], prefix[~goes_on]
            found, at = among(rest, known)
            out[stop] = np.where(found, of_leaf[at] if len(of_leaf) else 0, (rest % U64(parts)).astype(np.int64))
            live = live[goes_on]
        return out

    return route


def word_digits(window: int):  # noqa: ANN201
    """One word a level: a node of the tree at some depth is a group of windows that agree in so many words."""

    def digits(starts: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
        for depth in range(window):
            yield values[starts + depth]

    return digits


def tree_dedup(docs: DataFrame, window: int = 13, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row with its removed ``spans`` and what is ``kept``: every word goes that a window of ``window`` words covers
    whose words also start in a document with a smaller id.

    Words are what white space separates, unchanged; windows never cross documents and are judged on the input. Copies of a
    text keep the one with the smallest id. A null or empty text has no words; texts of fewer words than the window
    lose nothing. A row without an id comes before all others and loses nothing to rows with one. Rows that agree in id and text get the
    same result, rows with equal ids take nothing from each other. An empty table gives an empty result; other columns are only carried.

    ``row`` has the carried columns, ``spans`` the removed words from ``start`` to before ``end``, ``kept`` the text that stays (words joined by one space);
    ``copy`` says that a row goes whole as a copy. ``doc_id``, ``n_units``, ``n_removed``, ``n_spans`` and ``kept_sha256`` sum these up.

    Suffixes are kept where a repeat can be (around anchors that several documents have) and dealt to partitions by
    variable-length prefixes. In a partition windows are refined level by level, one word each; groups of one
    document are done, and those left at the window's end are the repeats. No tree is kept. Words are compared by 64-bit hashes, equal stretches by a digest.
    """
    scheme = Scheme(window, GRAM, words=True)
    return without_repeats(docs, scheme, lambda texts, parts: prefix_parts(texts, parts, scheme), word_digits(window), text, key, carry)
