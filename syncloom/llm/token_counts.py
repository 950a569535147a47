"""Token counts of a byte-pair model by merging alone: no token ids are made.

A word starts as a linked list of its characters. A heap holds the adjacent pairs that form a piece, best score first,
the left one of equals first; the best is merged until none is left. The count is the initial symbols less the merges,
plus the extra bytes of characters the model spells byte by byte.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from syncloom.llm.rows import per_text
from syncloom.llm.textops import binary

SPACE = "▁"
MEMO_WORDS, MEMO_LENGTH = 500_000, 64

SCHEMA = T.StructType([T.StructField("n_bytes", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False)])


#: A heap entry is one integer: place of the score, then the left symbol, then the length the pair had.
_BITS = 31
_LOW = (1 << _BITS) - 1


def merges(word: str, rank: dict[str, int]) -> tuple[int, list[str]]:
    """Number of merges and the symbols that remain; ``rank`` has a piece's place by score, shifted above the rest."""
    n = len(word)
    parts: list[str] = list(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get, heap, done = rank.get, [], 0
    for i in range(n - 1):
        place = get(word[i : i + 2])
        if place is not None:
            heap.append(place + (i << _BITS) + 2)
    heapify(heap)
    while heap:
        entry = heappop(heap)
        left, length = (entry >> _BITS) & _LOW, entry & _LOW
        here, right = parts[left], after[left]
        if not here or right >= n or len(here) + len(parts[right]) != length:
            continue  # one of the two has been merged since
        joined = parts[left] = here + parts[right]
        parts[right] = ""
        after[left] = follow = after[right]
        done += 1
        if follow < n:
            before[follow] = left
            pair = joined + parts[follow]
            place = get(pair)
            if place is not None:
                heappush(heap, place + (left << _BITS) + len(pair))
        lead = before[left]
        if lead >= 0:
            pair = parts[lead] + joined
            place = get(pair)
            if place is not None:
                heappush(heap, place + (lead << _BITS) + len(pair))
    return done, [p for p in parts if p]


LETTER = r"[^\W\d_]"


def cutters(pieces: list[str]) -> tuple[re.Pattern[str], re.Pattern[str]]:
    """Where no merge can reach across, as the vocabulary shows: words (before a space mark, if no piece has one after
    another character), and within a word between letters and the marks that no piece joins with a letter."""
    words = re.compile(r"(?s).+" if any(SPACE in p.lstrip(SPACE) for p in pieces) else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
    joined = {pair for p in pieces for pair in zip(p, p[1:])}
    beside = {b if re.match(LETTER, a) else a for a, b in joined if re.match(LETTER, a) or re.match(LETTER, b)}
    marks = {c for c in "\n\t\r!\"#$%&'()*+,-./:;<=>?@[]^`{|}~" if c not in beside}
    some = "".join(map(re.escape, sorted(marks)))
    return words, re.compile(rf"(?<={LETTER})(?=[{some}])|(?<=[{some}])(?={LETTER})" if marks else "(?!)")


class Counter:
    """Counts tokens of texts as the sentencepiece library does with the same BPE model."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.known = {model.id_to_piece(i) for i in ids}
        long = {p: model.get_score(i) for i in ids if len(p := model.id_to_piece(i)) > 1}
        places = {score: k for k, score in enumerate(sorted(set(long.values()), reverse=True))}
        self.rank = {p: places[score] << 2 * _BITS for p, score in long.items()}
        self.cut, self.inner = cutters(list(long))
        self.memo: dict[str, int] = {}

    def part(self, part: str) -> int:
        done, rest = merges(part, self.rank)
        return len(part) - done + sum(len(p.encode("utf-8", "replace")) - 1 for p in rest if p not in self.known)

    def cached(self, key: str, count: Callable[[str], int]) -> int:
        n = count(key)
        if len(key) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[key] = n
        return n

    def word(self, word: str) -> int:
        parts = self.inner.split(word)
        if len(parts) == 1:
            return self.part(word)
        get = self.memo.get
        return sum(self.cached(p, self.part) if (n := get(p)) is None else n for p in parts)

    def count(self, text: str) -> int:
        if not text:
            return 0
        get, total = self.memo.get, 0
        for word in self.cut.findall(SPACE + text.replace(" ", SPACE)):
            n = get(word)
            total += self.cached(word, self.word) if n is None else n
        return total


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One per worker process: the vocabulary is read once, the memo serves all its tasks."""
    return Counter(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, model: str | None = None, limit: int = 4096, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns), ``n_bytes``, ``n_tokens``, ``over_limit`` of every whole text.

    ``model`` is the path of a sentencepiece BPE model that every executor has (the installed public one by default).
    A null or empty text has no bytes and no tokens; very long texts are counted whole, word by word; repeated rows stay
    rows; an empty table gives an empty result; other columns are not touched, whatever they are called. The heap holds
    one word at a time, so memory follows the longest word, and the memo of counted words is bounded.
    """

    def make():  # noqa: ANN202
        count = counter(model or default_model()).count

        def fn(texts: pa.Array) -> list[pa.Array]:
            sizes = pc.fill_null(pc.binary_length(binary(texts)), 0).cast(pa.int64())
            tokens = np.fromiter((count(t.as_py() or "") for t in texts), np.int64, len(texts))
            return [sizes, pa.array(tokens)]

        return fn

    return per_text(docs, make, SCHEMA, text, carry).withColumn("over_limit", F.col("n_tokens") > limit)
