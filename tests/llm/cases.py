"""Documents with everything that is awkward, and what brute force says about them."""

from __future__ import annotations

import hashlib
import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Columns that an operator might use as names of its own.
CLASHING = "row string, class string, size string, n string, key string, id string, label string, spans string, _k1 string, score string, taken string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def passage(seed: int, n: int, words: str = "alder birch cedar elm fir hazel larch maple oak pine rowan willow yew ash beech é日本") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(words.split()) + str(rng.randrange(40)) for _ in range(n))


def documents() -> list[tuple]:
    base, common = passage(1, 120), passage(2, 70)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    texts: list[tuple[int | None, str | None, str | None]] = [
        (5, base, "b"), (3, base, "a"), (9, base, "a"), (9, base, "a"), (4, near, "b"), (12, near + " tail", None),
        (20, common + " " + passage(3, 50), "a"), (21, passage(4, 40) + "\n" + common, "a"), (22, passage(5, 10) + " " + common + " " + common, "c"),
        (30, None, "a"), (31, "", "c"), (32, " \t\n ", None), (33, "one two three", "a"), (34, "One TWO three", "a"), (35, "single", "b"), (36, "single", "b"),
        (None, passage(6, 60), "a"), (None, passage(6, 60), "a"), (40, passage(6, 60) + " more", "d"), (41, passage(7, 30), "a"), (41, passage(8, 30), "a"),
        (50, passage(9, 9000), "b"), (51, "x" * 70_000, "c"), (52, "y" + "x" * 200, "c"), (53, passage(9, 4000) + " " + passage(10, 20), "a"),
        (60, "Naïve ☃ text\r\nwith\x0bmany\x0ckinds of space　and \x00 bytes", "é"), (-1, base + "!", "a"), (2**60, common, "a"),
    ]
    texts += [(100 + k, " ".join([*words[:k], "z%d" % k, *words[k + 1 :]]), "hot") for k in range(30, 60)]
    texts += [(200, "same line again and again for everyone here today " * 12, "hot")] * 8
    return [(i, t, "en", s, len(t or ""), *[f"c{k}" for k in range(CLASHING.count(",") + 1)]) for i, t, s in texts]


def shingles(text: str | None) -> frozenset:
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs: list[tuple[int | None, str | None]]) -> list[int | None]:
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if sets[k] and find(j) == find(k) and docs[j][0] is not None]
        out.append(min(ids) if ids else i)
    return out


def without_repeats(docs: list[tuple[int | None, str | None]], window: int, words: bool) -> list[tuple]:
    """Units, removed units, spans, hash of the rest; a null id is smaller than all."""
    units = [(SPACED.findall(t or "") if words else (t or "").encode()) for _, t in docs]
    order = [float("-inf") if i is None else i for i, _ in docs]
    least: dict = {}
    for i, u in zip(order, units):
        for k in range(len(u) - window + 1):
            w = tuple(u[k : k + window])
            least[w] = min(least.get(w, i), i)
    out = []
    for i, u in zip(order, units):
        gone = [False] * len(u)
        for k in range(len(u) - window + 1):
            if least[tuple(u[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(u, gone) if not g]
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        body = " ".join(kept).encode() if words else bytes(kept)
        out.append((len(u), sum(gone), spans, hashlib.sha256(body).hexdigest()))
    return out


def contamination(text: str | None, items: list[tuple[str | None, str | None]], width: int = 10) -> tuple[int, int, list[str]]:
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, found = [False] * len(words), set()
    for item, body in items:
        w = ALNUM.findall((body or "").translate(LOWER))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            window = w[k : k + width]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit[at : at + len(window)] = [True] * len(window)
                    if item is not None:
                        found.add(item)
    return len(words), sum(hit), sorted(found)
