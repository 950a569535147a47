"""Collocations, legacy archives and fill-in-middle against brute force, with everything that is awkward."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import LOWER, SCHEMA, documents
from compare import connect, difference
from pyspark.sql import functions as F

from syncloom.llm import archives, collocations, fill_middle, queries, textops

ROWS = documents()


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_warc", "op13_fill_middle"])
def test_queries_agree_with_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None


# words and their hashes


def thue_morse(n):
    text = b"a"
    while len(text) < n:
        text += text.translate(bytes.maketrans(b"ab", b"ba"))
    return text


def test_words_are_told_apart_by_their_bytes(monkeypatch):
    one = thue_morse(1024)
    words = [one, one.translate(bytes.maketrans(b"ab", b"ba")), one, b"a" * 300, b"a" * 299 + b"b", b"12345678", b"12345679", b"1234567", b"", b"x\0", b"x"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    assert len(set(textops.word_hash(data, starts, ends).tolist())) == len(set(words))
    for _ in range(2):
        first, number = textops.distinct_words(data, starts, ends)
        assert [words[k] for k in first[number]] == words
        assert len(first) == len(set(words))
        monkeypatch.setattr(textops, "word_hash", lambda data, starts, ends: np.zeros(len(starts), np.uint64))  # all collide


# collocations


def brute_collocations(rows, least, top, cover, depth):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, depth + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = Counter()
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inside = defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        found = []
        for p, a in often.items():
            if 100 * inside[p] >= cover * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out[(lang, rank, p.decode(), -a, left, right, n[lang], -score)] += 1
    return out


@pytest.mark.parametrize(("budget", "cover"), [(1, 100), (40, 60), (1 << 20, 100)])
def test_collocations(spark, budget, cover, few_partitions):
    rng = random.Random(budget)
    words = ["the", "of", "a", "Über", "x1", "end", "日本", "rare"] + [f"w{k}" for k in range(30)]
    weights = [9, 7, 5, 3, 3, 2, 2, 1] + [0.3] * 30
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(30)):
            parts.append("The quick x1 fox" if rng.random() < 0.08 else rng.choices(words, weights)[0])
            parts.append(rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b", " "]))
        texts.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(parts)))
    texts += [("en", None), (None, ""), ("xx", " .,! "), ("en", "the of the of the of the"), ("en", "long" * 500)] + [("de", "same line again and again")] * 30
    df = spark.createDataFrame([(k, t, lang, "c") for k, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string, key string").repartition(3)
    got = collocations.collocations(df, 4, 60, cover, budget=budget, block_bytes=2000)
    assert counted(got, *got.columns) == brute_collocations(texts, 4, 60, cover, 5)


def test_suffixes_are_sent_only_where_pairs_are_frequent(spark, few_partitions, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choices(words, k=40)) + (" one two three, four five" if k % 2 else ".") for k in range(60)]
    pairs = Counter(p for t in texts for piece in re.split("[.,]", t) for w in [piece.split()] for p in zip(w, w[1:]))
    want = 0
    for w in (piece.split() for t in texts for piece in re.split("[.,]", t)):
        good = [pairs[p] >= 20 for p in zip(w, w[1:])]
        want += sum(a and b for a, b in zip(good, good[1:]))
    made, dealt = [], collocations.dealt

    def spy(*given):
        out = dealt(*given)
        made.extend(collocations.bodies_of([bytes(r["body"])], given[-1])[2].sum() for r in out.collect())
        return out

    monkeypatch.setattr(collocations, "dealt", spy)
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(3)
    got = collocations.collocations(df, 20, block_bytes=2000)
    assert counted(got, *got.columns) == brute_collocations([("en", t) for t in texts], 20, 2000, 100, 5)
    assert sum(made) == want == 30 and len(pairs) > 1000


def test_collocations_of_nothing(spark, docs, empty, few_partitions):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(docs, 10**6).count() == 0
    got = collocations.collocations(docs, 8)
    assert counted(got, *got.columns) == brute_collocations([(r[2], r[1]) for r in ROWS], 8, 2000, 100, 5)


def test_numbers_beyond_64_bits(spark):
    key = lambda *ids: b"".join(i.to_bytes(8, "big") for i in ids)
    big = 10**12
    found = spark.createDataFrame([("en", 2, key(1, 2), big)], collocations.PHRASES)
    words = spark.createDataFrame([("en", "a", key(1), 7 * big), ("en", "b", key(2), 3 * big)], "lang string, word string, key binary, f long")
    totals = spark.createDataFrame([("en", 99 * big)], "lang string, n long")
    assert [r["score"] for r in collocations.scored(found, words, totals, 5).collect()] == [1000 * big * 99 * big // (21 * big * big)]


# archives

PAGES = [
    (1, "http://a.example/x y", "<p>one</p>"), (7, "http://b.example/", "<p>one</p>"), (3, None, "<p>one</p>"), (None, "http://c.example/", "<p>one</p>"),
    (4, "http://d.example/", None), (5, "http://e.example/", ""), (6, "http://f.example/é\n", "naïve\r\n\r\nWARC/1.0\r\n\r\n日本\n\n"), (8, "http://g.example/", "z" * 300_000),
    (9, "http://h.example/", "twice"), (9, "http://h.example/", "twice"), (-2, "http://i.example/", "single"), (None, "http://j.example/", "no key"), (None, None, "no key"),
    *[(100 + k, f"http://hot.example/{k}", "the same page") for k in range(40)],
]


def brute_pages(pages, least=0):
    groups = defaultdict(list)
    for page, _, html in pages:
        groups[(html or "").encode()].append(page)
    out = Counter()
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for k, i in enumerate(ids):
            repeat = len(body) >= least and k < len(ids) - 1
            out[(i, len(body), digest, "revisit" if repeat else "response", ids[-1] if repeat else None)] += 1
    return out


@pytest.mark.parametrize("least", [0, 10])
def test_archived(spark, tmp_path, least, few_partitions):
    pages = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    done = archives.archived(pages, least, folder=str(tmp_path))
    columns = ("number", "payload_bytes", "payload_digest", "record_type", "refers_to_number")
    assert counted(done, *columns) == brute_pages(PAGES, least)
    # the archives hold the pages: payloads come back, and urls in the form a header line can hold
    read = archives.read_warc(spark, f"{tmp_path}/warc")
    bodies = {r["number"]: bytes(r["payload"]) for r in read.where("payload is not null and number is not null").collect()}
    assert bodies[6] == PAGES[6][2].encode() and bodies[8] == PAGES[7][2].encode()
    assert {r["uri"] for r in read.where("number in (1, 3, 6)").collect()} == {"http://a.example/x%20y", "unknown:", "http://f.example/é%0A"}
    ids = [r["record_id"] for r in read.collect()]
    assert len(set(ids)) == len(ids) and {r["date"] for r in read.where("record_type <> 'warcinfo'").collect()} == {"2000-01-01T00:00:00Z"}
    kinds = Counter(r["record_type"] for r in read.collect())
    assert kinds["warcinfo"] >= 2  # one per archive
    # the same archives convert to the same records
    archives.convert_arc(spark, f"{tmp_path}/arc", f"{tmp_path}/again", least)
    assert sorted(r["record_id"] for r in archives.read_warc(spark, f"{tmp_path}/again").collect()) == sorted(ids)


def test_archives_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.archived(empty, folder=str(tmp_path)).count() == 0


def test_versions_of_arc():
    body = b"HTTP/1.0 200 OK\r\nContent-Length: 4\r\n\r\n\n\nab"
    old = archives.version_block(1, "x.arc", "19960923142103") + b"\n"
    old += b"http://a.example/with blank 1.2.3.4 19970102 text/html %d\n" % len(body) + body + b"\n"
    old += b"dns:a.example 1.2.3.4 199701020304 text/dns 5\n12345\n\n"
    new = archives.version_block(2, "y.arc") + b"\n" + archives.url_record(2, "y.arc", 99, "http://b.example/", 5, b"zz") + b"\n"
    for data in (old, gzip.compress(old), b"".join(gzip.compress(x) for x in (old[:200], old[200:]))):
        first, page, dns = archives.read_arc(data)
        assert (first.is_version, first.version, page.version, page.fields["URL"], page.block, dns.block) == (True, 1, 1, "http://a.example/with blank", body, b"12345")
        assert page.split == (b"HTTP/1.0 200 OK\r\nContent-Length: 4\r\n\r\n", b"\n\nab") and not dns.http
        made = archives.warc_record(page, "x.arc").decode()
        assert "WARC-Type: response\r\n" in made and "WARC-Date: 1997-01-02T00:00:00Z\r\n" in made and f"Content-Length: {len(body)}\r\n" in made
        assert "WARC-Type: resource\r\n" in (told := archives.warc_record(dns, "x.arc").decode()) and "WARC-Date: 1997-01-02T03:04:00Z" in told and "Content-Type: text/dns" in told
    first, page = archives.read_arc(new)
    assert (first.version, page.version, page.fields["Result-code"], page.fields["Offset"], page.split[1]) == (2, 2, "200", "99", b"zz")
    bare = list(archives.read_arc(new.split(b"zz")[0].split(b"\n", 3)[3].lstrip(b"\n") + b"z"))  # no version block, and cut short
    assert (bare[0].version, bare[0].cut, bare[0].split[1]) == (2, True, b"z") and "WARC-Truncated: length" in archives.warc_record(bare[0], "y").decode()
    with pytest.raises(ValueError, match="at byte"):
        list(archives.read_arc(old + b"no header\n", "x.arc"))


# fill in middle


def brute_middle(key, text, rate=100, spm=50, seed=7):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return key, n, "plain", None, None, text
    if h4 % 100 < spm:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [100, 60])
def test_fill_middle(spark, docs, empty, rate):
    rng = random.Random(rate)
    rows = [(k, "".join(rng.choice(["\n", "\n\n", "a", "é", "日本 x", "<P", "<", "M>", "<S>"[: rng.randrange(4)], "\r\n", " ", "😀"]) for _ in range(rng.randrange(60)))) for k in range(400)]
    rows += [(None, "a\nb\nc"), (-5, "\n" * 70_000 + "end"), (2**62, "x\n" * 60_000 + "y" * 100_000 + "\nz\n"), (9, None), (9, ""), (11, "ab<M>c"), (11, "\n"), (12, "<"), (13, "P>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    done = fill_middle.fill_middle(df, rate=rate).withColumn("again", fill_middle.restored(F.col("output"), F.col("form")))
    assert counted(done, "row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == Counter(brute_middle(k, t, rate) for k, t in rows)
    assert counted(done, "row.doc_id", "again") == Counter((k, t or "") for k, t in rows)
    got = fill_middle.fill_middle(docs, carry=tuple(docs.columns))
    assert counted(got, "row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == Counter(brute_middle(r[0], r[1]) for r in ROWS)
    assert fill_middle.fill_middle(empty).count() == 0


def test_markers_that_overlap_are_refused(docs):
    for markers in (("<P>", "<S>", ">x"), ("aa", "b", "c"), ("<P>", "<P>x", "y"), ("", "a", "b")):
        with pytest.raises(ValueError, match="overlap"):
            fill_middle.fill_middle(docs, markers=markers)


@pytest.mark.parametrize("members", [range(0, 70_000), range(0, 200_000, 7), range(0, 300_000, 23), [5], [0, 65_535, 65_536, 65_537, 400_000], [*range(10), 70_000, *range(131_072, 196_608)]])
def test_boundary_set(members):
    edges = fill_middle.BoundarySet(np.array(list(members)))
    ranks = np.random.default_rng(1).permutation(len(members))
    assert edges.select(ranks).tolist() == [members[k] for k in ranks.tolist()]


def test_containers_are_of_three_kinds():
    kinds = {type(c).__name__ for m in (range(65_536), range(0, 65_536, 7), range(0, 65_536, 100)) for c in fill_middle.BoundarySet(np.array(m)).containers}
    assert kinds == {"RunContainer", "BitmapContainer", "ArrayContainer"}
