"""Every operator over documents with nulls, empty and long texts, copies, ties, repeated ids and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from cases import ALNUM, LOWER, SCHEMA, SPACED, components, contamination, documents, passage, shingles, without_repeats
from pyspark.sql import functions as F

import corpus_pipeline
from syncloom.llm import decontamination, license_scan, mixing, ngram_join, repeats, sharding, suffix_dedup, suffix_trees, token_counts, topk_search, toxicity

ROWS = documents()
PLAIN = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_token_counts(docs, empty):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in PLAIN)
    assert counted(token_counts.token_counts(docs), "row.doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.token_counts(empty).count() == 0


def test_token_counts_of_odd_strings():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.Counter(path)
    rng = random.Random(3)
    bits = ["a", "th", "ing", " ", "  ", "\n", "\t", "▁", "é", "日", "<s>", "\x00", "ＡＢ", "　", "😀", "é", "1", ".", ",,", "'s", "_x", "²."]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert own.count(text) == len(model.encode(text)), repr(text)


def brute_scan(text):
    words = ALNUM.findall((text or "").translate(LOWER))
    places = sorted((k, label) for phrase, label in license_scan.BASE_PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({p[1] for p in places}))


def test_license_scan(spark, docs, empty):
    lines = ["Under the MIT-License. under the mit license", "Apache License, Version 2.0", "CC BY-NC 4.0; cc by nd", "committee accepts", "licensed under the GNU General Public License, version 3", "xunder the mit license", "ÉUnder the mit license under THE\n\nMIT license", "SPDX-License-Identifier: BSD-3-Clause"]
    notices = spark.createDataFrame([(k, t) for k, t in enumerate(lines + [passage(1, 5000) + " cc by nc " + passage(2, 10), None])], "doc_id long, text string")
    for df in (docs, notices):
        rows = df.select("doc_id", "text").collect()
        got = license_scan.license_scan(df)
        assert counted(got, "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == Counter((r.doc_id, *brute_scan(r.text)) for r in rows)
    by = {r.row.doc_id: r for r in got.collect()}
    assert by[4].labels == "gpl-3" and by[7].labels == "bsd-3-clause" and by[2].labels == "cc-by-nc,cc-by-nd"
    assert by[3].score == 0 and by[1].score == 1 and 0 < by[4].score < 1
    assert license_scan.license_scan(empty).count() == 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("GPLv3", "gpl-3"), ("GPLv2 or later", "gpl-2"), ("LGPLv3", "lgpl-3"), ("LGPLv2.1+", "lgpl-2.1"), ("AGPLv3", "agpl-3"), ("MPLv2", "mpl-2"), ("MPLv1.1", "mpl-1.1"),
        ("licensed under the GPL", "gpl"), ("the General Public License", "gpl"), ("GNU Affero General Public License", "agpl"), ("GNU LGPL", "lgpl"),
        ("3-clause BSD licence", "bsd-3-clause"), ("FreeBSD", "bsd-2-clause"), ("version 3 of the GNU General Public License", "gpl-3"), ("GNU General Public Licence v2", "gpl-2"),
        ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1", "lgpl-2.1"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that", "isc"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
        ("Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd-3-clause"),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"), ("to mitigate gplus", ""),
    ],
)
def test_license_signatures(text, labels):
    assert license_scan.scan(text)[4] == labels
    assert bool(license_scan.gate().search(text.lower().encode())) == bool(labels)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: ISC", "isc"), ("// SPDX-License-Identifier: Zlib", "zlib"), ("SPDX-License-Identifier: Artistic-2.0", "artistic-2"),
        ("License: MIT", "mit"), ("MIT licensed", "mit"), ("BSL-1.0", "boost"), ("PostgreSQL License", "postgresql"), ("Python Software Foundation License", "psf-2.0"),
        ("GPLv 3", "gpl-3"), ("LGPLv 2.1", "lgpl-2.1"), ("MPLv 2", "mpl-2"), ("GPLversion 3", "gpl-3"), ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND Zlib", "apache-2,mit,zlib"),
        ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2"), ("SPDX-License-Identifier: MIT-0", "mit-0"), ("licensed under either MIT or Apache-2.0", "apache-2,mit"),
        ("The Software shall be used for Good, not Evil.", "json"), ("Ruby licensed; PHP-3.01 license", "php-3.01,ruby"),
        ("students of MIT and ISC use zlib, Python 2.0 and PHP 3.0", ""), ("ends under the license. Ruby is next", ""), ("a v 3 of 2 0", ""),
    ],
)
def test_license_identifiers(spark, text, labels):
    assert license_scan.scan(text)[4] == labels
    assert [r.labels for r in license_scan.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()] == [labels]


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_license_gate_is_implied_by_every_rule(data):
    rule = data.draw(st.sampled_from(license_scan.rules()))
    text = data.draw(st.from_regex(rule.body, fullmatch=True, alphabet=st.characters(codec="ascii")))
    words = license_scan.Words(text)
    if words.joined == text:  # "[^ ]+" may draw what is no word
        assert license_scan.gate().search(text.encode())
        assert {m.group(1) for m in license_scan.keywords().finditer(text)} & set(rule.words)


def test_license_rules_add_something():
    rules = license_scan.rules()
    assert len(rules) >= 200 and len({r.body for r in rules}) == len(rules)
    for phrase in license_scan.BASE_PHRASES:
        assert license_scan.gate().search(phrase.encode())


def test_license_suppression():
    d = license_scan.Detection
    kept = license_scan.suppress([d(0, 9, "long", 5, 0.5), d(2, 4, "inside", 7, 0.5), d(2, 4, "first", 1, 0.5), d(8, 12, "beside", 9, 0.5), d(0, 9, "same", 6, 0.5)])
    assert [k.label for k in kept] == ["long", "first", "beside"]
    assert len(license_scan.rules()) >= 200


def test_toxicity(spark, docs, empty):
    rng = random.Random(1)
    plain, bad = "the of and river stone house green walk paper cloud".split(), ["vilefoo", "vilebar", "vilebaz"]
    made, labels = [], []
    for k in range(600):
        sentences = [" ".join(rng.choice(plain) for _ in range(8)) for _ in range(rng.randrange(1, 12))]
        toxic = k % 6 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(bad)
        made.append((k, ". ".join(sentences)))
        labels.append((k, int(toxic)))
    corpus = spark.createDataFrame(made, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(corpus, marks, sample=400)
    got = {r.doc_id: r for r in toxicity.toxicity(corpus, model).select("row.doc_id", "score", "predicted", "offending").collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(got[k].predicted == labels[k][1] for k in held) >= 0.97 * len(held)
    for k in held:
        if got[k].predicted and labels[k][1]:
            body = made[k][1].encode()
            assert any("vile" in body[s.start : s.end].decode() for s in got[k].offending)
    scores = toxicity.toxicity(docs, model).select("row.doc_id", "score").collect()
    assert len(scores) == len(ROWS) and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.toxicity(empty, model).count() == 0
    none = toxicity.train(empty, marks.limit(0))
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}


def test_ngram_components(docs, empty):
    want = Counter((i, len(shingles(t)), c) for (i, t), c in zip(PLAIN, components(PLAIN)))
    assert counted(ngram_join.ngram_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.ngram_components(empty).count() == 0


def test_drop_near_copies(docs):
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert not got - Counter(PLAIN)
    named = defaultdict(set)
    for (i, t), c in zip(PLAIN, components(PLAIN)):
        if shingles(t):
            named[c].add((i, t))
        else:
            assert (i, t) in got  # nothing to link by
    for group in named.values():
        stay = [d for d in group if d in got]
        assert stay and all(got[d] == 1 for d in stay)
    # one of each component: distinct sets of one id (41) are two components
    assert sum(1 for i, t in got if shingles(t)) == len({c for (i, t), c in zip(PLAIN, components(PLAIN)) if shingles(t)}) + 1


@pytest.mark.parametrize("words", [False, True])
def test_substring_dedup(docs, empty, words):
    operator = suffix_trees.tree_dedup if words else suffix_dedup.suffix_dedup
    want = Counter((i, *w) for (i, _), w in zip(PLAIN, without_repeats(PLAIN, 13 if words else 50, words)))
    assert counted(operator(docs), "doc_id", "n_units", "n_removed", "n_spans", "kept_sha256") == want
    assert operator(empty).count() == 0


def test_sample_of_a_frequent_passage(spark, monkeypatch):
    texts = [(str(k).encode(), f"{k} " + " ".join(f"w{j}" for j in range(30))) for k in range(300)]
    df = spark.createDataFrame(texts, "class binary, text string").coalesce(2)
    made, distinct = [], type(df).distinct
    monkeypatch.setattr(type(df), "distinct", lambda self: made.append(self.count()) or distinct(self))
    some = repeats.sample(df, repeats.Scheme(13, 5, words=True), lambda u, data, at: [b"%d" % u.values[k] for k in at.tolist()])
    assert len(some) == len(set(some)) and made[0] <= 2 * len(some)


@pytest.mark.parametrize("words", [False, True])
def test_substring_dedup_gives_texts_and_spans(docs, words):
    operator = suffix_trees.tree_dedup if words else suffix_dedup.suffix_dedup
    window = 13 if words else 50
    got = operator(docs, carry=tuple(docs.columns)).select("row.doc_id", "row.text", "row.source", "row.spans", F.col("spans").alias("gone"), "kept", "copy").collect()
    assert Counter((r.doc_id, r.text, r.source, r.spans) for r in got) == Counter((r[0], r[1], r[3], r[SCHEMA.split(", ").index("spans string")]) for r in ROWS)
    want = Counter((i, *w) for (i, _), w in zip(PLAIN, without_repeats(PLAIN, window, words)))
    seen = Counter()
    for r in got:
        units = SPACED.findall(r.text or "") if words else (r.text or "").encode()
        stay = [u for k, u in enumerate(units) if not any(s.start <= k < s.end for s in r.gone)]
        kept = " ".join(stay) if words else bytes(stay)
        assert r.kept == kept and (not r.copy or not kept)
        digest = hashlib.sha256(kept.encode() if words else kept).hexdigest()
        seen[(r.doc_id, len(units), len(units) - len(stay), len(r.gone), digest)] += 1
    assert seen == want and any(r.copy for r in got)


def test_sharding(docs, empty):
    got = sharding.histogram_shards(docs, shards=4).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in PLAIN)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert sharding.histogram_shards(empty).count() == 0


def test_sharding_is_even(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy" * 20)).otherwise(F.repeat(F.col("id").cast("string"), 20)).alias("text"))
    once = many.unionByName(many.where("doc_id = 3").crossJoin(spark.range(8000)).select("doc_id", "text"))  # rows alike in all
    sizes = [r.b for r in sharding.histogram_shards(once, shards=7, rows_per_part=500).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 7 + 2 * 150


def brute_targets(sizes, weights, share, epochs):
    """Pour in proportion to the weights again and again; what exceeds a lid is poured anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    lid, out, budget = {s: epochs * n for s, n in sizes.items()}, {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in out]
        left = budget - sum(out.values())
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if each[s] > lid[s]]
        if not over:
            return out | each
        out |= {s: lid[s] for s in over}


def test_mixing(docs, empty):
    got = mixing.mix(docs, carry=docs.columns).select("doc_id", "size", "source_size", "target", "taken", "copies", "row.source").collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(SPACED.findall(t or ""))) for i, t in PLAIN)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 2
    want = brute_targets(sizes, mixing.WEIGHTS, 1.5, 2)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    again = mixing.mix(docs.repartition(5)).select("doc_id", "size", "taken")
    by = Counter((r.doc_id, r["size"], r.taken) for r in got if r.doc_id not in (9, 200))
    assert Counter(tuple(r) for r in again.where("doc_id is null or doc_id not in (9, 200)").collect()) == by
    assert mixing.mix(empty).count() == 0


def test_mixing_splits_copies(spark):
    same = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("one and the same text").alias("text"), F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("source"))
    got = mixing.mix(same, weights=(1.0, 1.0), share=0.5).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 5 for r in got)


def test_topk(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(x) for x in rng.normal(size=8)] for _ in range(300)]
    rows = [(k, v, "x", 0) for k, v in enumerate(vectors)] + [(50, vectors[3], "x", 1), (50, vectors[3], "x", 1), (700, None, "x", 1), (750, [1.0, None] * 4, "x", 1), (800, [float("nan")] * 8, "y", 1), (850, [float("inf")] * 8, "y", 1), (900, [1.0, 2.0], "y", 1), (901, [1.0, 2.0], "y", 1), (None, vectors[0], "z", 1), (950, [], "z", 1)]
    rows += [(1000 + k, vectors[9], "x", 1) for k in range(60)] + [(2000, [1e30] * 8, "x", 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, uid string, score int")
    got = [tuple(r) for r in topk_search.exact_topk(table, F.col("vec_id") % 50 == 0).collect()]
    limit = 2**63

    def whole(x):
        return max(-limit, min(limit - 1, int(np.floor(256.0 * x)) if abs(x) < 1e200 else 0))

    usable = [(i, [whole(x) for x in v]) for i, v, _, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for a, (i, v) in enumerate(usable):
        if i % 50 == 0:
            scored = sorted((-max(-limit, min(limit - 1, sum(x * y for x, y in zip(v, w)))), j) for b, (j, w) in enumerate(usable) if b != a and len(w) == len(v))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:5])]
    assert Counter(got) == Counter(want)
    assert topk_search.exact_topk(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_merges_lists_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD_TILE", 8)
    monkeypatch.setattr(topk_search, "QUERY_TILE", 3)
    monkeypatch.setattr(topk_search, "FAN_IN", 4)
    table = spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[(F.xxhash64("id", F.lit(k)) % 1000 / 1000.0) for k in range(4)]).alias("embedding")).cache()
    got = {tuple(r) for r in topk_search.exact_topk(table, F.col("vec_id") % 50 == 0).collect()}
    vectors = {r.vec_id: [int(np.floor(256 * x)) for x in r.embedding] for r in table.collect()}
    for q in range(0, 400, 50):
        scored = sorted((-sum(x * y for x, y in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:5]
        assert {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)} <= got


ITEMS = [("1", passage(2, 14)), ("2", passage(1, 40)), ("10", "one two THREE"), ("3", None), ("4", ""), ("5", "..."), (None, passage(6, 12)), ("2", passage(1, 40)), ("7", passage(1, 25))]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 100])
def test_contamination(spark, docs, empty, slice_bytes):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = decontamination.contamination(docs, items, slice_bytes=slice_bytes)
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    got = Counter((r.doc_id, r.n_words, r.hit, tuple(r["items"])) for r in got.select("row.doc_id", "n_words", size.alias("hit"), "items").collect())
    want = Counter()
    for i, t in PLAIN:
        n, hit, found = contamination(t, ITEMS)
        want[(i, n, hit, tuple(found))] += 1
    assert got == want
    assert decontamination.contamination(empty, items).count() == 0
    assert {r.n for r in decontamination.contamination(docs, items.limit(0)).select(F.size("spans").alias("n")).collect()} == {0}


def test_decontaminate(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    done = decontamination.decontaminate(docs, items)
    assert done.columns == docs.columns
    before, after = Counter(PLAIN), Counter((r.doc_id, r.text) for r in done.collect())
    for (i, t), n in before.items():
        if not contamination(t, ITEMS)[1]:
            assert after[(i, t)] == n
    for i, t in after:
        words = ALNUM.findall((t or "").translate(LOWER))
        assert not any(words[k : k + 14] == passage(2, 14).split() for k in range(len(words)))


def test_fm_index():
    rng = np.random.default_rng(5)
    for symbols in (2, 5, 40):
        values = rng.integers(0, symbols, 500)
        index = decontamination.FMIndex(values, symbols)
        phrases = np.array([[0] * (4 - n) + rng.integers(1, symbols, n).tolist() for n in rng.integers(1, 5, 60)])
        lengths = (phrases > 0).sum(1)
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high):
            places = sorted(index.locate(np.arange(a, max(a, b))).tolist())
            assert places == [k for k in range(500 - n + 1) if (values[k : k + n] == p[4 - n :]).all()]


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, 0), (3, 0), (33, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "mixing", "sharding"]
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        result = stage(spark, given, str(tmp_path))
        if name != "sharding":
            assert result.columns == given.columns
        result.write.parquet(out)
        given = spark.read.parquet(out)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == given.count() > 0


def test_minimizers_and_chunks():
    from syncloom.llm.textops import chunks, minimizers

    values = np.random.default_rng(1).integers(0, 9, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 35, 200, 201):
        assert minimizers(values, width).tolist() == [k + int(np.argmin(values[k : k + width])) for k in range(200 - width + 1)]
    texts = pa.array(["ab", None, "", "é" * 10, "c"])
    got = [(first, bytes(data), offsets.tolist()) for first, data, offsets in chunks(texts, 4)]
    assert b"".join(d for _, d, _ in got) == ("ab" + "é" * 10 + "c").encode() and got[0][0] == 0 and got[-1][0] in (3, 4)
