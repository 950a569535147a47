"""N-gram Jaccard join by vertical partitioning, and the components of its links.

The n-grams of the documents that can have a link at all get one global order, rare ones first. The order is cut into fragments, so
every document is cut into segments; how much two documents share is counted in each fragment separately and summed per
pair. Candidates are pairs that share one of the n-grams in either's prefix of that order. Documents known to be
connected already are not compared again, so a large group of near copies costs about one comparison per member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from syncloom.llm.blocks import frequencies, owners, parts_for, release, text_classes
from syncloom.llm.components import components
from syncloom.llm.textops import LOWER, SPACED, U64, gram_hash, word_hash, word_spans
from syncloom.session import scratch_path, stored

WIDTH = 5
FRAGMENTS = 8
#: Most rounds in which one leader per n-gram is compared with the others before all remaining pairs are; one that links
#: nothing is the last.
LEADER_ROUNDS = 6


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Every text's different n-grams in the order of their hashes, and how many there are."""
    low = LOWER[data]
    starts, ends, owner = word_spans(low, offsets, SPACED)
    n = len(offsets) - 1
    words = word_hash(low, starts, ends)
    per = np.bincount(owner, minlength=n)
    grams, where = gram_hash(words, owner, width)
    keys, owners = [grams], [owner[where]]
    for short in range(1, width):  # a text of fewer words is one n-gram
        if (per == short).any():
            g, w = gram_hash(words, owner, short)
            whole = per[owner[w]] == short
            keys.append(g[whole])
            owners.append(owner[w][whole])
    key, own = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, own))
    key, own = key[order], own[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    return key[fresh], np.bincount(own[fresh], minlength=n)


def need(n: np.ndarray) -> np.ndarray:
    """N-grams a set of ``n`` shares at least with any set it is linked with."""
    return (3 * n + 3) // 4


def slack(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, n // 4)


def prefixes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """About the lower half of every set by hash: linked sets share at least a quarter of the smaller one there."""
    keys, n = shingle_sets(data, offsets)
    length = np.where(n > 0, n - need(n) + slack(n), 0)
    rank = np.arange(len(keys)) - np.repeat(np.cumsum(n) - n, n)
    return keys[rank < np.repeat(length, n)], length, n


def may_link(classes: list[bytes], per: np.ndarray, n: np.ndarray, places: np.ndarray, documents: np.ndarray, _: np.ndarray | None) -> pa.Table:
    """Sizes, and whether enough of the prefix occurs elsewhere for a link with any set of an allowed size."""
    shared = np.bincount(owners(per, places), minlength=len(per))
    possible = (n > 0) & (shared >= slack(need(n)))
    return pa.table([pa.array(classes, pa.binary()), pa.array(n), pa.array(possible)], ["class", "n", "possible"])


def whole_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, n = shingle_sets(data, offsets)
    return keys, n, n


def in_order(classes: list[bytes], per: np.ndarray, n: np.ndarray, places: np.ndarray, documents: np.ndarray, keys: np.ndarray | None) -> pa.Table:
    """Sets in the global order (documents per n-gram, hash), without the n-grams of one document only, which come first.

    ``place`` is an n-gram's number in its whole set; ``order`` is what fragments are cut by.
    """
    own = owners(per, places)
    sort = np.lexsort((keys, documents, own))
    key, df, own = keys[sort], documents[sort], own[sort]
    shared = np.bincount(own, minlength=len(per))
    edges = np.concatenate([[0], np.cumsum(shared)])
    place = np.arange(len(key)) - edges[own] + (per - shared)[own]
    order = (df << 48) | (key >> U64(16)).astype(np.int64)
    offsets = pa.array(edges.astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (key.view(np.int64), order, place.astype(np.int32))]
    return pa.table([pa.array(classes, pa.binary()), pa.array(n.astype(np.int32)), *lists], ["class", "n", "keys", "orders", "places"])


SETS = "class binary, n int, keys array<bigint>, orders array<bigint>, places array<int>"


def fragments(sets: DataFrame, count: int) -> DataFrame:
    """``node, segments``: the global order is cut where about equal numbers of n-grams fall between; a set's n-grams by fragment."""
    probes = sets.select(F.explode(F.filter("orders", lambda o: o.bitwiseAND(F.lit(15)) == 0)).alias("o"))
    cuts = probes.agg(F.percentile_approx("o", [k / count for k in range(1, count)], 1000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]

    def segment(low: int | None, high: int | None) -> Column:
        pairs = F.arrays_zip("keys", "orders")
        inside = F.filter(pairs, lambda p: (F.lit(True) if low is None else p["orders"] >= low) & (F.lit(True) if high is None else p["orders"] < high))
        return F.transform(inside, lambda p: p["keys"])

    return sets.select("node", F.array(*[segment(low, high) for low, high in zip(edges, edges[1:])]).alias("segments"))


def linked(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Of ``a, na, b, nb`` the pairs that are linked: partial overlaps fragment by fragment, summed per pair.

    A pair is one row. Once the overlap so far and what is left of the smaller set cannot suffice, the other fragments are not looked at.
    """
    left = segments.select(F.col("node").alias("a"), F.col("segments").alias("sa"))
    right = segments.select(F.col("node").alias("b"), F.col("segments").alias("sb"))
    none = F.struct(F.lit(0).alias("o"), rest("sa").alias("ra"), rest("sb").alias("rb"))

    def count(done: Column, s: Column) -> Column:
        hope = 7 * (done["o"] + F.least(done["ra"], done["rb"])) >= 3 * (F.col("na") + F.col("nb"))
        partial = F.when(hope, F.size(F.array_intersect(s["sa"], s["sb"]))).otherwise(F.lit(0))
        return F.struct((done["o"] + partial).alias("o"), (done["ra"] - F.size(s["sa"])).alias("ra"), (done["rb"] - F.size(s["sb"])).alias("rb"))

    overlap = F.aggregate(F.arrays_zip("sa", "sb"), none, count, lambda done: done["o"])
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", overlap.alias("o"))
    return both.where("100 * o >= 75 * (na + nb - o)").select("a", "b")


def rest(segments: str) -> Column:
    """All n-grams of all fragments."""
    return F.aggregate(segments, F.lit(0), lambda n, s: n + F.size(s))


def near(na: str, nb: str) -> Column:
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * 75


def merge(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """``node, n, label`` with the labels that links connect made one, and whether there are any."""
    links = stored(links, scratch_path(labels.sparkSession, "links"))
    if not links.take(1):
        return labels, False
    one, two = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    edges = links.join(one, "a").join(two, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    found = components(edges).withColumnRenamed("node", "_l")
    out = labels.join(found, F.col("label") == F.col("_l"), "left").select("node", "n", F.coalesce("component", "label").alias("label"))
    return stored(out, scratch_path(labels.sparkSession, "labels")), True


def prefix_length(n: str | Column) -> Column:
    """So many n-grams of a set come before those that alone could make a link."""
    n = F.col(n) if isinstance(n, str) else n
    return n - F.floor((3 * n + 3) / 4) + 1


def connect(sets: DataFrame) -> DataFrame:
    """``node, n, label``: linked sets have one label.

    First one leader of each n-gram is compared with the others there, round after round until that links nothing more; large groups of near
    copies collapse that way. Then all pairs that are left are compared. The rounds change the work, never the result.
    """
    spark = sets.sparkSession
    segments = stored(fragments(sets, FRAGMENTS), scratch_path(spark, "segments"))
    n = F.col("n")
    prefix = F.filter(F.arrays_zip("keys", "places"), lambda p: p["places"] < prefix_length(n))
    own = (F.col("n") - F.size("keys")).alias("own")
    postings = sets.select("node", n, own, F.explode(prefix).alias("p")).select("node", "n", "own", F.col("p.keys").alias("key"), F.col("p.places").alias("place"))
    apart = stored(postings.withColumn("label", F.col("node")), scratch_path(spark, "postings"))
    labels = stored(sets.select("node", "n", F.col("node").alias("label")), scratch_path(spark, "labels"))
    for seed in range(LEADER_ROUNDS):
        labels, more = merge(labels, linked(leaders(apart, seed), segments))
        if not more:
            break
        apart = still_apart(apart, labels)
    return merge(labels, linked(others(apart), segments))[0]


def still_apart(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings of the n-grams whose documents are not all connected yet."""
    now = postings.drop("label").join(labels.select("node", "label"), "node")
    keys = now.groupBy("key").agg(F.min("label").alias("_1"), F.max("label").alias("_2")).where("_1 <> _2").select("key")
    return stored(now.join(keys, "key"), scratch_path(postings.sparkSession, "apart"))


def leaders(postings: DataFrame, seed: int) -> DataFrame:
    """Pairs of one document of each n-gram with every other one there.

    Documents have one rank for all n-grams, so those of a group agree on its leader: first the one with the smallest share of n-grams of
    its own, which is nearest to what the group has in common; then by a hash of the round.
    """
    chance = F.xxhash64(F.lit(seed), "node")
    rank = F.struct((F.col("own") / F.col("n") if seed == 0 else F.lit(0.0)).alias("s"), chance.alias("h"), F.col("node"), F.col("n"), F.col("label"))
    first = postings.groupBy("key").agg(F.min(rank).alias("l"))
    first = first.select("key", F.col("l.node").alias("lead"), F.col("l.n").alias("ln"), F.col("l.label").alias("ll"))
    pairs = postings.join(first, "key").where((F.col("label") != F.col("ll")) & near("n", "ln"))
    turned = F.col("lead") < F.col("node")
    return pairs.select(
        F.when(turned, F.col("lead")).otherwise(F.col("node")).alias("a"),
        F.when(turned, F.col("ln")).otherwise(F.col("n")).alias("na"),
        F.when(turned, F.col("node")).otherwise(F.col("lead")).alias("b"),
        F.when(turned, F.col("n")).otherwise(F.col("ln")).alias("nb"),
    ).distinct()


def others(postings: DataFrame) -> DataFrame:
    """All remaining pairs that share an n-gram of their prefixes and are not connected, if what follows it can still suffice."""
    a = postings.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("label").alias("la"))
    b = postings.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("label").alias("lb"))
    # for two sets' first common n-gram: they share it and at most what either has after it
    enough = 7 * F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= 3 * (F.col("na") + F.col("nb"))
    return a.join(b, "key").where((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & near("na", "nb") & enough).select("a", "na", "b", "nb").distinct()


def _classes(docs: DataFrame, text: str, key: str, texts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``class, n`` of all texts, and ``class, label`` of those that are connected with others or could be."""
    spark = docs.sparkSession
    if texts is None:
        _, texts = text_classes(docs, text, key)
    release(spark)
    parts = parts_for(texts)
    sizes = frequencies(texts, prefixes, may_link, "class binary, n bigint, possible boolean", parts)
    sizes = stored(sizes, scratch_path(spark, "sizes"))
    release(spark)
    some = texts.join(sizes.where("possible").select("class"), "class")
    sets = frequencies(some, whole_sets, in_order, SETS, parts, with_keys=True)
    sets = stored(sets.where(F.size("keys") > 0).withColumn("node", F.monotonically_increasing_id()), scratch_path(spark, "sets"))
    release(spark)
    labels = connect(sets)
    release(spark)
    return sizes, sets.select("class", "node").join(labels, "node").select("class", "label")


def ngram_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: near copies (Jaccard of 5-word shingles at least 0.75) have one component.

    Words are lower-cased (A-Z) and separated by white space. A text of one to four words has one n-gram, all its words. A
    null or empty text, or one without words, has none and is linked with nothing, not even its copies; its component is
    its own id. Equal texts are one class from the start, so groups of copies never meet as rows. A component is named
    by its smallest id; null ids do not count, and a component of null ids only is null. Repeated rows get equal results;
    an empty table gives an empty result. Other columns are not read. N-grams are compared by 64-bit hashes.
    """
    rows, texts = text_classes(docs, text, key)
    sizes, labels = _classes(docs, text, key, texts)
    # a class's smallest id, then a component's
    least = stored(rows.groupBy("class").agg(F.min("doc_id").alias("id")), scratch_path(docs.sparkSession, "least"))
    ids = least.join(labels.select("class", "label"), "class")
    named = ids.groupBy("label").agg(F.min("id").alias("component")).join(labels.select("class", "label"), "label").select("class", "component")
    about = sizes.select("class", "n").join(least, "class").join(named, "class", "left")
    about = about.select(F.col("class").alias("_c"), "n", F.coalesce("component", "id").alias("component"))
    joined = rows.join(about, F.col("class") == F.col("_c"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id stays.

    Null ids come last. Rows whose text has no words are linked with nothing and all stay. Of rows that agree in id and
    text one stays. All columns are kept as they are, whatever their names.
    """
    spark = docs.sparkSession
    sizes, labels = _classes(docs, text, key)
    own = F.unhex(F.md5(F.coalesce(docs[f"`{text}`"].cast("string"), F.lit("")).cast("binary")))
    given = docs.select(F.struct("*").alias("row"), docs[f"`{key}`"].cast("long").alias("id"), own.alias("class"))
    ids = given.groupBy("class", "id").agg(F.count(F.lit(1)).alias("rows"))
    first = ids.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("_"), F.col("id"), F.col("rows"))).alias("f"))
    first = first.select("class", "f.id", "f.rows").join(sizes.select("class", "n"), "class").join(labels.select("class", "label"), "class", "left")
    best = F.min(F.struct(F.col("id").isNull().alias("_"), F.col("id"), F.col("class"), F.col("rows"))).alias("f")
    alone = F.when(F.col("label").isNull(), F.col("class")).alias("alone")
    keep = first.where("n > 0").groupBy("label", alone).agg(best).select("f.class", "f.id", "f.rows", F.lit(False).alias("every"))
    keep = keep.unionByName(first.where("n = 0").select("class", "id", F.lit(1).cast("long").alias("rows"), F.lit(True).alias("every")))
    keep = stored(keep, scratch_path(spark, "keep")).select(F.col("class").alias("_c"), F.col("id").alias("_id"), "rows", "every")
    kept = given.join(keep, F.col("class") == F.col("_c")).where(F.col("every") | F.col("id").eqNullSafe(F.col("_id")))
    # few classes have their first id twice; only their rows are brought together
    one, many = kept.where("rows = 1").select("row"), kept.where("rows > 1").groupBy("class").agg(F.any_value("row").alias("row")).select("row")
    return one.unionByName(many).select("row.*")
