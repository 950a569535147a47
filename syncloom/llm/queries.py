"""Registered queries of the operators: thin, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncloom.llm.archives import archived
from syncloom.llm.collocations import collocations
from syncloom.llm.decontamination import contamination
from syncloom.llm.fill_middle import fill_middle, restored
from syncloom.llm.license_scan import license_scan
from syncloom.llm.mixing import mix
from syncloom.llm.ngram_join import ngram_components
from syncloom.llm.sharding import histogram_shards
from syncloom.llm.suffix_dedup import suffix_dedup
from syncloom.llm.suffix_trees import tree_dedup
from syncloom.llm.token_counts import token_counts
from syncloom.llm.topk_search import exact_topk
from syncloom.llm.toxicity import held_out, toxicity, train

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):  # noqa: ANN201
    def add(fn):  # noqa: ANN001, ANN202
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).select("row.doc_id", "n_bytes", "n_tokens", "over_limit")


@register("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@register("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards(table(spark, sf_dir, "documents"))


@register("op7_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted")


@register(
    "op8_topk_search",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "row.doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@register("op4_ngram_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


@register("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


@register("op9_suffix_trees")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = tree_dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


@register(
    "op13_fill_middle",
    """
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
             sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
      FROM documents
    ), x AS (
      SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS g FROM d
    ), c AS (
      SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 100 THEN 'plain'
                  WHEN g[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
      FROM x
    ), p AS (
      SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(pre || mid || suf) AS restored_sha256
    FROM p
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle(table(spark, sf_dir, "documents"))
    hashes = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return done.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


@register(
    "op12_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages
    ), d AS (
      SELECT *, array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(sha1(h), 5 * g + 1, 5) AS BIGINT) >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
             row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) AS r, max(page_id) OVER (PARTITION BY h) AS top
      FROM p
    )
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN r > 1 THEN top END AS refers_to
    FROM d
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = archived(table(spark, sf_dir, "pages"))
    return done.select(F.col("number").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_number").alias("refers_to"))


@register(
    "op11_collocations",
    """
    WITH d AS (
      SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    ), p AS (
      SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d
    ), n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
    i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
    g AS (SELECT lang, w[i:i + k - 1] AS g, i + k - 1 <= len(w) AS whole FROM i, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
    f AS (SELECT lang, g, count(*) AS f FROM g WHERE whole GROUP BY lang, g HAVING count(*) >= 100),
    c AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
    s AS (
      SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, n.n,
             (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM c JOIN f l ON l.lang = c.lang AND l.g = c.g[1:c.k] JOIN f r ON r.lang = c.lang AND r.g = c.g[c.k + 1:] JOIN n ON n.lang = c.lang
    ), m AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS first FROM s),
    x AS (SELECT lang, unnest([g[1:len(g) - 1], g[2:]]) AS g, f FROM f WHERE len(g) > 2),
    y AS (SELECT lang, g, max(f) AS f FROM x GROUP BY lang, g),
    z AS (
      SELECT m.lang, array_to_string(m.g, ' ') AS phrase, m.a, m.l, m.r, m.n, m.score
      FROM m LEFT JOIN y ON y.lang = m.lang AND y.g = m.g WHERE m.first = 1 AND (y.f IS NULL OR 100 * y.f < 100 * m.a)
    ), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
           CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM o WHERE rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
