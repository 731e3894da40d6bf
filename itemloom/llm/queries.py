"""The queries of this folder; each applies its operator to the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_texts

    docs = tables(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_texts(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], ids=False, digests=True)


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, judged

    docs, labels = tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels")
    return judged(docs, fit(docs, labels), keep=["doc_id"])


@query(
    "op2_mixing",
    r"""
    WITH d AS (
      SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
      FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rk FROM s),
    w AS (
      SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap,
        (3 * source_size)::DOUBLE / (CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS fullness
      FROM r),
    l AS (
      SELECT *,
        ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER below, 0))::DOUBLE
          / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER below, 0))::DOUBLE AS lev
      FROM w WINDOW below AS (ORDER BY fullness, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (
      SELECT *, least(cap::DOUBLE, weight * (SELECT lev FROM l WHERE lev <= fullness ORDER BY fullness, lev LIMIT 1)) AS target FROM l),
    q AS (
      SELECT d.doc_id, d.size, t.rk, t.source_size, t.target,
        sum(d.size) OVER (PARTITION BY t.rk ORDER BY substr(d.k, 1, 16), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    c AS (
      SELECT doc_id, size, rk, (e * source_size + upto)::DOUBLE / target AS finish
      FROM q, (VALUES (0), (1), (2)) AS x(e) WHERE size > 0),
    m AS (
      SELECT doc_id, size, sum(size) OVER (ORDER BY finish, rk ROWS UNBOUNDED PRECEDING) <= (SELECT sum(size) FROM d) AS inside FROM c),
    n AS (SELECT doc_id, count(*) AS copies FROM m WHERE inside GROUP BY doc_id)
    SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(n.copies, 0))::BIGINT AS taken
    FROM q LEFT JOIN n USING (doc_id)
    """,
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import taken_words

    return taken_words(tables(spark, sf_dir, "documents"))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .privacy import found

    return found(tables(spark, sf_dir, "documents"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import grouped

    return grouped(tables(spark, sf_dir, "documents"))


@query(
    "op5_embedding_dedup",
    """
    WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
    p AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
    c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
    n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
    SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
    FROM embeddings v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
    """,
)
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import linked

    return linked(tables(spark, sf_dir, "embeddings"))


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import sharded

    found = sharded(tables(spark, sf_dir, "documents"), shards=16)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, held_out, scored

    docs, labels = tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels")
    found = scored(docs, fit(docs, labels), keep=["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted, "flagged")


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cotraining import fit, scored

    docs, labels = tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels")
    return scored(docs, fit(docs, labels), keep=["doc_id"])


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scanned

    found = scanned(tables(spark, sf_dir, "documents"), keep=["doc_id"])
    places = F.transform("notices", lambda n: F.concat_ws(":", n["license"], n["start"], n["end"]))
    return found.select("doc_id", "n_blocks", "n_licenses", F.concat_ws(",", "licenses").alias("licenses"), F.concat_ws(",", places).alias("notices"))


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.id AS a, b.id AS b, a.label = b.label AS alike, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
    p AS (SELECT a, b, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
    n AS (
      SELECT p.a, p.b, s.b AS c, p.score AS ps, s.score AS ns,
        row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT a AS anchor_id, b AS positive_id, r::INT AS rank, c AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= 10
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import mined

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mined(tables(spark, sf_dir, "embeddings"), label=moved, anchor=F.col("vec_id") % 100 == 0)


@query("op12_language_id")
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, held_out, identified

    docs = tables(spark, sf_dir, "documents")
    found = identified(docs, fit(docs), keep=["doc_id"])
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin")


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .dialogue import audited

    return audited(tables(spark, sf_dir, "conversations"))
