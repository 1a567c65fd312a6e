"""The thin contract queries of the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm import bpe, collocations, embedding_dups, hard_negatives, html_main, packing, pii, quality, resharding, simhash, substring, token_store, topk
from quillgraph.llm.common import documents


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and the bytes that they decode to, as digests."""
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_main.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces, packed into sequences of at most 2,048 tokens."""
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the keyed shards of token ids give back for every document."""
    return token_store.read_back(spark, token_store.written(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document, sizes nearly equal."""
    rows = resharding.balanced(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every text and whether the calibrated rules keep it."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality.judged(docs, labels)


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text that repeat an earlier passage, removed."""
    return substring.removals(documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: counts and spans, with those that the method adds."""
    return pii.digests(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every 50th vector."""
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op11_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, group and verdict of every vector at a cosine of 0.95."""
    return embedding_dups.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector, over labels of which a seventh are moved on."""
    vectors = hard_negatives.relabelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return hard_negatives.mined(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_main_text, op3_packing, op4_token_index, op5_resharding, op6_quality, op7_substring, op8_pii, op9_simhash, op10_top_k, op11_embedding_duplicates, op12_collocations, op13_hard_negatives)}
ORACLE_SQL: dict[str, str] = {
    "op7_substring": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), win AS (
            SELECT doc_id, s, array_to_string(w[s : s + 19], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
        ), again AS (
            SELECT doc_id, s FROM (
                SELECT doc_id, s, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) AS n FROM win
            ) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place FROM again
        ), one AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
            FROM one ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept k USING (doc_id)
    """,
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_embedding_duplicates": """
        WITH RECURSIVE v AS (
            SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
        ), u AS (
            SELECT i, vec_id, e FROM v
            WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), pair AS MATERIALIZED (
            SELECT a.i AS a, b.i AS b FROM u a JOIN u b ON a.i <> b.i AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT i, i AS j FROM v
            UNION
            SELECT reach.i, pair.b FROM reach JOIN pair ON pair.a = reach.j
        ), least AS (
            SELECT reach.i, min(v.vec_id) AS component_id FROM reach JOIN v ON v.i = reach.j GROUP BY reach.i
        ), n AS (
            SELECT a AS i, count(*) AS n_links FROM pair GROUP BY a
        )
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM v JOIN least USING (i) LEFT JOIN n USING (i)
    """,
    "op12_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w
            FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
        ), g AS (
            SELECT lang, w, unnest(range(1, 6)) AS m FROM p WHERE len(w) > 0
        ), o AS (
            SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM g WHERE len(w) >= m
        ), f AS (
            SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS c FROM o GROUP BY ALL
        ), total AS (
            SELECT lang, sum(c)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
        ), c AS (
            SELECT lang, m, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND c >= 100
        ), cut AS (
            SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1 :], ' ') AS rest
            FROM (SELECT *, unnest(range(1, m)) AS k FROM c)
        ), s AS (
            SELECT cut.lang, cut.phrase, a, x.c AS l, y.c AS r, n, k,
                   ((1000::HUGEINT * a * n) // (x.c::HUGEINT * y.c))::BIGINT AS score
            FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.first AND x.m = k
            JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rest AND y.m = cut.m - k
            JOIN total ON total.lang = cut.lang
        ), best AS (
            SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_part AS (
            SELECT lang, array_to_string(w[i : i + b - 1], ' ') AS phrase, max(a) AS most
            FROM (SELECT *, unnest(range(1, m - b + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS b FROM c)) GROUP BY ALL
        ), kept AS (
            SELECT best.* FROM best LEFT JOIN inner_part i ON i.lang = best.lang AND i.phrase = best.phrase
            WHERE i.most IS NULL OR i.most * 100 < 100 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        WHERE rank <= 2000
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
            FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.e) = len(a.e)
            WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        ) WHERE rank <= 10
    """,
}
