"""One query per operator, applied with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import byte_bpe, collocations, context_tree, importance_resample, jaccard_join, kd_search, knn_quality, nn_descent, source_mix, stratified_shards, suffix_dedup, token_count, toxic_grammar
from strata.llm.common import ship

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(column: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


def op1_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(bucket("doc_id", 4) == 2, F.lit(False))
    space = knn_quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out, "quality")
    return knn_quality.score_quality(docs, space, held_out, threshold=0.7)


def op2_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(bucket("doc_id", 5) == 0, F.lit(False))
    model = toxic_grammar.fit(docs, table(spark, sf_dir, "labels"), ~held_out, "toxic")
    return toxic_grammar.score_toxicity(docs, model, held_out, threshold=0.5)


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op4_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_documents(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = stratified_shards.stratified_shards(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance_resample.importance_resample(docs, target, percent=10, least_words=20, seed=2024)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=4, least=30, most=2000)


def op13_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(bucket("doc_id", 7) == 2, F.lit(False))
    return context_tree.score_texts(docs, held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_knn_quality": op1_knn_quality,
    "op2_toxic_grammar": op2_toxic_grammar,
    "op3_token_count": op3_token_count,
    "op4_kd_search": op4_kd_search,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_source_mix": op7_source_mix,
    "op8_stratified_shards": op8_stratified_shards,
    "op9_nn_descent": op9_nn_descent,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_importance_resample": op11_importance_resample,
    "op12_collocations": op12_collocations,
    "op13_context_tree": op13_context_tree,
}

#: Queries that SQL can state; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_kd_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, md5('11:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS cap,
                   CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
            FROM d GROUP BY source
        ), l AS (
            SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                   / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM s
        ), t AS (
            SELECT source, source_size, least(CAST(cap AS DOUBLE), weight *
                   (SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap)) AS target
            FROM l
        ), r AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t
        ), c AS (
            SELECT d.doc_id, d.size, r.source_size, r.target, r.passes, r.target - r.passes * r.source_size AS rest,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY digest
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(size * (passes + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM c""",
    "op8_stratified_shards": """
        WITH crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bits
        ), d AS (
            SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest,
                   coalesce(strlen(text), 0) + 8 AS size,
                   list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                  lambda h: CAST('0x' || h AS BIGINT)) AS octets
            FROM documents
        ), e AS (
            SELECT d.* EXCLUDE octets, xor(4294967295, list_reduce([4294967295] || octets,
                       lambda c, b: xor(c >> 8, bits[xor(c & 255, b) + 1]))) AS crc
            FROM d, crc
        ), r AS (
            SELECT *, (row_number() OVER (PARTITION BY source ORDER BY digest, doc_id NULLS FIRST, crc, size) - 0.5::DOUBLE)
                      / count(*) OVER (PARTITION BY source) AS place
            FROM e
        ), p AS (
            SELECT *, row_number() OVER (ORDER BY place, source NULLS FIRST, digest, doc_id NULLS FIRST, crc, size) - 1 AS pos,
                   count(*) OVER () AS n
            FROM r
        )
        SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(pos * 24 // n AS INTEGER) AS shard,
               pos - (pos * 24 // n * n + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM p""",
    "op11_importance_resample": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bits
        ), d AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        ), g AS (
            SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
        ), dw AS (SELECT rid, unnest(words) AS word FROM d
        ), gw AS (SELECT unnest(words) AS word FROM g
        ), v AS (
            SELECT word, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS octets
            FROM (SELECT word FROM dw UNION SELECT word FROM gw)
        ), c AS (
            SELECT word, xor(4294967295, list_reduce([4294967295] || octets,
                       lambda c, b: xor(c >> 8, bits[xor(c & 255, b) + 1]))) % 10000 AS bucket
            FROM v, crc
        ), s AS (SELECT bucket, count(*) AS s FROM dw JOIN c USING (word) GROUP BY bucket
        ), t AS (SELECT bucket, count(*) AS t FROM gw JOIN c USING (word) GROUP BY bucket
        ), gain AS (
            SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
                       / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM gw) + 10000)::DOUBLE))) AS BIGINT) AS gain
            FROM s FULL JOIN t USING (bucket)
        ), w AS (
            SELECT rid, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
            FROM dw JOIN c USING (word) JOIN gain USING (bucket) GROUP BY rid
        ), r AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                       (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                       / 4294967296))) AS BIGINT) AS score
            FROM d LEFT JOIN w USING (rid)
        ), k AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) AS able
            FROM r
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
        FROM k""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
        ), spans AS (
            SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: words[i:i + m - 1])) AS gram
            FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(words) >= m
        ), f AS (
            SELECT lang, m, gram, array_to_string(gram, ' ') AS phrase, count(*) AS f
            FROM spans GROUP BY lang, m, gram HAVING count(*) >= 30
        ), cuts AS (
            SELECT c.lang, c.phrase, c.m, c.f AS a, k, p.f AS l, q.f AS r,
                   CAST(2000000 * c.f::HUGEINT // (p.f + q.f) AS BIGINT) AS score
            FROM f c, (SELECT unnest([1, 2, 3]) AS k), f p, f q
            WHERE c.m > k AND p.lang = c.lang AND p.phrase = array_to_string(c.gram[1:k], ' ')
              AND q.lang = c.lang AND q.phrase = array_to_string(c.gram[k + 1:c.m], ' ')
        ), best AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), covered AS (
            SELECT DISTINCT s.lang, s.phrase
            FROM f s JOIN f c ON s.lang = c.lang AND s.m >= 2 AND c.m > s.m AND 100 * c.f >= 80 * s.f
             AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')
        ), ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
            FROM best ANTI JOIN covered USING (lang, phrase)
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
