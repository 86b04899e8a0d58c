"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_trie, embedding_dedup, exact_dedup, language_id, licenses, ngram_join, packing, pieces, pii, suffix_dedup, toxicity, whitening
from .common import read, small_batches

VOCABULARY = "byte_bpe_50k.json"
VOCABULARY_RANKS = "byte_bpe_50k.tiktoken"
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = language_id.train(docs.where(~held).where(F.col("lang").isNotNull()))
    scored = language_id.identify(docs, model)
    return scored.withColumn("held_out", held)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.train(docs, read(spark, sf_dir, "labels"), "toxic"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return packing.piece_digests(packing.pack(read(spark, sf_dir, "documents"), path(VOCABULARY), path(VOCABULARY_RANKS)))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.detect(docs, pii.train(docs))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_RANKS))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_packing": op5_packing,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_license_scan": op7_license_scan,
    "op8_pii": op8_pii,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_embedding_whitening": op13_embedding_whitening,
}

QUERIES = {name: small_batches(query) for name, query in QUERIES.items()}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Components of the links p(a, b): every node's least reachable one.
_REACH = """r(a, b) AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
        c AS (SELECT a AS id, least(a, min(b)) AS component_id FROM r GROUP BY a)"""

ORACLE_SQL: dict[str, str] = {
    "op2_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
        p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
        {_REACH}
        SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
        FROM embeddings LEFT JOIN (SELECT a AS id, count(*) AS n FROM p GROUP BY a) q ON q.id = vec_id LEFT JOIN c ON c.id = vec_id""",
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS folded FROM documents),
        g AS (SELECT folded, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY folded)
        SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(folded) AS text_sha256
        FROM d JOIN g USING (folded)""",
    "op6_ngram_jaccard_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
        g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        o AS (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS n FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        p AS (SELECT a, b FROM o WHERE 100 * n >= 75 * (na + nb - n)),
        {_REACH}
        SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM s LEFT JOIN c ON c.id = doc_id""",
    "op10_suffix_array_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        k AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS p FROM d)),
        m AS (SELECT k, min(doc_id) AS m FROM k GROUP BY k HAVING min(doc_id) < max(doc_id)),
        c AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM k JOIN m USING (k) WHERE m < doc_id),
        i AS (SELECT doc_id, p, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS i FROM c),
        r AS (SELECT doc_id, i, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, i),
        e AS (SELECT doc_id, a, b FROM r UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 FROM d),
        f AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS since FROM e),
        x AS (SELECT doc_id, string_agg(substr(h, (2 * since + 1)::BIGINT, (2 * (a - since))::BIGINT), '' ORDER BY a, b) AS kept, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) - 1 AS n_spans, any_value(len(h) // 2) AS n_bytes FROM f JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM x""",
    # CRC-32 bit by bit: each digit, then eight shifts
    "op11_conversation_prefix_trie": """
        WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
              row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
              FROM conversations WHERE conv_id IS NOT NULL),
        h AS (SELECT conv_id, conv_id - conv_id % 100 AS base, (4294967295 - list_reduce([4294967295] || flatten(list_transform(range(1, len(conv_id::VARCHAR) + 1),
              lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT] || [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])),
              lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 6 AS h FROM (SELECT DISTINCT conv_id FROM o)),
        t AS (SELECT h.conv_id, o.pos, role, text FROM h JOIN o ON o.conv_id = h.base AND o.pos <= h.h UNION ALL SELECT h.conv_id, o.pos, role, text FROM h JOIN o ON o.conv_id = h.conv_id AND o.pos > h.h),
        k AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(strlen(role)::VARCHAR || ':' || role || text), '') OVER w AS key, length(text) AS points
              FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
              UNION ALL SELECT conv_id, 0, '', 0 FROM h),
        n AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points FROM k GROUP BY depth, key),
        c AS (SELECT left(key, (32 * (depth - 1))::BIGINT) AS key, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
        m AS (SELECT n.*, coalesce(c.n, 0) AS n_children, p.conv_id AS parent_conv_id FROM n LEFT JOIN c ON c.key = n.key LEFT JOIN n p ON p.key = left(n.key, (32 * (n.depth - 1))::BIGINT) AND n.depth > 0),
        s AS (SELECT key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * points)::BIGINT AS saved_tokens
              FROM (SELECT left(key, 32 * unnest(range(0, depth + 1))) AS key, n_children, n_convs, points FROM m) GROUP BY key),
        e AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, arg_max(key, depth) AS key FROM k GROUP BY conv_id) GROUP BY key)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
        FROM m JOIN s USING (key) LEFT JOIN e USING (key)""",
}
