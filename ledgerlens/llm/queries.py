"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import (
    alignment, decontaminate, html_text, jaccard, language_model, licenses, merkle, mixing, repeats, sentence_pieces, token_files, topk,
    toxicity,
)
from ledgerlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

QUERIES["op9_source_mix"] = lambda spark, d: mixing.op9_source_mix(table(spark, "documents", d))

QUERIES["op1_topk_nra"] = lambda spark, d: topk.op1_topk(table(spark, "embeddings", d))
ORACLE["op1_topk_nra"] = """WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

QUERIES["op2_html_text"] = lambda spark, d: html_text.op2_html_text(table(spark, "pages", d))

QUERIES["op7_repeated_passages"] = lambda spark, d: repeats.op7_repeats(table(spark, "documents", d))

QUERIES["op10_ngram_jaccard"] = lambda spark, d: jaccard.op10_jaccard(table(spark, "documents", d))

QUERIES["op5_toxicity"] = lambda spark, d: toxicity.op5_toxicity(table(spark, "documents", d), table(spark, "labels", d))

QUERIES["op6_contamination"] = lambda spark, d: decontaminate.op6_contamination(
    table(spark, "documents", d), table(spark, "benchmark", d)
)

QUERIES["op8_lm_scores"] = lambda spark, d: language_model.op8_lm_scores(table(spark, "documents", d))

QUERIES["op3_token_files"] = lambda spark, d: token_files.op3_token_files(table(spark, "documents", d))

QUERIES["op11_sentence_pieces"] = lambda spark, d: sentence_pieces.op11_pieces(table(spark, "documents", d))

QUERIES["op12_alignment"] = lambda spark, d: alignment.op12_alignment(table(spark, "documents", d))

QUERIES["op13_merkle"] = lambda spark, d: merkle.op13_merkle(table(spark, "documents", d))
# crc32 bit by bit: a byte is mixed in, then eight steps follow, marked by -1.
ORACLE["op13_merkle"] = """WITH RECURSIVE c AS (SELECT *, CAST(doc_id AS VARCHAR) AS name FROM documents),
d AS (SELECT *, xor(4294967295, list_reduce(
        flatten(list_transform(string_split(name, ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, 3988292384 * (a % 2)) END, CAST(4294967295 AS BIGINT))) AS crc FROM c),
v AS (SELECT doc_id, lang, concat(
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(name) || ':' || name END,
        CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
        CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END) AS head,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS size,
    CASE WHEN n_chars IS NULL OR doc_id IS NULL OR crc % 7 <> 0 THEN NULL ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END AS more,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail FROM d),
h AS (SELECT doc_id, lang, sha256(head || size || tail) AS leaf, sha256(head || coalesce(more, size) || tail) AS given FROM v),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM h),
t AS (SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM p GROUP BY lang
    UNION ALL SELECT lang, level + 1,
        list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM t WHERE len(nodes) > 1),
s AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM t WHERE len(nodes) = 1),
u AS (SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM s
    UNION ALL SELECT level + 1,
        list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM u WHERE len(nodes) > 1),
b AS (SELECT p.doc_id, p.leaf, t.level, (p.place // power(2, t.level)::BIGINT) % 2 AS side, t.nodes[xor(p.place // power(2, t.level)::BIGINT, 1) + 1] AS other
        FROM p JOIN t ON p.lang IS NOT DISTINCT FROM t.lang AND len(t.nodes) > 1
    UNION ALL SELECT p.doc_id, p.leaf, 1000 + u.level, (s.place // power(2, u.level)::BIGINT) % 2, u.nodes[xor(s.place // power(2, u.level)::BIGINT, 1) + 1]
        FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang JOIN u ON len(u.nodes) > 1),
w AS (SELECT doc_id, leaf, list(side || coalesce(other, '') ORDER BY level) AS turns, string_agg(other, '' ORDER BY level) AS proof FROM b GROUP BY doc_id, leaf),
f AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root, sha256(coalesce(w.proof, '')) AS proof_sha256,
    list_reduce(coalesce(w.turns, []), lambda a, x: sha256(CASE WHEN x[1] = '1' THEN x[2:] || a ELSE a || x[2:] END), p.given) AS folded_root
    FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN w ON p.doc_id IS NOT DISTINCT FROM w.doc_id AND p.leaf = w.leaf)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f"""

QUERIES["op4_licenses"] = lambda spark, d: licenses.op4_licenses(table(spark, "documents", d))


def license_sql(templates: dict[str, str], share: float) -> str:
    """Exact containment of every template in every text."""
    quoted = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in templates.items())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = "list_filter(string_split_regex(translate(text, '{}', '{}'), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '')"
    words = words.format(upper, lower)
    cut = "list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))"
    return f"""WITH t AS (SELECT license, {words} AS w FROM (VALUES {quoted}) AS v(license, text)),
    tk AS (SELECT license, w, least({licenses.SHINGLE}, len(w)) AS k FROM t),
    ts AS (SELECT license, k, unnest({cut}) AS s FROM tk),
    n AS (SELECT license, count(*) AS n FROM ts GROUP BY 1),
    d AS (SELECT doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
    ds AS (SELECT doc_id, k, unnest({cut}) AS s FROM d, (SELECT DISTINCT k FROM tk) WHERE len(w) >= k)
    SELECT doc_id, license, count(*) AS n_shared, n AS n_shingles FROM ds JOIN ts USING (k, s) JOIN n USING (license)
    GROUP BY doc_id, license, n HAVING count(*) >= {share} * n"""


ORACLE["op4_licenses"] = license_sql(licenses.TEMPLATES, licenses.CONTAINMENT)
