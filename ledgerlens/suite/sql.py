"""Building blocks of the oracle SQL."""

from __future__ import annotations

import re

TXN = """
suppliers AS (SELECT count(*) AS n FROM supplier),
returned AS (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'
  GROUP BY l_orderkey HAVING sum(l_quantity) >= 100
),
txn AS (
  SELECT o.o_orderkey AS txn_id,
         CAST(date_diff('day', DATE '1992-01-01', CAST(o.o_orderdate AS DATE)) AS INTEGER) AS step,
         o.o_orderpriority AS type,
         o.o_totalprice AS amount,
         'C' || o.o_custkey AS nameOrig,
         CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE c.c_acctbal END AS oldbalanceOrg,
         greatest(CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE c.c_acctbal END - o.o_totalprice,
                  CAST(0 AS DOUBLE)) AS newbalanceOrig,
         'M' || s.s_suppkey AS nameDest,
         s.s_acctbal AS oldbalanceDest,
         s.s_acctbal + o.o_totalprice AS newbalanceDest,
         CASE WHEN o.o_orderstatus = 'F' AND r.l_orderkey IS NOT NULL THEN 1 ELSE 0 END AS is_fraud,
         CASE WHEN o.o_totalprice > 450000 THEN 1 ELSE 0 END AS is_flagged_fraud
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN suppliers k ON true
  JOIN supplier s ON s.s_suppkey = o.o_orderkey % k.n
  LEFT JOIN returned r ON r.l_orderkey = o.o_orderkey
)"""

STATES = """
state_names AS (
  SELECT list_sort(list(name)) AS names, count(*) AS n
  FROM (SELECT n_name AS name FROM nation UNION ALL SELECT 'OFFSHORE')
),
txn_state AS (
  SELECT t.*, names[CAST(('0x' || md5(t.nameOrig))::UHUGEINT % n::UHUGEINT AS INTEGER) + 1] AS state
  FROM txn t, state_names
)"""

INFRA = """
infra_clean AS (
  SELECT n_name AS state,
         TRY_CAST(CASE WHEN s_suppkey % 17 = 0 THEN 'n/a' ELSE CAST(10 + s_suppkey % 90 AS VARCHAR) END AS INTEGER)
           AS pos_devices,
         s_acctbal AS gov_amount
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 23 <> 0
),
infra AS (
  SELECT state, CAST(sum(pos_devices) AS BIGINT) AS total_pos_devices, sum(gov_amount) AS total_gov_amount_lakh
  FROM infra_clean GROUP BY state
)"""

ENRICHED = """
enriched AS (
  SELECT t.*, i.total_pos_devices, i.total_gov_amount_lakh
  FROM txn_state t LEFT JOIN infra i ON i.state = t.state
)"""

FEATURED = """
filled AS (
  SELECT * EXCLUDE (total_pos_devices, total_gov_amount_lakh),
         coalesce(total_pos_devices, 0) AS total_pos_devices,
         coalesce(total_gov_amount_lakh, 0) AS total_gov_amount_lakh
  FROM enriched
),
featured AS (
  SELECT *,
         CASE WHEN total_gov_amount_lakh > 0 THEN amount / total_gov_amount_lakh ELSE CAST(0 AS DOUBLE) END
           AS amount_to_gov_ratio,
         CASE WHEN total_pos_devices < 1000 THEN 1 ELSE 0 END AS pos_density_flag,
         CASE WHEN total_gov_amount_lakh > 0 THEN ln(1 + total_gov_amount_lakh) ELSE CAST(0 AS DOUBLE) END
           AS log_gov_amount,
         CASE WHEN total_pos_devices > 0 THEN ln(1 + total_pos_devices) ELSE CAST(0 AS DOUBLE) END
           AS log_pos_devices,
         oldbalanceOrg - newbalanceOrig AS balance_diff_orig,
         newbalanceDest - oldbalanceDest AS balance_diff_dest,
         CASE WHEN oldbalanceOrg = 0 THEN 1 ELSE 0 END AS orig_balance_zero_flag
  FROM filled
)"""

SCORED = """
scored AS (
  SELECT *, CASE WHEN fraud_probability >= 0.5 THEN 1 ELSE 0 END AS fraud_flag
  FROM (SELECT *, amount / (SELECT max(o_totalprice) FROM orders) AS fraud_probability FROM {source})
)"""

# Java's \s written out.
SPACES = "' \\t\\n\\x0B\\f\\r'"

CORPUS = """
bronze AS (
  SELECT ' doc-' || doc_id || ' ' AS document, source AS filename, lang AS regulation_area,
         source AS applicable_to, '2024-' || lpad(CAST(doc_id % 14 AS VARCHAR), 2, '0') || '-15' AS issued_on,
         'topic-' || (doc_id % 5) AS key_topics, text AS chunks_text, doc_id % 4 = 0 AS is_table,
         'What does  document ' || doc_id || ' say?' AS question, text AS answer,
         CAST(NULL AS VARCHAR) AS rephrased_question, CAST(NULL AS VARCHAR) AS rephrased_answer,
         CAST(NULL AS VARCHAR) AS evaluation_criteria, CAST(NULL AS VARCHAR) AS category,
         CAST(NULL AS VARCHAR) AS estimated_difficulty, 'train' AS split, 'train' AS source_table
  FROM documents
  UNION ALL
  SELECT ' doc-' || doc_id || ' ', source, lang, source, '2025-01-31',
         'topic-' || (doc_id % 5), text, doc_id % 4 = 0,
         'What does  document ' || doc_id || ' say?', text,
         NULL, NULL, NULL, NULL, NULL, 'train', 'train'
  FROM documents WHERE doc_id % 10 = 0
  UNION ALL
  SELECT 'item-' || item_id, NULL, NULL, NULL, '2024-06-01', NULL, NULL, NULL,
         'Who is meant by: ' || text, text, 'In other words: ' || text, text, 'states the same facts',
         CAST(item_id % 3 AS VARCHAR), CAST(item_id % 2 AS VARCHAR), 'eval', 'eval'
  FROM benchmark
),
collapsed AS (
  SELECT * REPLACE (
           trim(document) AS document, trim(filename) AS filename,
           trim(regulation_area) AS regulation_area, trim(applicable_to) AS applicable_to,
           TRY_CAST(issued_on AS DATE) AS issued_on,
           regexp_replace(chunks_text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS chunks_text,
           regexp_replace(question, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS question,
           regexp_replace(answer, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS answer)
  FROM bronze
),
silver AS (
  SELECT *, sha256(split || '||' || coalesce(document, '') || '||' || coalesce(filename, '') || '||' ||
                   coalesce(question, '') || '||' || coalesce(answer, '')) AS qa_id
  FROM collapsed
)"""

GOLD = """
gold_chunks AS (
  SELECT * EXCLUDE (copy),
         sha256(document || '||' || filename || '||' || chunks_text) AS chunk_id,
         'Document: ' || document || chr(10) || 'Filename: ' || filename || chr(10) ||
         'Regulation area: ' || coalesce(regulation_area, '') || chr(10) ||
         'Applicable to: ' || coalesce(applicable_to, '') || chr(10) ||
         'Issued on: ' || coalesce(CAST(issued_on AS VARCHAR), '') || chr(10) ||
         'Chunk: ' || chunks_text AS retrieval_text
  FROM (
    SELECT document, filename, chunks_text, issued_on, regulation_area, applicable_to, key_topics, is_table,
           row_number() OVER (
             PARTITION BY document, filename, chunks_text
             ORDER BY issued_on NULLS FIRST, regulation_area NULLS FIRST, applicable_to NULLS FIRST,
                      key_topics NULLS FIRST, is_table NULLS FIRST) AS copy
    FROM silver
    WHERE document IS NOT NULL AND filename IS NOT NULL AND chunks_text IS NOT NULL
  ) WHERE copy = 1
)"""

HITS = """
parts AS (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
  FROM embeddings, (SELECT unnest(range(1, (SELECT max(len(embedding)) FROM embeddings) + 1)) AS i)
  GROUP BY label, i
),
centroids AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM parts GROUP BY label),
pairs AS (
  SELECT query_id, vec_id, list_cosine_similarity(q, CAST(embedding AS DOUBLE[])) AS score
  FROM centroids, embeddings
),
hits AS (
  SELECT * FROM (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM pairs
  ) WHERE rank <= 3
)"""

CONTEXT = """
chunk_hits AS (
  SELECT h.*, g.*
  FROM hits h JOIN gold_chunks g ON CAST(split_part(g.document, '-', 2) AS BIGINT) = h.vec_id
),
context AS (
  SELECT query_id,
         string_agg('[Chunk ID: ' || chunk_id || ']' || chr(10) || 'Document: ' || document || chr(10) ||
                    'Issued on: ' || coalesce(CAST(issued_on AS VARCHAR), 'None') || chr(10) ||
                    'Regulation area: ' || coalesce(regulation_area, 'None') || chr(10) ||
                    'Applicable to: ' || coalesce(applicable_to, 'None') || chr(10) ||
                    'Text: ' || chunks_text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM chunk_hits GROUP BY query_id
)"""

REPLIES = """
generated AS (
  SELECT a.conv_id, a.turn, a.text AS question, b.text AS reply
  FROM conversations a
  JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant'
)"""

VERDICTS = """
verdicts AS (
  SELECT key, document, answer_id, key % 11 AS accuracy, (key * 3) % 11 AS completeness,
         (key * 5) % 12 AS clarity, length(reply) % 11 AS relevance,
         key % 7 <> 6 AND (key * 5) % 12 <= 10 AS valid
  FROM (SELECT conv_id * 5 + turn AS key, 'item-' || conv_id AS document, turn AS answer_id, reply FROM generated)
)"""

EVAL = """
results AS (
  SELECT s.qa_id, g.turn AS answer_id, s.question, s.category, s.estimated_difficulty AS difficulty,
         s.answer AS expected_answer, g.reply AS generated_answer, v.evaluation
  FROM silver s
  LEFT JOIN generated g ON 'item-' || g.conv_id = s.document
  LEFT JOIN (
    SELECT document, answer_id,
           CASE WHEN key % 7 = 6 THEN 'The answer is good.'
                WHEN key % 3 = 0 THEN '```json' || chr(10) || body || chr(10) || '```'
                ELSE body END AS evaluation
    FROM (SELECT *, '{"accuracy": ' || accuracy || ', "completeness": ' || completeness || ', "clarity": ' || clarity ||
                    ', "relevance": ' || relevance || ', "overall_score": 5, "reasoning": "answer ' || key || '"}' AS body
          FROM verdicts)
  ) v ON v.document = s.document AND v.answer_id = g.turn
  WHERE s.split = 'eval'
)"""


def query(select: str, *parts: str) -> str:
    """A statement over named parts."""
    return f"WITH {','.join(parts)}\n{select}" if parts else select


def scored(source: str = "txn") -> str:
    return SCORED.replace("{source}", source)


def share(key: str, seed: int) -> str:
    """The hash share of a key: its first eight md5 digits over 2**32."""
    return f"(('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def word(key: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT"


def text(template: str, **columns: str) -> str:
    """A template as a concatenation of literals and columns."""
    marks = re.compile("\\{(" + "|".join(columns) + ")\\}")
    out = []
    for i, part in enumerate(marks.split(template)):
        if i % 2:
            out.append(f"coalesce({columns[part]}, 'None')")
        elif part:
            out.append("'" + part.replace("'", "''") + "'")
    return " || ".join(out)
