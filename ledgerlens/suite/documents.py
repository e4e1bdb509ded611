"""Queries over the document layers, retrieval and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import prompts
from ledgerlens.operators import documents, evaluation, loans, retrieval, term_index, vector_index
from ledgerlens.operators.quality import first_rows
from ledgerlens.plans import answers
from ledgerlens.plans.documents import build_layers
from ledgerlens.session import written
from ledgerlens.sources import roles
from ledgerlens.sources.tables import layer_counts, spread
from ledgerlens.suite import sql
from ledgerlens.suite.common import Query, rounded

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

LANGUAGES = ["tamil", "Hindi", "ENGLISH", "telugu", "kannada", "malayalam", "bengali", "marathi", "gujarati", "french"]


def _bronze(spark, d):
    return documents.bronze(roles.corpus_train(spark, d), roles.corpus_eval(spark, d))


def _silver(spark, d):
    return documents.silver(_bronze(spark, d))


def _gold(spark, d):
    return documents.gold_chunks(_silver(spark, d))


def _gold_eval(spark, d):
    return documents.gold_eval(_silver(spark, d))


QUERIES["bronze_union"] = lambda spark, d: _bronze(spark, d).drop("ingested_at")
ORACLE["bronze_union"] = sql.query("SELECT * FROM bronze", sql.CORPUS)

QUERIES["silver_docs"] = lambda spark, d: _silver(spark, d).drop("ingested_at")
ORACLE["silver_docs"] = sql.query("SELECT * FROM silver", sql.CORPUS)

QUERIES["gold_chunks"] = _gold
ORACLE["gold_chunks"] = sql.query("SELECT * FROM gold_chunks", sql.CORPUS, sql.GOLD)

QUERIES["gold_eval"] = _gold_eval
ORACLE["gold_eval"] = sql.query(
    f"SELECT {', '.join(documents.EVAL_COLUMNS)} FROM silver WHERE split = 'eval'", sql.CORPUS
)

QUERIES["eval_sample"] = lambda spark, d: first_rows(_gold_eval(spark, d), 3, "qa_id")
ORACLE["eval_sample"] = ORACLE["gold_eval"] + " ORDER BY qa_id LIMIT 3"


def _layer_counts(spark, d):
    layers = build_layers(roles.corpus_train(spark, d), roles.corpus_eval(spark, d))
    return layer_counts(
        bronze=layers.bronze, silver=layers.silver, gold_chunks=layers.gold_chunks, gold_eval=layers.gold_eval
    )


QUERIES["layer_counts"] = _layer_counts
ORACLE["layer_counts"] = sql.query(
    """SELECT 'bronze' AS layer, count(*) AS n_rows FROM bronze
    UNION ALL SELECT 'silver', count(*) FROM silver
    UNION ALL SELECT 'gold_chunks', count(*) FROM gold_chunks
    UNION ALL SELECT 'gold_eval', count(*) FROM silver WHERE split = 'eval'""",
    sql.CORPUS, sql.GOLD,
)

# Retrieval.


def _hits(spark, d) -> DataFrame:
    return retrieval.similar(roles.centroids(spark, d), roles.vectors(spark, d))


QUERIES["similar_topk"] = lambda spark, d: rounded(_hits(spark, d))
ORACLE["similar_topk"] = sql.query("SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits", sql.HITS)

QUERIES["similar_topk_blocks"] = lambda spark, d: rounded(
    retrieval.similar(roles.centroids(spark, d), roles.vectors(spark, d), slice_rows=3)
)
ORACLE["similar_topk_blocks"] = ORACLE["similar_topk"]

QUERIES["similar_lsh"] = lambda spark, d: retrieval.similar_lsh(roles.centroids(spark, d), roles.vectors(spark, d))


def _contents(spark, d):
    """Vectors with a content id."""
    return roles.vectors(spark, d).select(F.col("vec_id").alias("id"), F.md5(F.to_json("embedding")).alias("content"), "embedding")


def _index_recall(spark, d):
    """Recall of the stored index against exact search, for every hundredth vector, and the share of codes read."""
    index = vector_index.build_index(_contents(spark, d))
    asked = roles.vectors(spark, d).filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    probes = vector_index.choose_probes(index, spark)
    found = written(vector_index.search_index(index, asked, 10, probes), "found")
    exact = retrieval.similar(asked, roles.vectors(spark, d), 10).withColumnRenamed("vec_id", "id")
    return vector_index.recall(found, exact).join(vector_index.scanned_share(index, asked, probes), "query_id")


QUERIES["vector_index_recall"] = _index_recall
QUERIES["vector_index_enough"] = lambda spark, d: _index_recall(spark, d).agg(
    F.count("*").alias("n_queries"), (F.avg("recall") >= 0.9).alias("enough")
)
ORACLE["vector_index_enough"] = "SELECT count(*) AS n_queries, true AS enough FROM embeddings WHERE vec_id % 100 = 0"


def _index_sync(spark, d):
    """Three syncs: rows come, change and go. Which changes each made, and whether the index equals one built anew."""
    whole = _contents(spark, d)
    turned = whole.withColumn("embedding", F.when(F.expr("id % 7 = 0"), F.reverse("embedding")).otherwise(F.col("embedding")))
    turned = turned.withColumn("content", F.md5(F.to_json("embedding")))
    index = vector_index.build_index(written(whole.filter("id % 5 <> 0"), "first"))
    made = []
    for i, state in enumerate((whole, turned, turned.filter("id % 3 <> 0"))):
        index, found = vector_index.sync_index(index, state)
        made.append(found.groupBy("change").agg(F.count("*").alias("n")).withColumn("sync", F.lit(i + 1)))
    anew = vector_index.build_index(turned.filter("id % 3 <> 0"), codec=index.codec).rows(spark)
    ours = index.rows(spark)
    differs = ours.exceptAll(anew).agg(F.count("*")).scalar() + anew.exceptAll(ours).agg(F.count("*")).scalar()
    return made[0].unionByName(made[1]).unionByName(made[2]).select("sync", "change", "n", (differs == 0).alias("as_built_anew"))


QUERIES["index_sync"] = _index_sync
ORACLE["index_sync"] = """SELECT CAST(sync AS INTEGER) AS sync, change, count(*) AS n, true AS as_built_anew FROM (
    SELECT 1 AS sync, 'new' AS change FROM embeddings WHERE vec_id % 5 = 0
    UNION ALL SELECT 2, 'changed' FROM embeddings WHERE vec_id % 7 = 0 AND embedding <> list_reverse(embedding)
    UNION ALL SELECT 3, 'gone' FROM embeddings WHERE vec_id % 3 = 0) GROUP BY ALL"""


def _term_search(spark, d):
    """Benchmark items as questions to all documents."""
    index = term_index.build_terms(roles.load(spark, "documents", d), "doc_id", "text")
    questions = roles.load(spark, "benchmark", d).withColumnRenamed("item_id", "query_id")
    return term_index.search_terms(index, questions, "text")


QUERIES["term_search"] = lambda spark, d: _term_search(spark, d).hits.select("query_id", "rank", F.col("id").alias("doc_id"), "score")
ORACLE["term_search"] = """WITH words AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT doc_id, term, count(*) AS n FROM words WHERE term <> '' GROUP BY ALL),
r AS (SELECT term, CAST(round(1000 * ln(1 + (SELECT count(DISTINCT doc_id) FROM p) / count(*)::DOUBLE)) AS BIGINT) AS rarity FROM p GROUP BY term),
asked AS (SELECT item_id AS query_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM benchmark),
q AS (SELECT query_id, term, count(*) AS n FROM asked WHERE term <> '' GROUP BY ALL),
s AS (SELECT query_id, doc_id, CAST(sum(q.n * p.n * rarity) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN r USING (term) GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM
(SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10""".replace("\\\\", "\\")

QUERIES["term_search_effort"] = lambda spark, d: _term_search(spark, d).effort


def _indexed(spark, d):
    """The stored chunks, the term weights fitted on them, and the benchmark passages as questions."""
    chunks = spread(written(_gold(spark, d), "chunks"), "chunk_id")
    model = retrieval.embedder().fit(chunks.select("retrieval_text"))
    questions = roles.load(spark, "benchmark", d).select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )
    return chunks, model, questions


def _lexical(spark, d):
    chunks, model, questions = _indexed(spark, d)
    return answers.retrieve(questions, chunks, model).select("query_id", "rank", "score", *retrieval.HIT_COLUMNS)


def _question_prompts(spark, d):
    chunks, model, questions = _indexed(spark, d)
    return _chat(
        answers.question_prompts(questions, chunks, model), "query_id", "question", "num_chunks_retrieved", "context"
    )


QUERIES["question_prompts"] = _question_prompts
QUERIES["lexical_search"] = _lexical


def _context(spark, d, compact=False):
    chunks = _gold(spark, d).withColumn("vec_id", F.substring_index("document", "-", -1).cast("bigint"))
    return retrieval.context_text(retrieval.attach_hits(_hits(spark, d), chunks, "vec_id"), compact)


_TO_CONTEXT = (sql.HITS, sql.CORPUS, sql.GOLD, sql.CONTEXT)

QUERIES["context_text"] = lambda spark, d: _context(spark, d)
ORACLE["context_text"] = sql.query("SELECT query_id, context FROM context", *_TO_CONTEXT)


def _questions(spark, d, compact=False):
    return _context(spark, d, compact).withColumn(
        "question", F.concat(F.lit("What is said about subject "), "query_id", F.lit("?"))
    )


def _chat(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        F.col("messages")[0]["content"].alias("system_content"),
        F.col("messages")[1]["content"].alias("user_content"),
    )


_QUESTION = "'What is said about subject ' || query_id || '?'"

QUERIES["answer_prompts"] = lambda spark, d: _chat(retrieval.answer_prompt(_questions(spark, d)), "query_id")
ORACLE["answer_prompts"] = sql.query(
    f"""SELECT query_id, {sql.text(prompts.HINDI_SYSTEM)} AS system_content,
    {sql.text(prompts.HINDI_USER, question=_QUESTION, context="context")} AS user_content FROM context""",
    *_TO_CONTEXT,
)

QUERIES["answer_prompts_simple"] = lambda spark, d: _chat(
    retrieval.answer_prompt(_questions(spark, d), "simple"), "query_id"
)
ORACLE["answer_prompts_simple"] = sql.query(
    f"""SELECT query_id, {sql.text(prompts.SIMPLE_SYSTEM)} AS system_content,
    {sql.text(prompts.SIMPLE_USER, question=_QUESTION, context="context")} AS user_content FROM context""",
    *_TO_CONTEXT,
)

QUERIES["answer_prompts_plain"] = lambda spark, d: retrieval.answer_prompt(_questions(spark, d), "plain").select(
    "query_id", "prompt"
)
ORACLE["answer_prompts_plain"] = sql.query(
    f"SELECT query_id, {sql.text(prompts.PLAIN_PROMPT, question=_QUESTION, context='context')} AS prompt FROM context",
    *_TO_CONTEXT,
)

QUERIES["answer_prompts_compact"] = lambda spark, d: _chat(
    retrieval.answer_prompt(_questions(spark, d, compact=True), "compact"), "query_id"
)
ORACLE["answer_prompts_compact"] = sql.query(
    f"""SELECT query_id, {sql.text(prompts.COMPACT_SYSTEM)} AS system_content,
    {sql.text(prompts.COMPACT_USER, question=_QUESTION, context="context")} AS user_content
    FROM (SELECT query_id, string_agg('Document: ' || document || chr(10) || 'Issued on: ' ||
            coalesce(CAST(issued_on AS VARCHAR), 'None') || chr(10) || 'Text: ' || chunks_text,
            chr(10) || chr(10) ORDER BY rank) AS context
          FROM chunk_hits GROUP BY query_id)""",
    *_TO_CONTEXT,
)


def _hindi_answers(spark, d):
    names = F.array(*[F.lit(x) for x in LANGUAGES])
    return roles.generated_answers(spark, d).select(
        "conv_id",
        "turn",
        F.col("reply").alias("hindi_answer"),
        F.element_at(names, (F.col("conv_id") % len(LANGUAGES)).cast("int") + 1).alias("target_language"),
    )


_TARGETS = ", ".join(f"'{x}'" for x in LANGUAGES)
_TRANSLATED = f"""asked AS (
  SELECT *, ([{_TARGETS}])[CAST(conv_id % {len(LANGUAGES)} AS INTEGER) + 1] AS target_language FROM generated
),
named AS (
  SELECT *, CASE lower(target_language) WHEN 'tamil' THEN 'Tamil' WHEN 'english' THEN 'English' WHEN 'telugu' THEN 'Telugu'
    WHEN 'kannada' THEN 'Kannada' WHEN 'malayalam' THEN 'Malayalam' WHEN 'bengali' THEN 'Bengali'
    WHEN 'marathi' THEN 'Marathi' WHEN 'gujarati' THEN 'Gujarati' ELSE 'English' END AS language
  FROM asked WHERE lower(target_language) <> 'hindi'
)"""

QUERIES["translation_prompts"] = lambda spark, d: _chat(
    retrieval.translation_prompts(_hindi_answers(spark, d)), "conv_id", "turn", "language"
)
ORACLE["translation_prompts"] = sql.query(
    f"""SELECT conv_id, turn, language, {sql.text(prompts.TRANSLATE_SYSTEM, language="language")} AS system_content,
    {sql.text(prompts.TRANSLATE_USER, language="language", text="reply")} AS user_content FROM named""",
    sql.REPLIES, _TRANSLATED,
)



def _final_answers(spark, d):
    """Answers in the language asked for; the question stands in for an outside translator's reply."""
    key = F.concat_ws("-", "conv_id", "turn").alias("query_id")
    given = _hindi_answers(spark, d).select(key, "hindi_answer", "target_language")
    replies = roles.generated_answers(spark, d).select(key, F.col("question").alias("translated_answer"))
    return retrieval.final_answers(given, replies)


QUERIES["final_answers"] = _final_answers
ORACLE["final_answers"] = sql.query(
    """SELECT conv_id || '-' || turn AS query_id, reply AS hindi_answer, target_language,
    CASE WHEN lower(target_language) = 'hindi' THEN reply ELSE question END AS translated_answer FROM asked""",
    sql.REPLIES, _TRANSLATED,
)

# Evaluation.


def _results(spark, d):
    questions = _gold_eval(spark, d)
    ids = questions.select("qa_id", "document")
    replies = roles.generated_answers(spark, d).select(
        F.concat(F.lit("item-"), "conv_id").alias("document"),
        F.col("turn").alias("answer_id"),
        F.col("reply").alias("generated_answer"),
    )
    return evaluation.eval_results(
        questions, ids.join(replies, "document"), ids.join(roles.judge_replies(spark, d), "document")
    )


_TO_RESULTS = (sql.CORPUS, sql.REPLIES, sql.VERDICTS, sql.EVAL)

QUERIES["eval_results"] = _results
ORACLE["eval_results"] = sql.query("SELECT * FROM results", *_TO_RESULTS)

QUERIES["judge_prompts"] = lambda spark, d: _chat(evaluation.judge_prompts(_results(spark, d)), "qa_id", "answer_id")
ORACLE["judge_prompts"] = sql.query(
    f"""SELECT qa_id, answer_id, {sql.text(prompts.JUDGE_SYSTEM)} AS system_content,
    {sql.text(prompts.JUDGE_USER, question="question", expected="expected_answer", generated="generated_answer")}
      AS user_content FROM results""",
    *_TO_RESULTS,
)

QUERIES["judge_parse"] = lambda spark, d: evaluation.parse_judgement(roles.judge_replies(spark, d)).drop("evaluation")
ORACLE["judge_parse"] = sql.query(
    """SELECT document, answer_id, CASE WHEN valid THEN accuracy::DOUBLE END AS accuracy,
    CASE WHEN valid THEN completeness::DOUBLE END AS completeness, CASE WHEN valid THEN clarity::DOUBLE END AS clarity,
    CASE WHEN valid THEN relevance::DOUBLE END AS relevance,
    CASE WHEN valid THEN (accuracy + completeness + clarity + relevance) / 4.0::DOUBLE END AS overall_score,
    CASE WHEN valid THEN 'answer ' || key END AS reasoning, valid FROM verdicts""",
    sql.REPLIES, sql.VERDICTS,
)

QUERIES["judge_summary"] = lambda spark, d: rounded(
    evaluation.judge_summary(evaluation.parse_judgement(roles.judge_replies(spark, d)))
)
ORACLE["judge_summary"] = sql.query(
    """SELECT count(*) AS replies, count(*) FILTER (WHERE valid) AS valid,
    round(avg(accuracy) FILTER (WHERE valid), 6) AS avg_accuracy,
    round(avg(completeness) FILTER (WHERE valid), 6) AS avg_completeness,
    round(avg(clarity) FILTER (WHERE valid), 6) AS avg_clarity,
    round(avg(relevance) FILTER (WHERE valid), 6) AS avg_relevance,
    round(avg((accuracy + completeness + clarity + relevance) / 4.0::DOUBLE) FILTER (WHERE valid), 6) AS avg_overall_score
    FROM verdicts""",
    sql.REPLIES, sql.VERDICTS,
)

# Loan applications.

QUERIES["loan_features"] = lambda spark, d: rounded(
    loans.loan_features(roles.loan_app(spark, d)).select("loan_id", *loans.LOAN_FEATURES, "Loan_Status")
)
ORACLE["loan_features"] = """
WITH app AS (
  SELECT o_orderkey AS loan_id, CAST(o_orderkey % 2 AS DOUBLE) AS Gender, CAST(o_orderkey // 2 % 2 AS DOUBLE) AS Married,
         CAST(o_orderkey // 4 % 4 AS DOUBLE) AS Dependents, CAST(o_orderkey // 16 % 2 AS INTEGER) AS Education,
         CAST(o_orderkey // 32 % 2 AS DOUBLE) AS Self_Employed,
         greatest(c_acctbal, CAST(150 AS DOUBLE)) AS ApplicantIncome,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE)
              ELSE greatest(0.4::DOUBLE * c_acctbal, CAST(0 AS DOUBLE)) END AS CoapplicantIncome,
         o_totalprice / 1000 AS LoanAmount, CAST(36 + 12 * (o_orderkey % 38) AS DOUBLE) AS Loan_Amount_Term,
         CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS Credit_History,
         CAST(o_orderkey % 3 AS INTEGER) AS Property_Area,
         CASE WHEN o_orderstatus <> 'F' AND o_totalprice < 420000 THEN 1 ELSE 0 END AS Loan_Status
  FROM orders JOIN customer ON c_custkey = o_custkey
),
calc AS (
  SELECT *, ApplicantIncome + CoapplicantIncome AS TotalIncome, LoanAmount / (Loan_Amount_Term + 1) AS EMI FROM app
)
SELECT loan_id, Gender, Married, Dependents, Education, Self_Employed, round(ApplicantIncome, 6) AS ApplicantIncome,
       round(CoapplicantIncome, 6) AS CoapplicantIncome, round(LoanAmount, 6) AS LoanAmount, Loan_Amount_Term,
       Credit_History, Property_Area, round(TotalIncome, 6) AS TotalIncome, round(ln(1 + LoanAmount), 6) AS LoanAmountLog,
       round(TotalIncome / (LoanAmount + 1), 6) AS Income_to_Loan_Ratio, round(EMI, 6) AS EMI,
       round(TotalIncome - EMI * 1000, 6) AS Balance_Income, Loan_Status
FROM calc"""
