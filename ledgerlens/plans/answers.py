"""From questions to the prompts that answer them, many questions at once."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.retrieval import answer_prompt, attach_hits, context_text, embed_text, similar


def retrieve(questions: DataFrame, chunks: DataFrame, model: PipelineModel, k: int = 3) -> DataFrame:
    """The ``k`` best chunks of each question: query_id, rank, score and the chunk's columns.

    ``questions`` has query_id and question, ``chunks`` is the gold table.
    """
    hits = similar(
        embed_text(questions, model, "question"),
        embed_text(chunks.select("chunk_id", "retrieval_text"), model),
        k,
        "chunk_id",
    )
    return attach_hits(hits, chunks)


def question_prompts(
    questions: DataFrame, chunks: DataFrame, model: PipelineModel, k: int = 3, style: str = "hindi"
) -> DataFrame:
    """Each question with its context, the number of chunks found, and the prompt.

    Further columns of ``questions``, such as the target language, are kept. A
    question without any chunk has an empty context.
    """
    found = retrieve(questions, chunks, model, k)
    counts = found.groupBy("query_id").agg(F.count("*").alias("num_chunks_retrieved"))
    contexts = context_text(found, compact=style == "compact").join(counts, "query_id")
    joined = questions.join(contexts, "query_id", "left").fillna({"context": "", "num_chunks_retrieved": 0})
    return answer_prompt(joined, style)
