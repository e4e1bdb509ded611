"""Judged evaluation of generated answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import prompts
from ledgerlens.functions.templates import fill, messages

# Fields of a verdict.
SCORES = ["accuracy", "completeness", "clarity", "relevance"]

VERDICT = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in [*SCORES, "overall_score"]]
    + [T.StructField("reasoning", T.StringType())]
)


def judge_prompts(df: DataFrame) -> DataFrame:
    """Add the chat that asks for a verdict on ``generated_answer``."""
    user = fill(
        prompts.JUDGE_USER,
        question=F.col("question"),
        expected=F.col("expected_answer"),
        generated=F.col("generated_answer"),
    )
    return df.withColumn("messages", messages(F.lit(prompts.JUDGE_SYSTEM), user))


def parse_judgement(df: DataFrame, col: str = "evaluation") -> DataFrame:
    """Add the scores of a JSON reply and whether they can be used.

    Code fences around the JSON are dropped. A reply is valid with four scores
    from 0 to 10; the overall score is computed from them, since the stated
    one need not be their mean.
    """
    body = F.regexp_replace(F.col(col), r"^\s*```(?:json)?\s*|\s*```\s*$", "")
    parsed = df.withColumn("_v", F.from_json(body, VERDICT))
    usable = [F.coalesce(F.col(f"_v.{c}").between(0, 10), F.lit(False)) for c in SCORES]
    valid = usable[0] & usable[1] & usable[2] & usable[3]
    mean = (F.col("_v.accuracy") + F.col("_v.completeness") + F.col("_v.clarity") + F.col("_v.relevance")) / 4
    return parsed.select(
        *df.columns,
        *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in SCORES],
        F.when(valid, mean).alias("overall_score"),
        F.when(valid, F.col("_v.reasoning")).alias("reasoning"),
        valid.alias("valid"),
    )


def judge_summary(parsed: DataFrame) -> DataFrame:
    """Mean scores of the valid verdicts, and how many there were."""
    return parsed.agg(
        F.count("*").alias("replies"),
        F.count_if("valid").alias("valid"),
        *[F.avg(c).alias(f"avg_{c}") for c in [*SCORES, "overall_score"]],
    )


def eval_results(questions: DataFrame, answers: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every answer to every evaluation question with the verdict on it.

    ``answers`` has (qa_id, answer_id, generated_answer) and ``verdicts``
    (qa_id, answer_id, evaluation). All answers stay, and a verdict belongs to
    the answer whose id it names; a question without answers has one row, with
    missing values. Several verdicts on one answer are a row each.
    """
    asked = questions.select(
        "qa_id",
        "question",
        "category",
        F.col("estimated_difficulty").alias("difficulty"),
        F.col("answer").alias("expected_answer"),
    )
    answered = asked.join(answers.select("qa_id", "answer_id", "generated_answer"), "qa_id", "left")
    return answered.join(verdicts.select("qa_id", "answer_id", "evaluation"), ["qa_id", "answer_id"], "left")
