"""Bronze, silver and gold layers of question-answer documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import content_id

# Columns of the gold tables.
CHUNK_KEY = ["document", "filename", "chunks_text"]
CHUNK_META = ["issued_on", "regulation_area", "applicable_to", "key_topics", "is_table"]
EVAL_COLUMNS = [
    "qa_id", "document", "question", "answer", "rephrased_question", "rephrased_answer",
    "evaluation_criteria", "category", "estimated_difficulty",
]


def with_lineage(df: DataFrame, split: str, source: str) -> DataFrame:
    return df.withColumns({"split": F.lit(split), "source_table": F.lit(source)})


def bronze(train: DataFrame, eval_: DataFrame, train_name: str = "train", eval_name: str = "eval") -> DataFrame:
    """Both sources in one table; columns one of them lacks are NULL there."""
    return (
        with_lineage(train, "train", train_name)
        .unionByName(with_lineage(eval_, "eval", eval_name), allowMissingColumns=True)
        .withColumn("ingested_at", F.current_timestamp())
    )


def collapse_spaces(col: Column) -> Column:
    return F.regexp_replace(col, r"\s+", " ")


def silver(raw: DataFrame) -> DataFrame:
    """Trimmed names, real dates, single spaces, and a content id. No shuffle."""
    trimmed = ["document", "filename", "regulation_area", "applicable_to"]
    collapsed = ["chunks_text", "question", "answer"]
    clean = raw.withColumns(
        {
            **{c: F.trim(F.col(c)) for c in trimmed},
            **{c: collapse_spaces(F.col(c)) for c in collapsed},
            "issued_on": F.col("issued_on").try_cast("date"),
        }
    )
    return clean.withColumn("qa_id", content_id("split", "document", "filename", "question", "answer"))


def retrieval_text() -> Column:
    """The labelled lines a chunk is searched by."""
    # Line labels.
    lines = {
        "Document: ": F.col("document"),
        "Filename: ": F.col("filename"),
        "Regulation area: ": F.col("regulation_area"),
        "Applicable to: ": F.col("applicable_to"),
        "Issued on: ": F.col("issued_on").cast("string"),
        "Chunk: ": F.col("chunks_text"),
    }
    return F.concat_ws("\n", *[F.concat(F.lit(k), F.coalesce(v, F.lit(""))) for k, v in lines.items()])


def gold_chunks(clean: DataFrame) -> DataFrame:
    """One row per (document, filename, text), with its id and search text.

    Of several copies the one with the smallest metadata stays, so a rerun
    gives the same table. Copies collapse before the shuffle.
    """
    return (
        clean.select(*CHUNK_KEY, *CHUNK_META)
        .dropna(subset=CHUNK_KEY)
        .groupBy(*CHUNK_KEY)
        .agg(F.min(F.struct(*CHUNK_META)).alias("_meta"))
        .select(*CHUNK_KEY, "_meta.*")
        .withColumn("chunk_id", content_id(*CHUNK_KEY))
        .withColumn("retrieval_text", retrieval_text())
    )


def gold_eval(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("split") == "eval").select(*EVAL_COLUMNS)
