"""Embedding, top-k similarity, context blocks and prompts.

Similarity is a matrix product per Arrow batch. Spark decides which vectors
meet which queries and merges the small per-task winners; only up to ``k``
rows per query leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    BucketedRandomProjectionLSH,
    HashingTF,
    Normalizer,
    RegexTokenizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlens.functions import prompts
from ledgerlens.functions.expressions import language_name
from ledgerlens.functions.nearest import as_numpy, best, nearest, unit_rows
from ledgerlens.functions.templates import fill, messages
from ledgerlens.session import written

# Queries of one pass over the vectors; their matrix is sent to every task.
SLICE_ROWS = 4096
# Queries and vectors of one hash bucket meet in blocks of about this many rows.
BLOCK_ROWS = 4096
# Columns of a retrieval hit.
HIT_COLUMNS = ["chunk_id", "document", "chunks_text", "issued_on", "regulation_area", "applicable_to"]


def embedder(text: str = "retrieval_text", features: int = 1024) -> Pipeline:
    """Lexical unit vectors: hashed term counts weighted by rarity."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern="[^\\p{L}\\p{N}]+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
            IDF(inputCol="_counts", outputCol="_weights"),
            Normalizer(inputCol="_weights", outputCol="_unit"),
        ]
    )


def embed_text(df: DataFrame, model: PipelineModel, text: str = "retrieval_text") -> DataFrame:
    """Add ``embedding`` to rows whose text may be under another name than the model's."""
    own = model.stages[0].getInputCol()
    named = df if text == own else df.withColumn(own, F.col(text))
    out = model.transform(named).withColumn("embedding", vector_to_array("_unit", "float32"))
    out = out.drop("_words", "_counts", "_weights", "_unit")
    return out if text == own else out.drop(own)


def _hit_type(queries: DataFrame, vectors: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", vectors.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _scan_topk(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """One pass over the vectors, with all queries in every task; no shuffle before the winners."""
    schema = _hit_type(queries, vectors)
    table = queries.toArrow()
    if table.num_rows == 0:
        return queries.sparkSession.createDataFrame([], schema)
    sent = queries.sparkSession.sparkContext.broadcast(
        (as_numpy(table.column("query_id")), unit_rows(table.column("embedding")))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix = sent.value
        kept = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = nearest(query_ids, matrix, as_numpy(batch.column("id")), unit_rows(batch.column("embedding")), k)
            kept = found if kept is None else best(pd.concat([kept, found]), k)
        if kept is not None:
            yield pa.RecordBatch.from_pandas(kept, preserve_index=False)

    return vectors.mapInArrow(scan, schema)


def _block_topk(queries: DataFrame, vectors: DataFrame, bucket: list[str], k: int, block_rows: int, compare=None) -> DataFrame:
    """Top-k among rows of the same bucket, for query sets of any size.

    A bucket's queries and vectors are dealt into blocks by hash, and each
    pair of blocks is one task. A bucket that holds a third of all rows is so
    many more blocks, not one large group. ``compare`` gives the best hits of
    two such blocks as a frame (query_id, id, score); cosines by default.
    """
    schema = _hit_type(queries, vectors)
    arrow_schema = to_arrow_schema(schema)

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*bucket).agg(F.ceil(F.count("*") / block_rows).cast("int").alias(name))

    sizes = written(blocks(queries, "_nq").join(blocks(vectors, "_nv"), bucket), "blocks")

    def dealt(df: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        # The input piece is part of the hash, so that copies of one id are dealt out too.
        return (
            df.withColumn("_piece", F.spark_partition_id())
            .join(sizes, bucket)
            .withColumn(own, F.pmod(F.xxhash64(key, "_piece"), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
            .drop("_nq", "_nv", "_piece")
        )

    keys = [*bucket, "_qb", "_vb"]
    left = dealt(queries, "query_id", "_qb", "_nq", "_vb", "_nv").groupBy(*keys)
    right = dealt(vectors, "id", "_vb", "_nv", "_qb", "_nq").groupBy(*keys)

    def meet(some_queries: pa.Table, some_vectors: pa.Table) -> pa.Table:
        if some_queries.num_rows == 0 or some_vectors.num_rows == 0:
            return arrow_schema.empty_table()
        found = compare(some_queries, some_vectors, k) if compare else nearest(
            as_numpy(some_queries.column("query_id")),
            unit_rows(some_queries.column("embedding")),
            as_numpy(some_vectors.column("id")),
            unit_rows(some_vectors.column("embedding")),
            k,
        )
        return pa.Table.from_pandas(found, preserve_index=False).cast(arrow_schema)

    return left.cogroup(right).applyInArrow(meet, schema)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def vector_problem(embedding: Column, width: int) -> Column:
    """Why a vector cannot be compared with queries of ``width`` entries; NULL if it can."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.when(embedding.isNull() | (F.size(embedding) <= 0), "missing")
        .when(F.size(embedding) != width, "width")
        .when(~F.coalesce(whole, F.lit(False)), "not finite")
    )


def query_width(queries: DataFrame) -> int:
    """The width that all queries with a vector have; 0 without any."""
    widths = queries.filter(F.size("embedding") > 0).select(F.size("embedding").alias("n")).distinct().limit(2).collect()
    if len(widths) > 1:
        raise ValueError("the queries' vectors have several widths")
    return widths[0]["n"] if widths else 0


def rejected(queries: DataFrame, vectors: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Rows that ``similar`` leaves out, with the reason: (id, side, reason)."""
    width = query_width(queries)
    sides = [
        df.select(F.col(key).cast("string").alias("id"), F.lit(side).alias("side"), vector_problem(F.col("embedding"), width).alias("reason"))
        for df, key, side in ((queries, "query_id", "query"), (vectors, id_col, "vector"))
    ]
    return sides[0].unionByName(sides[1]).filter(F.col("reason").isNotNull())


def _inputs(queries: DataFrame, vectors: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with known names, without the rows that ``rejected`` names."""
    width = query_width(queries)
    usable = vector_problem(F.col("embedding"), width).isNull()
    q = queries.select("query_id", "embedding").filter(usable)
    v = vectors.select(F.col(id_col).alias("id"), "embedding").filter(usable)
    return q, v


def similar(
    queries: DataFrame, vectors: DataFrame, k: int = 3, id_col: str = "vec_id", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The exact ``k`` nearest vectors of each query by cosine: query_id, id, score, rank.

    Queries go in slices of bounded size, one pass over the vectors for each;
    a task gives ``k`` rows per query at most. ``rejected`` lists what takes no
    part: vectors that are missing, not finite, or of another width.
    """
    q, v = _inputs(queries, vectors, id_col)
    q = written(q, "queries")
    parts = max(1, -(-q.count() // slice_rows))
    hits = _scan_topk(q.filter(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == 0), v, k)
    for part in range(1, parts):
        hits = hits.unionByName(_scan_topk(q.filter(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part), v, k))
    return _ranked(hits, k).withColumnRenamed("id", id_col)


def similar_lsh(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 3,
    id_col: str = "vec_id",
    tables: int = 8,
    width: int = 2,
    bucket_length: float = 0.25,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Approximate top-k: only vectors that share a hash bucket with the query are compared.

    Each of ``tables`` buckets joins ``width`` random projections. More tables
    find more; a larger width or smaller bucket length compares fewer.
    """
    q, v = _inputs(queries, vectors, id_col)
    q = written(q, "queries")
    if q.isEmpty():
        return _ranked(q.sparkSession.createDataFrame([], _hit_type(q, v)), k).withColumnRenamed("id", id_col)
    hashing = Pipeline(
        stages=[
            Normalizer(inputCol="_vec", outputCol="_unit"),
            BucketedRandomProjectionLSH(
                inputCol="_unit", outputCol="_hashes", numHashTables=tables * width, bucketLength=bucket_length, seed=seed
            ),
        ]
    )

    def vectors_of(df: DataFrame) -> DataFrame:
        return df.withColumn("_vec", array_to_vector(F.col("embedding").cast("array<double>")))

    model = hashing.fit(vectors_of(q))

    def bucketed(df: DataFrame) -> DataFrame:
        cells = [vector_to_array(F.col("_hashes")[i])[0].cast("int").cast("string") for i in range(tables * width)]
        per_table = [F.concat_ws(",", *cells[t * width : (t + 1) * width]) for t in range(tables)]
        return (
            model.transform(vectors_of(df))
            .select("*", F.posexplode(F.array(*per_table)).alias("_table", "_bucket"))
            .drop("_vec", "_unit", "_hashes")
        )

    hits = _block_topk(bucketed(q), bucketed(v), ["_table", "_bucket"], k, block_rows)
    # The same pair may meet in several tables.
    once = hits.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return _ranked(once, k).withColumnRenamed("id", id_col)


def attach_hits(hits: DataFrame, chunks: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """Chunk columns for each hit. The hits are stored first: they are the small side."""
    return written(hits, "hits").join(chunks, id_col)


def chunk_block(compact: bool = False) -> Column:
    """The labelled lines of one chunk; missing values read ``None``."""
    # Line labels.
    lines = "[Chunk ID: {chunk_id}]\nDocument: {document}\nIssued on: {issued_on}\nRegulation area: {regulation_area}\nApplicable to: {applicable_to}\nText: {chunks_text}"
    if compact:
        lines = "Document: {document}\nIssued on: {issued_on}\nText: {chunks_text}"
    return fill(lines, **{c: F.col(c) for c in HIT_COLUMNS})


def context_text(hits: DataFrame, compact: bool = False) -> DataFrame:
    """One context per query: its chunks in rank order, a blank line between them."""
    parts = F.array_sort(F.collect_list(F.struct("rank", chunk_block(compact).alias("text"))))
    return (
        hits.groupBy("query_id")
        .agg(parts.alias("_parts"))
        .select("query_id", F.array_join(F.col("_parts.text"), "\n\n").alias("context"))
    )


def answer_prompt(df: DataFrame, style: str = "hindi") -> DataFrame:
    """Add the prompt for a question and its context.

    ``plain`` adds one text column ``prompt``; ``hindi``, ``simple`` and
    ``compact`` add ``messages``.
    """
    values = {"question": F.col("question"), "context": F.col("context")}
    if style == "plain":
        return df.withColumn("prompt", fill(prompts.PLAIN_PROMPT, **values))
    chats = {
        "hindi": (prompts.HINDI_SYSTEM, prompts.HINDI_USER),
        "simple": (prompts.SIMPLE_SYSTEM, prompts.SIMPLE_USER),
        "compact": (prompts.COMPACT_SYSTEM, prompts.COMPACT_USER),
    }
    system, user = chats[style]
    return df.withColumn("messages", messages(F.lit(system), fill(user, **values)))


def translation_prompts(df: DataFrame) -> DataFrame:
    """Add the prompt that turns ``hindi_answer`` into ``target_language``.

    Rows that ask for Hindi are left out: their answer needs no translation.
    """
    wanted = df.filter(F.lower("target_language") != "hindi").withColumn(
        "language", language_name(F.col("target_language"))
    )
    system = fill(prompts.TRANSLATE_SYSTEM, language=F.col("language"))
    user = fill(prompts.TRANSLATE_USER, language=F.col("language"), text=F.col("hindi_answer"))
    return wanted.withColumn("messages", messages(system, user))


def final_answers(answers: DataFrame, translated: DataFrame, key: str = "query_id") -> DataFrame:
    """The translated answer, or the Hindi one where Hindi was asked for."""
    joined = answers.join(translated.select(key, "translated_answer"), key, "left")
    is_hindi = F.lower("target_language") == "hindi"
    return joined.withColumn(
        "translated_answer", F.when(is_hindi, F.col("hindi_answer")).otherwise(F.col("translated_answer"))
    )
