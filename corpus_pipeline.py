"""A training corpus from raw documents: five stages, each a table in the shared folder that the next one reads.

    toxicity        documents that the classifier marks as toxic go
    near copies     one document stays of each group that is linked by n-gram similarity
    benchmarks      documents with a passage of a benchmark item go
    mix             sources are brought to their target weights; a document may be taken twice, or not at all
    token files     ids of all documents are written to files, and what the files hold is listed

Every stage works on all rows of the one before. All but the last return the
columns of the documents. Null texts, null ids, repeated rows, empty tables and
extra columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm import decontaminate, jaccard, mixing, token_files, toxicity
from ledgerlens.llm.common import stored, table

# Names that no given column has.
ID, TEXT = "__doc_id", "__text_id"
KEY = [ID, TEXT]
# Stands for a missing id where rows are told apart by id and text.
NO_ID = -(2**63)


def identity(doc_id: Column, tid: Column) -> list[Column]:
    return [F.coalesce(doc_id.cast("long"), F.lit(NO_ID)).alias(ID), tid.alias(TEXT)]


def keyed(docs: DataFrame) -> DataFrame:
    """Add the id and a hash of the text, which tell the rows of a result apart."""
    return docs.select("*", *identity(col("doc_id"), F.coalesce(F.xxhash64("text"), F.lit(0))))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, tid) is not in ``gone``."""
    some = gone.select(*identity(col("doc_id"), col("tid"))).distinct()
    return keyed(docs).join(some, KEY, "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows but those whose text scores at least the threshold.

    Null and empty texts stay, as do texts that score low under any id, null
    ids included. Repeated rows stay or go together.
    """
    model = toxicity.fit(docs, table(spark, "labels", sf_dir))
    scored = toxicity.score(docs, model)
    return without(docs, scored.filter(col("score") >= toxicity.THRESHOLD))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id stays of each component, once; documents without words all stay."""
    members = jaccard.similar_components(docs)
    first = members.filter((col("n_shingles") == 0) | col("doc_id").eqNullSafe(col("component_id")))
    # An id with several texts in one component keeps the text of the smallest hash. The root tells components apart:
    # ids are null in some, and an id with unlike texts can be the smallest of several.
    first = first.groupBy("doc_id", F.when(col("n_shingles") > 0, col("root")).alias("__c"), F.when(col("n_shingles") == 0, col("tid")).alias("__e"))
    stay = first.agg(F.min("tid").alias("tid")).select(*identity(col("doc_id"), col("tid")))
    # Repeated rows are copies as well.
    return keyed(docs).join(stay, KEY, "left_semi").dropDuplicates(KEY).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows but those in which a passage of a benchmark item is found.

    Null and empty texts stay. An id with several texts loses only those that
    hold a passage, whether the id is null or not; repeated rows go together.
    """
    return without(docs, decontaminate.contaminated(docs, table(spark, "benchmark", sf_dir)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mix(docs)
    # Repeated rows are drawn each; what they get together is given to one of them.
    copies = taken.groupBy(*identity(col("doc_id"), col("tid")), col("source").alias("__source")).agg(F.sum("copies").cast("int").alias("__n"))
    copies = copies.filter(col("__n") > 0)
    met = keyed(docs).join(copies, KEY).filter(col("source").eqNullSafe(col("__source"))).dropDuplicates([*KEY, "__source"])
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), col("__n")))).select(*docs.columns)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the ids of all texts to files, and list what the files hold: a row for every row given, repeated ones too.

    Null and empty texts have the end id only; a null id comes last.
    """
    return token_files.op3_token_files(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_similar),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_ids),
]

# The classifier, the sampling and the tokenizer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, "documents", sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
