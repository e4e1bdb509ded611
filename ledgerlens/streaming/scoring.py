"""Scoring of a transaction stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.expressions import decide
from ledgerlens.plans.fraud import score
from ledgerlens.session import scratch_path


def read_files(spark: SparkSession, directory: str, schema: T.StructType, glob: str = "*.parquet", per_trigger: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(directory)


def score_stream(
    txn: DataFrame,
    states: list[str],
    infra: DataFrame,
    rates: DataFrame,
    model: PipelineModel,
    threshold: float,
    keep: list[str] = (),
) -> DataFrame:
    """The batch scorer on a stream: row by row, without state."""
    return score(txn, states, infra, rates, model, threshold, keep)


def stream_mix(scored: DataFrame) -> DataFrame:
    """Running count per label. The state is one row per label, so no watermark is needed."""
    label = decide(F.col("fraud_probability"), 0.5)["label"] if "prediction" not in scored.columns else F.col("prediction")
    return scored.groupBy(label.alias("prediction")).agg(F.count("*").alias("n"))


def drain_to_table(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Process all files there are, append the rows to a table, and read it back.

    With the same ``path`` a later run goes on where the last one ended: the
    checkpoint beside the table makes every row appear exactly once.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def drain_counts(counts: DataFrame, name: str) -> DataFrame:
    """Process all files there are and return the final counts.

    Complete mode: the memory table holds one row per label.
    """
    spark = counts.sparkSession
    query = (
        counts.writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", scratch_path(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.table(name)
