"""Splits and class balancing that do not depend on the partitioning.

A row's side follows from a hash of its key, so a retried task, another
cluster size or another file layout gives the same sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import hash_share, hash_word
from ledgerlens.session import written

# Buckets of the hash used to find the cut of a stratified split: 2 ** BUCKET_BITS.
BUCKET_BITS = 16


def split(
    df: DataFrame, key: str, train: float = 0.8, seed: int = 42, method: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. ``method="random"`` is Spark's ``randomSplit``."""
    if method == "random":
        first, second = df.randomSplit([train, 1 - train], seed=seed)
        return first, second
    share = hash_share(F.col(key), seed)
    return df.filter(share < train), df.filter(share >= train)


def with_fold(df: DataFrame, key: str, folds: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..folds-1."""
    return df.withColumn("fold", (hash_word(F.col(key), seed) % folds).cast("int"))


def stratified_side(
    df: DataFrame, key: str, label: str, train: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``is_train``: exactly ``round(train * n)`` rows of every class.

    The rows of a class in hash order are cut at the wanted rank. Counts per
    hash bucket show which bucket holds the cut; only that bucket's rows (one
    in 2 ** BUCKET_BITS) are ranked. ``key`` must be unique.
    """
    hashed = df.withColumn("_hash", hash_word(F.col(key), seed))
    slim = hashed.select(label, key, "_hash", F.shiftright("_hash", 32 - BUCKET_BITS).alias("_bucket"))
    counts = slim.groupBy(label, "_bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(label)
    marks = (
        counts.select(
            label,
            "_bucket",
            "n",
            F.sum("n").over(upto).alias("_upto"),
            F.round(F.sum("n").over(whole) * train).cast("bigint").alias("_wanted"),
        )
        .filter((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("n") < F.col("_wanted")))
        .select(label, "_bucket", (F.col("_wanted") - F.col("_upto") + F.col("n")).alias("_rest"))
    )
    # One row per class; stored so that its size is known to the planner.
    marks = written(marks, "strata")
    ranked = Window.partitionBy(label, "_bucket").orderBy("_hash", key)
    # Missing labels are a class of their own.
    found = marks.select(F.col(label).alias("_class"), F.col("_bucket").alias("_b"), "_rest")
    cuts = (
        slim.join(found, F.col(label).eqNullSafe(F.col("_class")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == F.col("_rest"))
        .select(F.col(label).alias("_label"), F.struct("_hash", key).alias("_cut"))
    )
    cuts = written(cuts, "cuts")
    return (
        hashed.join(cuts, F.col(label).eqNullSafe(F.col("_label")), "left")
        .withColumn("is_train", F.coalesce(F.struct("_hash", key) <= F.col("_cut"), F.lit(False)))
        .drop("_hash", "_label", "_cut")
    )


def stratified_split(
    df: DataFrame, key: str, label: str, train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    sided = stratified_side(df, key, label, train, seed)
    return sided.filter("is_train").drop("is_train"), sided.filter("not is_train").drop("is_train")


def balanced_train(
    train: DataFrame, key: str, label: str = "is_fraud", ratio: float = 5.0, seed: int = 42, weights: bool = True
) -> DataFrame:
    """All positives, about ``ratio`` negatives per positive, and ``sample_weight``.

    A positive weighs as much as there were negatives per positive before
    sampling; ``weights=False`` gives every row weight 1, for callers who do
    not want to correct the imbalance twice.
    """
    positive, negative = F.col(label) == 1, F.col(label) == 0
    counts = train.agg(
        F.struct(F.count_if(positive).alias("pos"), F.count_if(negative).alias("neg"))
    ).scalar()
    with_counts = train.withColumn("_counts", counts)
    wanted = F.floor(F.col("_counts.pos") * ratio)
    fraction = F.try_divide(wanted.cast("double"), F.col("_counts.neg"))
    kept = with_counts.filter(positive | (negative & (hash_share(F.col(key), seed + 1) < fraction)))
    weight = F.try_divide(F.col("_counts.neg").cast("double"), F.col("_counts.pos"))
    return kept.withColumn(
        "sample_weight", F.when(positive, weight).otherwise(1.0) if weights else F.lit(1.0)
    ).drop("_counts")
