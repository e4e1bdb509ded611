"""A mergeable sketch of scored rows, and the threshold with the best F1 from it.

Scores from 0 to 1 are counted in equal buckets by class: a table of at most
2 ** bits rows, whatever the number of rows. Sketches of parts, batches or a
stream are added up bucket by bucket. Every bucket's lower bound is a
threshold whose precision and recall are exact. What can be missed is a
threshold inside a bucket: lowered to the bucket's bound it flags at most that
bucket's rows more (the rank error), and its F1 falls by at most ``f1_error``.

Rows without a label or score are left out; scores outside 0 to 1 count in
the first or last bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 14


def score_sketch(df: DataFrame, label: str = "is_fraud", score: str = "fraud_probability", bits: int = BITS) -> DataFrame:
    """(bucket, n, pos), from a batch or, with complete output, a stream: the state is no larger than the sketch."""
    size = 1 << bits
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    bucket = F.least(F.greatest(F.floor(F.col(score) * size), F.lit(0)), F.lit(size - 1)).cast("int")
    return known.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"))


def merged(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows of several sketches with the same bits."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def sketched_threshold(sketch: DataFrame, bits: int = BITS) -> DataFrame:
    """One row: threshold, precision, recall, f1, rank_error (rows) and f1_error; the highest of equal thresholds, none without positives."""
    # At most 2 ** bits rows.
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    curve = sketch.select(
        "bucket", "n", F.sum("n").over(above).alias("flagged"), F.sum("pos").over(above).alias("tp"), F.sum("pos").over(every).alias("all")
    )
    f1 = 2 * F.col("tp") / (F.col("flagged") + F.col("all"))
    # A threshold inside the bucket flags fewer rows and finds no more: its F1 is at most this.
    most = 2 * F.col("tp") / (F.col("flagged") - F.col("n") + F.col("all"))
    rated = curve.filter("all > 0").withColumns({"f1": f1, "most": F.least(F.lit(1.0), most)})
    best = rated.agg(F.max_by(F.struct("bucket", "flagged", "tp", "all", "f1"), F.struct("f1", "bucket")).alias("b"), F.max("most").alias("most"), F.max("n").alias("rank_error"))
    return best.filter("b is not null").select(
        (F.col("b.bucket") / F.lit(float(1 << bits))).alias("threshold"), (F.col("b.tp") / F.col("b.flagged")).alias("precision"),
        (F.col("b.tp") / F.col("b.all")).alias("recall"), F.col("b.f1").alias("f1"), "rank_error", (F.col("most") - F.col("b.f1")).alias("f1_error"),
    )
