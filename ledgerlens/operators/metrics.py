"""Decisions, thresholds and classification metrics over a score column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import f1_score, share_or_zero
from ledgerlens.plans.running import running_sum

# Thresholds of the sweep, 0.2 to 0.9.
SWEEP = [i / 10 for i in range(2, 10)]

# A model is accepted at these levels.
MIN_PRECISION = 0.80
MIN_RECALL = 0.70


def confusion(df: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def _rates(cells: DataFrame) -> DataFrame:
    """Precision, recall and F1 out of tp, fp, fn, tn."""
    scored = cells.withColumns(
        {
            "precision": share_or_zero(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": share_or_zero(F.col("tp"), F.col("tp") + F.col("fn")),
        }
    )
    return scored.withColumn("f1", f1_score(F.col("precision"), F.col("recall")))


def threshold_sweep(
    df: DataFrame,
    thresholds: list[float] = SWEEP,
    label: str = "is_fraud",
    score: str = "fraud_probability",
) -> DataFrame:
    """Cells, precision, recall and F1 at each threshold, in one pass over the rows.

    Each row counts the thresholds it reaches. Grouping by that number leaves
    at most ``len(thresholds) + 1`` rows, from which all cells follow.
    """
    ts = sorted(thresholds)
    known = df.filter(F.col(label).isin(0, 1))
    level = reduce(lambda a, b: a + b, [F.when(F.col(score) >= t, 1).otherwise(0) for t in ts])
    levels = known.groupBy(level.alias("level")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )

    def total(col: str, keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, F.col(col))), F.lit(0))

    cells = [
        F.struct(
            F.lit(t).alias("threshold"),
            total("pos", F.col("level") > i).alias("tp"),
            total("neg", F.col("level") > i).alias("fp"),
            total("pos", F.col("level") <= i).alias("fn"),
            total("neg", F.col("level") <= i).alias("tn"),
        )
        for i, t in enumerate(ts)
    ]
    return _rates(levels.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))


def confusion_at(
    df: DataFrame, threshold: float, label: str = "is_fraud", score: str = "fraud_probability"
) -> DataFrame:
    """The sweep at one threshold."""
    return threshold_sweep(df, [threshold], label, score)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest F1; among ties the highest recall, then the fewest false positives.

    ``tier`` tells which of the three settled it. A tie of all three goes to
    the lowest threshold.
    """
    rank = F.struct("f1", "recall", -F.col("fp"), -F.col("threshold"))
    row = F.struct("threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1")
    best = sweep.agg(
        F.max_by(row, rank).alias("best"),
        F.collect_list(F.struct("f1", "recall")).alias("all"),
    )
    f1, recall = F.col("best.f1"), F.col("best.recall")
    same_f1 = F.size(F.filter("all", lambda r: r["f1"] == f1))
    same_both = F.size(F.filter("all", lambda r: (r["f1"] == f1) & (r["recall"] == recall)))
    tier = F.when(same_f1 == 1, 1).when(same_both == 1, 2).otherwise(3)
    return best.filter(F.col("best").isNotNull()).select("best.*", tier.alias("tier"))


def accepted(best: DataFrame) -> DataFrame:
    """Whether the chosen threshold reaches the required precision and recall."""
    return best.withColumns(
        {
            "precision_ok": F.col("precision") >= MIN_PRECISION,
            "recall_ok": F.col("recall") >= MIN_RECALL,
        }
    )


def score_curve(df: DataFrame, label: str = "is_fraud", score: str = "fraud_probability") -> DataFrame:
    """Every distinct score as a threshold: ``pos`` and ``n`` at it, ``tp`` and ``flagged`` from it upwards.

    Equal scores are collapsed first; the running counts from the highest
    score down are computed per range of scores.
    """
    points = (
        df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count("*").alias("n"))
    )
    return running_sum(points, "threshold", ["pos", "n"], descending=True).withColumnsRenamed(
        {"sum_pos": "tp", "sum_n": "flagged"}
    )


def pr_threshold(df: DataFrame, label: str = "is_fraud", score: str = "fraud_probability") -> DataFrame:
    """The distinct score that, as a threshold, gives the best F1 (lowest among ties)."""
    curve = score_curve(df, label, score)
    total = curve.agg(F.sum("pos")).scalar()
    precision = F.col("tp") / F.col("flagged")
    recall = F.when(F.col("_total") > 0, F.col("tp") / F.col("_total")).otherwise(1.0)
    rated = curve.withColumn("_total", total).select(
        "threshold",
        precision.alias("precision"),
        recall.alias("recall"),
        (2 * (precision * recall) / (precision + recall + F.lit(1e-10))).alias("f1"),
    )
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct("f1", -F.col("threshold")))
    return rated.agg(best.alias("best")).filter(F.col("best").isNotNull()).select("best.*")


def ranking_areas(df: DataFrame, label: str = "is_fraud", score: str = "fraud_probability") -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve (trapezoids), one row.

    Each point of the curve knows the one before it, since its own counts are
    what the running counts grew by. Without both classes the ROC area is
    NULL; without positives the other one is too.
    """
    curve = score_curve(df, label, score)
    neg = F.col("n") - F.col("pos")
    before = F.col("tp") - F.col("pos")
    flagged_before = F.col("flagged") - F.col("n")
    precision = F.col("tp") / F.col("flagged")
    # The curve starts at recall 0 with the precision of the highest score.
    precision_before = F.when(flagged_before > 0, before / flagged_before).otherwise(precision)
    sums = curve.agg(
        F.sum(neg * (before + F.col("pos") / 2)).alias("_won"),
        F.sum(F.col("pos") * (precision + precision_before) / 2).alias("_area"),
        F.sum("pos").cast("double").alias("_p"),
        F.sum(neg).cast("double").alias("_n"),
    )
    return sums.select(
        F.try_divide("_won", F.col("_p") * F.col("_n")).alias("auc_roc"),
        F.try_divide("_area", "_p").alias("pr_auc"),
    )


def flag_stats(scored: DataFrame, flag: str = "fraud_flag", label: str = "is_fraud") -> DataFrame:
    """Rows flagged, their percentage, and the percentage of them that is fraud."""
    counted = scored.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(flag) == 1).alias("flagged"),
        F.count_if((F.col(flag) == 1) & (F.col(label) == 1)).alias("fraud_in_flagged"),
    )
    return counted.withColumns(
        {
            "flag_pct": F.try_divide("flagged", "total") * 100,
            "flagged_precision_pct": F.try_divide("fraud_in_flagged", "flagged") * 100,
        }
    )


def prediction_mix(history: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows per predicted label, and of all labels together."""
    counts = history.groupBy(prediction).agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy()))


def class_report(df: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    cells = df.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).agg(
        F.count("*").alias("n")
    )
    correct = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"), correct.alias("tp")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"), F.lit(0).cast("bigint").alias("tp")),
    )
    classes = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("tp").alias("tp"))
    )
    precision = share_or_zero(F.col("tp"), F.col("called"))
    recall = share_or_zero(F.col("tp"), F.col("support"))
    rated = classes.select("class", "support", "tp", precision.alias("precision"), recall.alias("recall"))
    rated = rated.withColumn("f1", f1_score(F.col("precision"), F.col("recall")))

    def weighted(col: str):
        return F.try_divide(F.sum(F.col(col) * F.col("support")), F.sum("support"))

    # The grand total of the rollup carries the means over classes.
    rolled = rated.rollup("class").agg(
        F.grouping("class").alias("is_total"),
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )

    def line(name, p, r, f):
        return F.struct(
            name.alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("support").alias("support")
        )

    accuracy = F.try_divide(F.col("tp"), F.col("support"))
    per_class = line(F.col("class").cast("string"), F.col("precision"), F.col("recall"), F.col("f1"))
    totals = [
        line(F.lit("accuracy"), accuracy, accuracy, accuracy),
        line(F.lit("macro avg"), F.col("precision"), F.col("recall"), F.col("f1")),
        line(F.lit("weighted avg"), F.col("w_precision"), F.col("w_recall"), F.col("w_f1")),
    ]
    return rolled.select(
        F.inline(F.when(F.col("is_total") == 1, F.array(*totals)).otherwise(F.array(per_class)))
    )
