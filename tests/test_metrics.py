import random

import pytest
from helpers import by, rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from ledgerlens.operators.metrics import (
    SWEEP,
    accepted,
    best_threshold,
    class_report,
    confusion,
    confusion_at,
    flag_stats,
    pr_threshold,
    prediction_mix,
    ranking_areas,
    threshold_sweep,
)

SCHEMA = "is_fraud int, fraud_probability double"


def naive(data, t):
    tp = sum(y == 1 and p >= t for y, p in data)
    fp = sum(y == 0 and p >= t for y, p in data)
    fn = sum(y == 1 and p < t for y, p in data)
    tn = sum(y == 0 and p < t for y, p in data)
    precision = tp / (tp + fp) if tp + fp else 0
    recall = tp / (tp + fn) if tp + fn else 0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0
    return {"tp": tp, "fp": fp, "fn": fn, "tn": tn, "precision": precision, "recall": recall, "f1": f1}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sweep_equals_a_loop_over_thresholds(spark, seed):
    rng = random.Random(seed)
    data = [(int(rng.random() < 0.3), round(rng.random(), rng.choice([1, 2, 6]))) for _ in range(800)]
    got = by(threshold_sweep(spark.createDataFrame(data, SCHEMA).repartition(5)), "threshold")
    assert sorted(got) == SWEEP
    for t, row in got.items():
        want = naive(data, t)
        assert {k: row[k] for k in ("tp", "fp", "fn", "tn")} == {k: want[k] for k in ("tp", "fp", "fn", "tn")}
        assert row["tp"] + row["fp"] + row["fn"] + row["tn"] == 800
        for k in ("precision", "recall", "f1"):
            assert row[k] == pytest.approx(want[k])


def test_sweep_of_nothing(spark):
    got = rows(threshold_sweep(spark.createDataFrame([], SCHEMA)))
    assert len(got) == 8 and all(g["tp"] == 0 and g["f1"] == 0 for g in got)


def test_a_missing_score_is_not_flagged(spark):
    got = confusion_at(spark.createDataFrame([(1, None), (0, 0.9)], SCHEMA), 0.5).first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (0, 1, 1, 0)


SWEEP_SCHEMA = "threshold double, tp bigint, fp bigint, fn bigint, tn bigint, precision double, recall double, f1 double"


@pytest.mark.parametrize(
    "lines,threshold,tier",
    [
        ([(0.2, 5, 0.5, 0.5), (0.3, 5, 0.5, 0.6)], 0.3, 1),
        ([(0.2, 5, 0.5, 0.6), (0.3, 5, 0.7, 0.6)], 0.3, 2),
        ([(0.2, 5, 0.7, 0.6), (0.3, 4, 0.7, 0.6), (0.4, 6, 0.7, 0.6)], 0.3, 3),
        ([(0.4, 4, 0.7, 0.6), (0.3, 4, 0.7, 0.6)], 0.3, 3),
    ],
)
def test_best_threshold_tiers(spark, lines, threshold, tier):
    data = [(t, 1, fp, 0, 0, 0.9, recall, f1) for t, fp, recall, f1 in lines]
    got = best_threshold(spark.createDataFrame(data, SWEEP_SCHEMA))
    row = accepted(got).first()
    assert (row["threshold"], row["tier"]) == (threshold, tier)
    assert row["precision_ok"] and row["recall_ok"] == (row["recall"] >= 0.7)
    assert got.count() == 1 and best_threshold(spark.createDataFrame([], SWEEP_SCHEMA)).count() == 0


@pytest.mark.parametrize("digits", [1, 2, 8])
def test_pr_threshold_equals_trying_every_score(spark, digits):
    rng = random.Random(digits)
    data = []
    for _ in range(600):
        y = int(rng.random() < 0.4)
        data.append((y, round(min(1.0, max(0.0, rng.gauss(0.4 + 0.25 * y, 0.2))), digits)))
    best = None
    for t in sorted({p for _, p in data}):
        n = naive(data, t)
        f1 = 2 * n["precision"] * n["recall"] / (n["precision"] + n["recall"] + 1e-10)
        if best is None or f1 > best[1]:
            best = (t, f1, n["precision"], n["recall"])
    got = pr_threshold(spark.createDataFrame(data, SCHEMA).repartition(7)).first()
    assert got["threshold"] == best[0]
    assert (got["f1"], got["precision"], got["recall"]) == pytest.approx(best[1:])


def test_pr_threshold_of_nothing(spark):
    assert pr_threshold(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("digits", [1, 3, 9])
def test_areas_equal_the_library_evaluator(spark, digits):
    rng = random.Random(digits)
    data = []
    for _ in range(700):
        y = int(rng.random() < 0.3)
        data.append((y, round(rng.gauss(0.4 + 0.2 * y, 0.2), digits)))
    df = spark.createDataFrame(data, SCHEMA).repartition(6).cache()
    got = ranking_areas(df).first()
    # Without bins the evaluator uses every distinct score.
    evaluator = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="fraud_probability", numBins=0)
    assert got["auc_roc"] == pytest.approx(evaluator.setMetricName("areaUnderROC").evaluate(df), abs=1e-9)
    assert got["pr_auc"] == pytest.approx(evaluator.setMetricName("areaUnderPR").evaluate(df), abs=1e-9)


@pytest.mark.parametrize("label,roc,pr", [(1, None, 1.0), (0, None, None)])
def test_areas_of_one_class(spark, label, roc, pr):
    got = ranking_areas(spark.createDataFrame([(label, 0.1), (label, 0.7)], SCHEMA)).first()
    assert (got["auc_roc"], got["pr_auc"]) == (roc, pr)


def test_class_report_of_the_published_matrix(spark):
    """Rejected [11, 2], Approved [11, 72], as a matrix of true by predicted."""
    cells = {(0, 0): 11, (0, 1): 2, (1, 0): 11, (1, 1): 72}
    data = [k for k, n in cells.items() for _ in range(n)]
    got = by(class_report(spark.createDataFrame(data, "is_fraud int, prediction int")), "class")
    rounded = {k: tuple(round(v[c], 2) for c in ("precision", "recall", "f1")) for k, v in got.items()}
    assert rounded["0"] == (0.50, 0.85, 0.63)
    assert rounded["1"] == (0.97, 0.87, 0.92)
    assert rounded["accuracy"] == (0.86, 0.86, 0.86)
    assert rounded["macro avg"] == (0.74, 0.86, 0.77)
    assert got["weighted avg"]["recall"] == pytest.approx(got["accuracy"]["recall"])
    assert [got[k]["support"] for k in ("0", "1", "macro avg")] == [13, 83, 96]


def test_class_report_with_a_class_never_predicted(spark):
    got = by(class_report(spark.createDataFrame([(0, 0), (1, 0)], "is_fraud int, prediction int")), "class")
    assert got["1"]["precision"] == 0 and got["1"]["f1"] == 0 and got["0"]["precision"] == 0.5


def test_flags_confusion_and_mix(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (0, 0)], "is_fraud int, fraud_flag int")
    got = flag_stats(df).first()
    assert (got["flagged"], got["flag_pct"], got["flagged_precision_pct"]) == (2, 50.0, 50.0)
    none = flag_stats(df.filter("fraud_flag = 0")).first()
    assert none["flagged"] == 0 and none["flagged_precision_pct"] is None
    cells = {(r["is_fraud"], r["fraud_flag"]): r["n"] for r in rows(confusion(df, prediction="fraud_flag"))}
    assert cells == {(1, 1): 1, (0, 1): 1, (0, 0): 2}
    mix = by(prediction_mix(spark.createDataFrame([("FRAUD",), ("SAFE",), ("SAFE",)], "prediction string")), "prediction")
    assert mix["SAFE"] == {"prediction": "SAFE", "n": 2, "total": 3}
