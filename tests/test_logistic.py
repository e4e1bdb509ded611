"""Regressions fitted together are those that Spark fits one by one, in few passes."""

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from ledgerlens.operators import logistic, training
from ledgerlens.operators.sampling import with_fold

NAMES = ["a", "b", "both", "same"]


@pytest.fixture(scope="module")
def given(spark):
    draw, data = random.Random(4), []
    for i in range(900):
        a, b = draw.uniform(0, 9), draw.uniform(-400, 400)
        data.append((i, a, None if i % 50 == 0 else b, a + b, 7.0, int(a * 60 + b + draw.gauss(0, 40) > 250)))
    return spark.createDataFrame(data, "id long, a double, b double, both double, same double, y int").repartition(3).cache()


def test_grid_has_the_accuracy_of_single_fits(given, monkeypatch):
    passes, summed = [], logistic.curvatures
    monkeypatch.setattr(logistic, "curvatures", lambda *args: passes.append(1) or summed(*args))
    fitted, grid = training.logistic_grid(NAMES, given, "y", "id", strengths=(0.0001, 0.01, 1.0), folds=3)
    lr = training.logistic("y").setTol(1e-12)
    alone = ParamGridBuilder().addGrid(lr.regParam, [next(iter(point.values())) for point in grid]).build()
    evaluator = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")
    want = training.cross_validate(training.loan_features_pipeline(NAMES, lr), alone, given, evaluator, "id", 3)
    assert fitted.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-12)
    assert len(set(fitted.avgMetrics)) > 1 and 3 < len(passes) < 30
    assert fitted.bestModel.transform(given).count() == 882


def test_folds_of_one_class_and_without_rows(given):
    folded = with_fold(given, "id", 2).withColumn("y", (F.col("fold") == 1).cast("int"))
    # Each model has seen the other class only.
    assert logistic.grid_accuracy(folded, NAMES, "y", [0.1], 2) == [0.0]
    assert logistic.grid_accuracy(folded.withColumn("y", F.lit(1)), NAMES, "y", [0.1, 1.0], 2) == [1.0, 1.0]
    with pytest.raises(ValueError):
        logistic.grid_accuracy(folded.filter("fold = 0"), NAMES, "y", [0.1], 2)
    with pytest.raises(ValueError):
        logistic.grid_accuracy(folded.withColumn("y", F.lit(2)), NAMES, "y", [0.1], 2)
