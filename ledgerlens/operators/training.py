"""Spark ML pipelines: fitting, cross-validation, evaluation and importances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import class_probability
from ledgerlens.operators.logistic import grid_accuracy
from ledgerlens.operators.metrics import class_report, ranking_areas
from ledgerlens.operators.sampling import with_fold
from ledgerlens.operators.transactions import NUMERIC_FEATURES


def scaled_features(numeric: list[str], categorical: list[str] = (), centre: bool = False) -> list:
    """Index, assemble and scale. Unknown categories are kept, rows with missing numbers skipped."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in categorical]
    inputs = [*numeric, *[f"{c}_index" for c in categorical]]
    return [
        *indexers,
        VectorAssembler(inputCols=inputs, outputCol="features_unscaled", handleInvalid="skip"),
        StandardScaler(inputCol="features_unscaled", outputCol="features", withStd=True, withMean=centre),
    ]


def skipped_count(df: DataFrame, numeric: list[str]) -> DataFrame:
    """How many rows the assembler skips: those with a missing or NaN input."""
    bad = F.lit(False)
    for c in numeric:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return df.agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("skipped"))


def forest(label: str = "is_fraud", trees: int = 100, depth: int = 10, weight: str | None = "sample_weight") -> RandomForestClassifier:
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=42)
    return rf.setWeightCol(weight) if weight else rf


def fraud_pipeline(trees: int = 100, depth: int = 10, weight: str | None = "sample_weight") -> Pipeline:
    """Type index, 17 numbers, scaling without centring, weighted forest."""
    return Pipeline(stages=[*scaled_features(NUMERIC_FEATURES, ["type"]), forest("is_fraud", trees, depth, weight)])


def fraud_feature_names() -> list[str]:
    return [*NUMERIC_FEATURES, "type_index"]


def with_probability(predictions: DataFrame, threshold: float = 0.5, name: str = "fraud_probability") -> DataFrame:
    """Add the positive class's probability and the 0/1 prediction; drop the ML vectors."""
    return (
        predictions.withColumn(name, class_probability(F.col("probability")))
        .withColumn("prediction", F.when(F.col(name) >= threshold, 1.0).otherwise(0.0))
        .drop("features_unscaled", "features", "rawPrediction", "probability")
    )


def binary_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """AUC-ROC, AUC-PR and the weighted and positive-class metrics as one row.

    ``scored`` is read several times, so it should be a stored table.
    """

    def line(name: str, column: str, alias: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("class") == name, F.col(column))), F.lit(0.0)).alias(alias)

    report = class_report(scored, label, "prediction").agg(
        F.struct(
            line("accuracy", "recall", "accuracy"),
            *[line("weighted avg", c, f"weighted_{c}") for c in ("precision", "recall", "f1")],
            *[line("1", c, f"positive_{c}") for c in ("precision", "recall")],
        )
    )
    areas = ranking_areas(scored, label, score)
    return areas.select("auc_roc", "pr_auc", report.scalar().alias("_r")).select("auc_roc", "pr_auc", "_r.*")


def cross_validate(
    pipeline: Pipeline,
    grid: list[dict],
    train: DataFrame,
    evaluator,
    key: str,
    folds: int,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Grid search over folds that follow from the row key.

    ``train`` is read once per fold and grid point, so it should be a stored table.
    """
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        seed=42,
        parallelism=parallelism,
    )
    return validator.fit(with_fold(train, key, folds, seed=7))


def grid_table(spark: SparkSession, fitted: CrossValidatorModel, grid: list[dict], names: list[str]) -> DataFrame:
    """The mean metric of every grid point, and which one won."""
    best = max(range(len(grid)), key=lambda i: fitted.avgMetrics[i])
    rows = [
        (*[float({p.name: v for p, v in point.items()}[n]) for n in names], float(metric), i == best)
        for i, (point, metric) in enumerate(zip(grid, fitted.avgMetrics))
    ]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", metric double, best boolean")


def forest_importances(spark: SparkSession, model: PipelineModel, names: list[str]) -> DataFrame:
    """Importance per feature with its running share, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    upto = Window.orderBy(F.desc("importance"), "feature")
    return table.select("feature", "importance", F.row_number().over(upto).alias("rank"), F.sum("importance").over(upto).alias("running_share"))


def loan_features_pipeline(numeric: list[str], classifier: Estimator) -> Pipeline:
    return Pipeline(stages=[*scaled_features(numeric, centre=True), classifier])


def logistic(label: str) -> LogisticRegression:
    """L2 only; the inputs are already scaled."""
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=1000, elasticNetParam=0.0, standardization=False)


def boosted(label: str, rounds: int = 500, step: float = 0.05, depth: int = 6) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=rounds, stepSize=step, maxDepth=depth, seed=42, checkpointInterval=10
    )


def logistic_grid(numeric: list[str], train: DataFrame, label: str, key: str, strengths=(0.01, 0.1, 1.0, 10.0), folds: int = 5):
    """Regularisation by accuracy. ``C`` divides the summed loss, ``regParam`` the mean: 1 / (C * n).

    The models of all folds and strengths are fitted together, in passes they
    share; the winner is then fitted on all rows.
    """
    lr = logistic(label)
    pipeline = loan_features_pipeline(numeric, lr)
    n = train.count()
    grid = ParamGridBuilder().addGrid(lr.regParam, [1.0 / (c * n) for c in strengths]).build()
    means = grid_accuracy(with_fold(train, key, folds, seed=7), numeric, label, [point[lr.regParam] for point in grid], folds)
    return CrossValidatorModel(pipeline.fit(train, grid[int(np.argmax(means))]), avgMetrics=means), grid


def grouped_auc(scored: DataFrame, group: str, label: str, score: str) -> DataFrame:
    """Exact AUC-ROC per group: the share of pairs of both classes in the right order, ties counting half.

    Rows of one score are summed before they are ordered, so a group's window
    goes over its distinct scores.
    """
    by_score = scored.groupBy(group, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    below = Window.partitionBy(group).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    won = by_score.withColumn("_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    return won.groupBy(group).agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)),
            (F.sum("pos") * F.sum("neg")).cast("double"),
        ).alias("auc")
    )


def permutation_importance(
    model: PipelineModel, test: DataFrame, numeric: list[str], label: str, key: str
) -> DataFrame:
    """Loss of AUC when one input is shuffled, per input.

    The rows are first spread by the hash of their key, so that an Arrow batch
    is a random draw; each input is then shuffled within the batch. Sorted
    pieces and a seed from the batch make a retried task draw the same order.
    All shuffled copies are scored and measured in one job.
    """
    inputs = test.select(key, label, *[F.col(c).cast("double").alias(c) for c in numeric]).dropna()
    base = "(none)"

    def shuffled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            yield batch.assign(feature=base)
            order = np.random.default_rng(int(batch[key].iloc[0]) % (1 << 31))
            for name in numeric:
                yield batch.assign(**{name: order.permutation(batch[name].to_numpy())}, feature=name)

    spread = inputs.repartition(F.xxhash64(key)).sortWithinPartitions(F.xxhash64(key), key)
    copies = spread.mapInPandas(shuffled, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in inputs.schema)}, feature string")
    scored = model.transform(copies).select(
        "feature", label, F.element_at(vector_to_array("probability"), 2).alias("score")
    )
    aucs = grouped_auc(scored, "feature", label, "score")
    # One row per feature.
    baseline = Window.partitionBy()
    full = F.max(F.when(F.col("feature") == base, F.col("auc"))).over(baseline)
    return (
        aucs.withColumn("baseline_auc", full)
        .filter(F.col("feature") != base)
        .select("feature", "auc", (F.col("baseline_auc") - F.col("auc")).alias("importance"))
    )


def top_features(importances: DataFrame, n: int = 15) -> list[str]:
    rows = importances.orderBy(F.desc("importance"), F.asc("feature")).limit(n).collect()
    return [r["feature"] for r in rows]


