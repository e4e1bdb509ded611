"""The fraud plan from raw transactions to scored ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import TYPE_CODES
from ledgerlens.operators.infrastructure import infra_by_state, normalise_infra
from ledgerlens.operators.loans import at_once
from ledgerlens.operators.metrics import best_threshold, threshold_sweep
from ledgerlens.operators.quality import dedup_full, state_summary, tier_distribution
from ledgerlens.operators.rates import attach_rate, fit_rate, fold_rates
from ledgerlens.operators.sampling import balanced_train, split, with_fold
from ledgerlens.operators.training import forest, fraud_feature_names, fraud_pipeline, with_probability
from ledgerlens.operators.transactions import NUMERIC_FEATURES, detect_input, enrich, rename_labels, txn_features
from ledgerlens.plans.lookup import NumberedStates, as_lookup, assign_state, number_states
from ledgerlens.session import written
from ledgerlens.sources.models import SavedModel, load_model, save_model
from ledgerlens.sources.tables import save

SCORED_COLUMNS = ["nameOrig", "amount", "type", "state", "fraud_probability", "fraud_flag"]


@dataclass
class Training:
    """Stored feature tables and what was fitted on them."""

    train: DataFrame
    validation: DataFrame
    test: DataFrame
    balanced: DataFrame
    rates: DataFrame
    infra: DataFrame
    states: NumberedStates


def training_table(df: DataFrame, key: str) -> DataFrame:
    """Store rows for an iterative fit, in even pieces: every pass then uses all cores.

    Sorted pieces make the bootstrap draws of a forest the same in every run.
    """
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartition(pieces, key).sortWithinPartitions(key), "training")


def state_infra(raw_infra: DataFrame) -> DataFrame:
    """Totals per state, stored as a lookup table."""
    return as_lookup(infra_by_state(normalise_infra(raw_infra)), "infra")


def features(txn: DataFrame, states: DataFrame | list[str] | NumberedStates, infra: DataFrame) -> DataFrame:
    """Assign, enrich and derive. Only joins to lookup tables: works on streams too."""
    return txn_features(enrich(assign_state(rename_labels(txn), "nameOrig", states), infra))


def prepare(
    txn: DataFrame,
    states: DataFrame | list[str] | NumberedStates,
    raw_infra: DataFrame,
    key: str = "txn_id",
    validation: float = 0.1,
) -> Training:
    """Features, split, rates from the training rows, and the balanced training set.

    A fifth of the rows is for testing. ``validation`` is the share of the
    others that is kept from training to choose the threshold on, so that the
    test rows stay unseen. The features are stored once; rates, balancing,
    fitting and testing read them instead of repeating the joins.
    """
    infra, states = state_infra(raw_infra), number_states(states, txn.sparkSession)
    # Repeated rows of the log are one row, so that no copy of a training row is tested on.
    stored = written(dedup_full(features(txn, states, infra)), "features")
    known, test = split(stored, key)
    train, checked = split(known, key, 1 - validation, seed=142)
    rates = as_lookup(fit_rate(train), "rates")
    train, checked, test = (attach_rate(side, rates) for side in (train, checked, test))
    return Training(train, checked, test, training_table(balanced_train(train, key), key), rates, infra, states)


def fit(training: Training, trees: int = 100, depth: int = 10) -> PipelineModel:
    return fraud_pipeline(trees, depth).fit(training.balanced)


@dataclass
class GridSearch:
    """The winner of a grid, fitted on all rows, and the mean area of every point."""

    model: PipelineModel
    table: DataFrame


def grid_search(train: DataFrame, key: str, trees=(50, 100), depths=(5, 10), folds: int = 3) -> GridSearch:
    """Forest size and depth by cross-validated AUC.

    Folds are assigned on the unbalanced training rows. A fold's state rates
    come from the other folds' rows, all of them; only then is the training
    part balanced, and the measured part stays as it is. ``train`` is a stored
    table of prepared rows. Folds are prepared, and forests grown, a few at once.
    """
    spark = train.sparkSession
    bare = train.drop("fraud_rate", "high_fraud_state_flag")
    folded = with_fold(bare, key, folds, seed=7)
    rates = as_lookup(fold_rates(folded), "fold-rates")
    # Without bins: their edges would follow from the order in which jobs begin.
    evaluator = BinaryClassificationEvaluator(labelCol="is_fraud", rawPredictionCol="rawPrediction", numBins=0)

    def sides(fold: int) -> tuple[DataFrame, DataFrame]:
        own = rates.filter(F.col("fold") == fold).drop("fold")
        learn = training_table(balanced_train(attach_rate(folded.filter(F.col("fold") != fold), own), key), key)
        tested = written(attach_rate(folded.filter(F.col("fold") == fold), own), "fold-tested")
        # Index and scaling don't depend on the point: the forests of a fold share them.
        ready = Pipeline(stages=fraud_pipeline().getStages()[:-1]).fit(learn)
        return ready.transform(learn), ready.transform(tested)

    def area(side: tuple[DataFrame, DataFrame], t: int, d: int) -> float:
        learn, tested = side
        return evaluator.evaluate(forest("is_fraud", t, d).fit(learn).transform(tested))

    prepared = at_once(spark, [partial(sides, fold) for fold in range(folds)])
    # The largest forests begin, so that no core waits for one of them at the end.
    order = sorted(((t, d) for t in trees for d in depths), key=lambda point: point[0] * 2 ** point[1], reverse=True)
    found = at_once(spark, [partial(area, side, *point) for point in order for side in prepared])
    areas = {point: found[order.index(point) * folds :][:folds] for point in ((t, d) for t in trees for d in depths)}
    means = {point: sum(found) / len(found) for point, found in areas.items()}
    best = max(means, key=means.get)
    lines = [(float(t), float(d), float(m), (t, d) == best) for (t, d), m in means.items()]
    table = spark.createDataFrame(lines, "numTrees double, maxDepth double, metric double, best boolean")
    whole = attach_rate(bare, as_lookup(fit_rate(bare), "rates"))
    return GridSearch(fraud_pipeline(*best).fit(training_table(balanced_train(whole, key), key)), table)


def score(
    txn: DataFrame,
    states: DataFrame | list[str] | NumberedStates,
    infra: DataFrame,
    rates: DataFrame,
    model: PipelineModel,
    threshold: float,
    keep: list[str] = (),
) -> DataFrame:
    """Score raw transactions, batch or stream; every row given comes back.

    A row with a missing or NaN input can't be scored: its probability and flag
    are NULL. States that aren't numbered yet are numbered while the plan is
    built.
    """
    ready = attach_rate(features(txn, states, infra), rates)
    return score_ready(ready, model, threshold).select(*keep, *SCORED_COLUMNS)


def score_ready(ready: DataFrame, model: PipelineModel, threshold: float) -> DataFrame:
    """Add probability and flag to rows with features; NULL where an input is missing."""
    usable = F.lit(True)
    for name in NUMERIC_FEATURES:
        usable = usable & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    # A stand-in lets the row through the model; what the model says of it is not used.
    filled = ready.withColumn("_usable", usable).withColumns(
        {f"_given_{c}": F.col(c) for c in NUMERIC_FEATURES}
        | {c: F.when(usable, F.col(c)).otherwise(F.lit(0).cast(ready.schema[c].dataType)) for c in NUMERIC_FEATURES}
    )
    scored = with_probability(model.transform(filled), threshold)
    scored = scored.withColumn("fraud_probability", F.when(F.col("_usable"), F.col("fraud_probability")))
    scored = scored.withColumn("fraud_flag", F.when(F.col("_usable"), F.col("prediction").cast("int")))
    given = {c: F.col(f"_given_{c}") for c in NUMERIC_FEATURES}
    return scored.withColumns(given).drop("_usable", *[f"_given_{c}" for c in NUMERIC_FEATURES])


def score_batch(
    df: DataFrame,
    states: DataFrame | list[str] | NumberedStates,
    infra: DataFrame,
    rates: DataFrame,
    model: PipelineModel,
    threshold: float,
) -> DataFrame:
    """Score an uploaded batch, raw or with its features already computed.

    A batch with features goes to the model as it is. Where it has only the
    fixed type code, the type is read back from it, since the model indexes
    types by itself.
    """
    if detect_input(df) == "raw":
        return score(df, states, infra, rates, model, threshold)
    if "type" not in df.columns:
        names = F.create_map(*[F.lit(x) for name, code in TYPE_CODES.items() for x in (code, name)])
        df = df.withColumn("type", F.try_element_at(names, F.col("type_index").cast("int")))
    for name, default in (("state", F.lit("N/A")), ("nameOrig", F.lit(None).cast("string"))):
        if name not in df.columns:
            df = df.withColumn(name, default)
    return score_ready(df.drop("type_index"), model, threshold).select(*SCORED_COLUMNS)


def save_scorer(training: Training, model: PipelineModel, threshold: float, path: str, metrics: dict[str, float] | None = None, version: str = "1") -> None:
    """Write all that ``score_saved`` needs: pipeline, threshold, rates, infrastructure, states, and what is known of the model."""
    spark = training.rates.sparkSession
    names = fraud_feature_names()
    importances = {n: float(v) for n, v in zip(names, model.stages[-1].featureImportances.toArray())}
    states = [r["state"] for r in training.states.table.orderBy("_bucket").collect()]
    saved = SavedModel(model, threshold, names, metrics or {}, states, "", training.rates, training.infra, importances, version, type(model.stages[-1]).__name__)
    save_model(spark, saved, path)


def score_saved(path: str, txn: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Score raw transactions, batch or stream, with a saved model and the states, infrastructure, rates and threshold beside it."""
    saved = load_model(txn.sparkSession, path)
    if saved.infra is None:
        raise ValueError("the model was saved without its infrastructure")
    return score(txn, saved.states, saved.infra, saved.rates, saved.model, saved.threshold, keep)


def result_tables(scored: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write the three tables of a scored log: the rows, the summary by state, and the distribution of tiers.

    ``scored`` has the label and the state's infrastructure besides the scores.
    """
    tables = {"scored": scored}
    save(scored, f"{path}/scored")
    held = scored.sparkSession.read.schema(scored.schema).parquet(f"{path}/scored")
    tables["state_summary"] = state_summary(held)
    save(tables["state_summary"], f"{path}/state_summary")
    summary = scored.sparkSession.read.parquet(f"{path}/state_summary")
    tables["tier_distribution"] = tier_distribution(summary)
    save(tables["tier_distribution"], f"{path}/tier_distribution")
    return {name: scored.sparkSession.read.parquet(f"{path}/{name}") for name in tables}


def score_held_out(rows: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """Prepared rows with their label, features and probability."""
    return with_probability(model.transform(rows), threshold)


def score_test(training: Training, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    return score_held_out(training.test, model, threshold)


def choose_threshold(training: Training, model: PipelineModel) -> float:
    """The sweep's best threshold on the validation rows."""
    scored = score_held_out(training.validation, model).select("is_fraud", "fraud_probability")
    return best_threshold(threshold_sweep(scored)).first()["threshold"]
