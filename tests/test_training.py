import math
import random

import pytest
from helpers import FORM_STATES, by, rows
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ledgerlens.operators import loans, training
from ledgerlens.operators.rates import fold_rates
from ledgerlens.operators.sampling import split
from ledgerlens.operators.transactions import NUMERIC_FEATURES
from ledgerlens.plans import fraud
from ledgerlens.sources.models import SavedModel, load_model, save_model

KINDS = ["TRANSFER", "CASH_OUT", "PAYMENT", "CASH_IN", "DEBIT"]


@pytest.fixture(scope="module")
def txn(spark):
    """Transactions whose fraud can be learned: large transfers that empty the account."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        kind, amount, old = rng.choice(KINDS), rng.uniform(1, 1000), rng.uniform(0, 1000)
        new = max(old - amount, 0.0)
        bad = int(kind in ("TRANSFER", "CASH_OUT") and new == 0.0 and amount > 500)
        data.append((i, i % 700, kind, amount, f"C{rng.randrange(400)}", old, new, f"M{i % 50}", 0.0, amount, bad, 0))
    return spark.createDataFrame(
        data,
        "txn_id bigint, step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
        "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int",
    )


@pytest.fixture(scope="module")
def infra(spark):
    data = [(s, str(d), str(a)) for s, (d, a, _) in FORM_STATES.items() if s != "isle"]
    return spark.createDataFrame(data, "`State/UT` string, `No. of PoS devices sanctioned` string, `Amount sanctioned in lakh` string")


@pytest.fixture(scope="module")
def trained(txn, infra):
    data = fraud.prepare(txn, list(FORM_STATES), infra)
    return data, fraud.fit(data, trees=20, depth=6)


def test_the_forest_learns(trained):
    data, model = trained
    scored = fraud.score_test(data, model).cache()
    metrics = training.binary_metrics(scored, "is_fraud", "fraud_probability").first()
    assert metrics["auc_roc"] > 0.97 and metrics["pr_auc"] > 0.8
    assert metrics["weighted_recall"] == pytest.approx(metrics["accuracy"])
    names = training.fraud_feature_names()
    table = training.forest_importances(scored.sparkSession, model, names)
    got = rows(table.orderBy("rank"))
    assert len(got) == 18 and sum(g["importance"] for g in got) == pytest.approx(1.0)
    assert got[-1]["running_share"] == pytest.approx(1.0)
    assert {"amount", "type_index"} & {g["feature"] for g in got[:5]}


def test_rates_are_fitted_without_the_test_rows(trained):
    data, _ = trained
    want = {r["state"]: r["m"] for r in data.train.groupBy("state").agg(F.avg("is_fraud").alias("m")).collect()}
    assert {r["state"]: r["fraud_rate"] for r in data.rates.collect()} == pytest.approx(want)


def test_validation_rows_are_neither_trained_nor_tested_on(txn, trained):
    data, model = trained
    parts = [{r["txn_id"] for r in side.select("txn_id").collect()} for side in (data.train, data.validation, data.test)]
    assert sum(len(p) for p in parts) == len(set().union(*parts)) == txn.count()
    assert len(parts[1]) == pytest.approx(0.08 * 3000, rel=0.25)
    assert {r["txn_id"] for r in data.balanced.select("txn_id").collect()} <= parts[0]
    threshold = fraud.choose_threshold(data, model)
    scores = [(r["is_fraud"], r["fraud_probability"]) for r in fraud.score_held_out(data.validation, model).collect()]

    def f1(t):
        tp = sum(y == 1 and p >= t for y, p in scores)
        wrong = sum((p >= t) != (y == 1) for y, p in scores)
        return 2 * tp / (2 * tp + wrong) if tp else 0.0

    assert f1(threshold) == pytest.approx(max(f1(i / 10) for i in range(2, 10)))


def test_saved_model_scores_new_rows_like_the_fitted_one(spark, txn, trained, tmp_path):
    data, model = trained
    path = str(tmp_path / "model")
    save_model(spark, SavedModel(model, 0.4, training.fraud_feature_names(), {}, list(FORM_STATES), "", data.rates), path)
    saved = load_model(spark, path)
    _, test = split(txn, "txn_id")
    new = test.drop("isFraud", "isFlaggedFraud")
    got = by(fraud.score(new, saved.states, data.infra, saved.rates, saved.model, saved.threshold, ["txn_id"]), "txn_id")
    want = by(fraud.score_test(data, model, 0.4), "txn_id")
    assert len(got) == len(want) and set(got[next(iter(got))]) == {"txn_id", *fraud.SCORED_COLUMNS}
    for key, row in got.items():
        assert row["fraud_probability"] == pytest.approx(want[key]["fraud_probability"], abs=1e-12)
        assert row["fraud_flag"] == int(row["fraud_probability"] >= 0.4)


def test_batches_of_both_kinds_score_the_same(txn, trained):
    data, model = trained
    _, test = split(txn, "txn_id")
    args = (list(FORM_STATES), data.infra, data.rates, model, 0.5)
    raw = rows(fraud.score_batch(test.drop("isFraud", "isFlaggedFraud"), *args))
    codes = {k: i for i, k in enumerate(KINDS)}
    engineered = data.test.withColumn(
        "type_index", F.create_map(*[F.lit(x) for k, i in codes.items() for x in (k, i)])[F.col("type")]
    ).drop("type", "state")
    done = rows(fraud.score_batch(engineered, *args))
    assert {d["state"] for d in done} == {"N/A"} and len(done) == len(raw)
    key = lambda r: (r["nameOrig"], r["amount"])
    assert {key(r): round(r["fraud_probability"], 9) for r in raw} == {key(r): round(r["fraud_probability"], 9) for r in done}
    assert {key(r): r["type"] for r in raw} == {key(r): r["type"] for r in done}


def test_unknown_types_are_scored_and_missing_numbers_skipped(spark, trained):
    data, model = trained
    odd = data.test.limit(3).withColumn("type", F.lit("NEW"))
    assert model.transform(odd).count() == 3
    holes = odd.withColumn("amount", F.when(F.monotonically_increasing_id() == 0, None).otherwise(F.col("amount")))
    skipped = training.skipped_count(holes, NUMERIC_FEATURES).first()
    assert (skipped["n_rows"], skipped["skipped"]) == (3, 3 - model.transform(holes).count())


def test_grid_search_uses_rates_of_the_unbalanced_rows(trained, tmp_path):
    data, _ = trained
    found = fraud.grid_search(data.train, "txn_id", trees=(2, 5), depths=(2, 4))
    table = rows(found.table)
    assert len(table) == 4 and sum(t["best"] for t in table) == 1
    assert max(t["metric"] for t in table) == next(t["metric"] for t in table if t["best"]) > 0.8
    assert {(t["numTrees"], t["maxDepth"]) for t in table} == {(2, 2), (2, 4), (5, 2), (5, 4)}
    found.model.write().overwrite().save(str(tmp_path / "winner"))
    again = PipelineModel.load(str(tmp_path / "winner"))
    assert again.transform(data.test).count() == found.model.transform(data.test).count()


def test_fold_rates(spark):
    data = [(i % 3, "AB"[i % 2] if i % 7 else None, int(i % 5 == 0)) for i in range(200)] + [(1, "only", 1)]
    found = {(r["fold"], r["state"]): r["fraud_rate"] for r in fold_rates(spark.createDataFrame(data, "fold int, state string, is_fraud int")).collect()}
    want = {}
    for fold in range(3):
        for state in ("A", "B", None, "only"):
            rest = [y for f, s, y in data if f != fold and s == state]
            if rest:
                want[fold, state] = sum(rest) / len(rest)
    assert found == pytest.approx(want)


def test_every_row_is_scored_or_says_why_not(spark, txn, trained):
    data, model = trained
    given = txn.drop("isFraud", "isFlaggedFraud").withColumn("amount", F.when(F.col("txn_id") % 10 > 0, F.col("amount")))
    got = rows(fraud.score(given, list(FORM_STATES), data.infra, data.rates, model, 0.5, ["txn_id"]))
    assert len(got) == 3000
    assert all((g["fraud_probability"] is None) == (g["txn_id"] % 10 == 0) == (g["fraud_flag"] is None) for g in got)


def auc_by_pairs(data):
    pos, neg = [p for y, p in data if y == 1], [p for y, p in data if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_grouped_auc(spark):
    rng = random.Random(3)
    data = [(g, int(rng.random() < 0.4), rng.randrange(0, 1001) / 1000) for g in "ab" for _ in range(300)]
    got = by(training.grouped_auc(spark.createDataFrame(data, "g string, y int, p double"), "g", "y", "p"), "g")
    for g in "ab":
        assert got[g]["auc"] == pytest.approx(auc_by_pairs([(y, p) for k, y, p in data if k == g]))


@pytest.fixture(scope="module")
def applications(spark):
    rng = random.Random(9)
    data = []
    for i in range(1200):
        income, amount, credit = rng.uniform(150, 9000), rng.uniform(9, 600), float(rng.random() < 0.8)
        good = int(credit == 1.0 and income / amount > 8)
        data.append((i, 1.0, 0.0, 1.0, 1, 0.0, int(income), 0.0, amount, 360.0, credit, rng.randrange(3), good))
    return loans.loan_features(spark.createDataFrame(data, loans.LOAN_SCHEMA))


def test_loans(applications):
    train, test = split(applications, "loan_id")
    train, test = fraud.training_table(train, "loan_id"), test.cache()
    model, line = loans.fit_and_measure("boosted", training.boosted("Loan_Status", 10, 0.1, 4), loans.LOAN_FEATURES, train, test)
    assert line.first()["accuracy"] > 0.95 and line.first()["n_features"] == 16
    decided = rows(loans.loan_decision(model, test))
    for d in decided:
        assert d["prediction_binary"] == int(d["approval_probability"] >= 0.4706)
        assert d["loan_status"] == ("Approved" if d["prediction_binary"] else "Rejected")
        assert d["confidence"] == pytest.approx(max(d["approval_probability"], 1 - d["approval_probability"]))
    found = training.permutation_importance(model, test, loans.LOAN_FEATURES, "Loan_Status", "loan_id")
    got = by(found, "feature")
    assert len(got) == 16
    top = training.top_features(found, 2)
    assert "Credit_History" in top or "Income_to_Loan_Ratio" in top
    assert got["Gender"]["importance"] == pytest.approx(0.0)


def test_logistic_grid(applications):
    train = fraud.training_table(applications, "loan_id")
    fitted, grid = training.logistic_grid(loans.LOAN_FEATURES, train, "Loan_Status", "loan_id", strengths=(0.01, 10.0), folds=3)
    table = rows(training.grid_table(train.sparkSession, fitted, grid, ["regParam"]))
    assert [t["regParam"] for t in table] == pytest.approx([1 / (0.01 * 1200), 1 / (10 * 1200)])
    assert all(0.5 < t["metric"] <= 1.0 and not math.isnan(t["metric"]) for t in table)


def test_a_saved_scorer_needs_nothing_else(spark, txn, trained, tmp_path):
    data, model = trained
    path = str(tmp_path / "scorer")
    fraud.save_scorer(data, model, 0.3, path, {"auc_roc": 0.9}, "2")
    saved = load_model(spark, path)
    assert (saved.version, saved.model_type, saved.metrics) == ("2", "RandomForestClassificationModel", {"auc_roc": 0.9})
    assert sum(saved.importances.values()) == pytest.approx(1) and set(saved.importances) == set(training.fraud_feature_names())
    new = txn.drop("isFraud", "isFlaggedFraud")
    want = by(fraud.score(new, data.states, data.infra, data.rates, model, 0.3, ["txn_id"]), "txn_id")
    assert by(fraud.score_saved(path, new, ["txn_id"]), "txn_id") == want
    save_model(spark, SavedModel(model, 0.4, rates=data.rates), path + "-bare")
    with pytest.raises(ValueError):
        fraud.score_saved(path + "-bare", new)


def test_result_tables(spark, trained, tmp_path):
    data, model = trained
    scored = fraud.score_test(data, model).select(
        "state", "amount", "is_fraud", "fraud_probability", "total_gov_amount_lakh", "total_pos_devices"
    )
    tables = fraud.result_tables(scored, str(tmp_path))
    assert tables["scored"].count() == scored.count() and tables["state_summary"].count() == scored.select("state").distinct().count()
    assert sum(r["total_txns"] for r in tables["tier_distribution"].collect()) == scored.count()


def test_grid_prepares_a_fold_once_and_has_exact_areas(trained, monkeypatch):
    data, _ = trained
    fits, areas = [], []
    fit, evaluate = StringIndexer.fit, fraud.BinaryClassificationEvaluator.evaluate
    monkeypatch.setattr(StringIndexer, "fit", lambda self, *args: fits.append(1) or fit(self, *args))

    def kept(self, scored):
        area = evaluate(self, scored)
        pairs = [(r["is_fraud"], float(r["rawPrediction"][1])) for r in scored.select("is_fraud", "rawPrediction").collect()]
        areas.append((area, auc_by_pairs(pairs)))
        return area

    monkeypatch.setattr(fraud.BinaryClassificationEvaluator, "evaluate", kept)
    found = fraud.grid_search(data.train, "txn_id", trees=(2, 5), depths=(2, 4))
    # Three folds and the winner, not four points of each fold.
    assert len(fits) == 3 + 1 and len(areas) == 12
    assert [a for a, _ in areas] == pytest.approx([b for _, b in areas], abs=1e-9)
    again = fraud.grid_search(data.train, "txn_id", trees=(2, 5), depths=(2, 4))
    assert rows(again.table) == rows(found.table)
