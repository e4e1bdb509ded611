"""Queries that fit models, and their streaming counterparts."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.operators import loans, training
from ledgerlens.operators.boosting import Settings, bin_rows, boost
from ledgerlens.operators.explain import explained, mean_shares
from ledgerlens.operators.metrics import pr_threshold
from ledgerlens.operators.rates import attach_rate, fit_rate, ordered_rates
from ledgerlens.operators.sampling import split, stratified_split
from ledgerlens.operators.transactions import detect_input
from ledgerlens.plans import fraud
from ledgerlens.session import scratch_path, written
from ledgerlens.sources import roles
from ledgerlens.sources.models import load_model
from ledgerlens.sources.roles import load
from ledgerlens.streaming import scoring, state
from ledgerlens.suite import sql
from ledgerlens.suite.common import Query, featured, rounded, txn_with_state
from ledgerlens.suite.fraud import FEATURES
from ledgerlens.suite.fraud import ORACLE as FRAUD_ORACLE

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def prepared(spark, d) -> fraud.Training:
    return fraud.prepare(roles.txn(spark, d), roles.states(spark, d), roles.infra(spark, d))


def fraud_score(spark, d, trees: int = 100, depth: int = 10):
    """Fit on the labelled transactions, choose the threshold on validation rows, score the whole log."""
    data = prepared(spark, d)
    model = fraud.fit(data, trees, depth)
    threshold = fraud.choose_threshold(data, model)
    log = roles.txn(spark, d, labels=False)
    return fraud.score(log, data.states, data.infra, data.rates, model, threshold, ["txn_id"])


QUERIES["fraud_score"] = fraud_score


def _model_metrics(spark, d):
    data = prepared(spark, d)
    scored = fraud.score_test(data, fraud.fit(data)).select("is_fraud", "fraud_probability", "prediction")
    return training.binary_metrics(written(scored, "tested"), "is_fraud", "fraud_probability")


QUERIES["model_metrics"] = _model_metrics

QUERIES["feature_importance"] = lambda spark, d: training.forest_importances(
    spark, fraud.fit(prepared(spark, d)), training.fraud_feature_names()
)


def _cv_grid(spark, d):
    data = prepared(spark, d)
    return fraud.grid_search(data.train, "txn_id").table


QUERIES["cv_grid"] = _cv_grid


def _loan_sides(spark, d):
    """Stored training and test applications, the classes in equal shares."""
    rows = written(loans.loan_features(roles.loan_app(spark, d)), "loans")
    return stratified_split(rows, "loan_id", "Loan_Status")


def _loan_lr(spark, d):
    train, _ = _loan_sides(spark, d)
    fitted, grid = training.logistic_grid(loans.LOAN_FEATURES, fraud.training_table(train, "loan_id"), "Loan_Status", "loan_id")
    return training.grid_table(spark, fitted, grid, ["regParam"])


QUERIES["loan_lr"] = _loan_lr


def _loan_gbt(spark, d, rounds: int = 50):
    """Boosted trees, the threshold from the precision-recall curve of validation rows, and all decisions."""
    known, _ = _loan_sides(spark, d)
    train, checked = split(known, "loan_id", 0.9, seed=142)
    classifier = training.boosted("Loan_Status", rounds, step=0.1)
    model = training.loan_features_pipeline(loans.LOAN_FEATURES, classifier).fit(fraud.training_table(train, "loan_id"))
    rated = training.with_probability(model.transform(checked), 0.5, "score").select("Loan_Status", "score")
    threshold = pr_threshold(rated, "Loan_Status", "score").first()["threshold"]
    everyone = loans.loan_features(roles.loan_app(spark, d))
    return loans.loan_decision(model, everyone, threshold)


QUERIES["loan_gbt"] = _loan_gbt


def _importances(train, test):
    model = training.loan_features_pipeline(loans.LOAN_FEATURES, training.boosted("Loan_Status", 20, 0.1, 5)).fit(train)
    return training.permutation_importance(model, test, loans.LOAN_FEATURES, "Loan_Status", "loan_id")


def _feature_select(spark, d):
    train, test = _loan_sides(spark, d)
    return _importances(fraud.training_table(train, "loan_id"), test).orderBy(F.desc("importance"), "feature").limit(15)


QUERIES["feature_select"] = _feature_select

# Rounds of the registered boosters; their settings' default is 500. README has time and accuracy of both.
ROUNDS = 10
SYMMETRIC = Settings(rounds=ROUNDS, step=0.2, depth=6)
LEAF_WISE = Settings(rounds=ROUNDS, step=0.2, leaves=31, l2=0.0, top=0.2, other=0.1)


def _shap_select(spark, d):
    """The inputs with the largest mean absolute Shapley share on the test rows, for symmetric boosted trees."""
    train, test = _loan_sides(spark, d)
    model = boost(fraud.training_table(train, "loan_id"), loans.LOAN_FEATURES, "Loan_Status", "loan_id", SYMMETRIC)
    return mean_shares(model.shares(test, []), model.features).filter("rank <= 15")


QUERIES["shap_select"] = _shap_select


def _shap_sums(spark, d):
    """Shares of a forest and of boosted trees over the test rows: how many rows, and whether all sums are right."""
    train, test = (fraud.training_table(side, "loan_id") for side in _loan_sides(spark, d))
    label, lines = "Loan_Status", []
    for name, kind in (("forest", training.forest(label, 20, 6, None)), ("boosted trees", training.boosted(label, 10, 0.1, 5))):
        model = training.loan_features_pipeline(loans.LOAN_FEATURES, kind).fit(train)
        off = F.abs(F.aggregate("shares", F.lit(0.0), lambda a, x: a + x) - (col("score") - col("base")))
        shares = explained(model, test, [])
        lines.append(shares.agg(F.lit(name).alias("model"), F.count("*").alias("n_rows"), (F.max(off) < 1e-9).alias("sums_match")))
    return lines[0].unionByName(lines[1])


QUERIES["shap_sums"] = _shap_sums
_TEST_ROWS = f"""apps AS (SELECT o_orderkey AS loan_id, CASE WHEN o_orderstatus <> 'F' AND o_totalprice < 420000 THEN 1 ELSE 0 END AS label
    FROM orders JOIN customer ON o_custkey = c_custkey),
sided AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY {sql.word("loan_id", 42)}, loan_id)
    > round(0.8::DOUBLE * count(*) OVER (PARTITION BY label)) AS is_test FROM apps)"""
ORACLE["shap_sums"] = sql.query(
    """SELECT model, count(*) AS n_rows, true AS sums_match FROM sided, (VALUES ('forest'), ('boosted trees')) AS m(model)
    WHERE is_test GROUP BY model""",
    _TEST_ROWS,
)


def _boosting_learns(spark, d):
    """Both histogram boosters on applications whose outcome follows from two inputs: are nearly all test rows right?"""
    train, test = (fraud.training_table(side, "loan_id") for side in _loan_sides(spark, d))
    kinds = (("symmetric trees", SYMMETRIC), ("leaf-wise trees", LEAF_WISE))
    ready = bin_rows(train, loans.LOAN_FEATURES, "Loan_Status", "loan_id", SYMMETRIC.bins)
    fitted = loans.at_once(spark, [partial(loans.boost_and_measure, name, kind, loans.LOAN_FEATURES, train, test, ready=ready) for name, kind in kinds])
    lines = [line.select("model", "n_features", ((col("accuracy") > 0.97) & (col("auc_roc") > 0.97)).alias("learns")) for _, line in fitted]
    return lines[0].unionByName(lines[1])


QUERIES["boosting_learns"] = _boosting_learns
ORACLE["boosting_learns"] = """SELECT model, CAST(16 AS INTEGER) AS n_features, true AS learns
FROM (VALUES ('symmetric trees'), ('leaf-wise trees')) AS m(model)"""

QUERIES["ordered_rates"] = lambda spark, d: rounded(
    ordered_rates(txn_with_state(spark, d, labels=True), "state", "is_fraud", "txn_id").select("txn_id", "state", "is_fraud", "ordered_rate"), 9
)
ORACLE["ordered_rates"] = sql.query(
    f"""SELECT txn_id, state, is_fraud, round((coalesce(sum(is_fraud) OVER w, 0) + (SELECT avg(is_fraud) FROM txn)) / (count(*) OVER w + 1), 9) AS ordered_rate
    FROM txn_state WINDOW w AS (PARTITION BY state ORDER BY {sql.word("txn_id", 42)}, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    sql.TXN, sql.STATES,
)


def _model_compare(spark, d):
    """Eight models by accuracy, areas, precision, recall and F1: on all inputs, and on those with the largest Shapley shares."""
    train, test = (fraud.training_table(side, "loan_id") for side in _loan_sides(spark, d))
    every, label = loans.LOAN_FEATURES, "Loan_Status"
    # What several models need of the rows: inputs in bins, and their scaling.
    ready, scaling = loans.at_once(spark, [
        partial(bin_rows, train, every, label, "loan_id", SYMMETRIC.bins),
        partial(Pipeline(stages=training.scaled_features(every, centre=True)).fit, train),
    ])

    def trained(name, classifier, features):
        return partial(loans.fit_and_measure, name, classifier, features, train, test, scaling=scaling if features == every else None)

    def grown(name, settings, features):
        return partial(loans.boost_and_measure, name, settings, features, train, test, ready=ready)

    (symmetric, line), *others = loans.at_once(spark, [
        grown("symmetric trees", SYMMETRIC, every),
        grown("leaf-wise trees", LEAF_WISE, every),
        trained("boosted trees", training.boosted(label, 20, 0.1, 5), every),
        trained("random forest", training.forest(label, 50, 8, None), every),
        trained("logistic regression", training.logistic(label), every),
    ])
    chosen = training.top_features(mean_shares(symmetric.shares(test, []), every), 10)
    selected = loans.at_once(spark, [
        trained("random forest, selected", training.forest(label, 50, 8, None), chosen),
        grown("leaf-wise trees, selected", LEAF_WISE, chosen),
        grown("symmetric trees, selected", SYMMETRIC, chosen),
    ])
    lines = [line, *[found for _, found in (*others, *selected)]]
    table = lines[0]
    for line in lines[1:]:
        table = table.unionByName(line)
    return table


QUERIES["model_compare"] = _model_compare


def _scores_agree(spark, d):
    """One model's scores of the whole log: fitted, saved and loaded again, and on a stream. How many rows, and how many differ.

    A flag is right if it is set exactly where the probability reaches the threshold.
    """
    data = prepared(spark, d)
    model = fraud.fit(data, 10, 5)
    threshold = fraud.choose_threshold(data, model)
    log = roles.txn(spark, d, labels=False)
    path = scratch_path(spark, "saved-scorer")
    fraud.save_scorer(data, model, threshold, path)
    stream = scoring.drain_to_table(fraud.score_saved(path, _stream_input(spark, d), ["txn_id"]), "scored")
    ways = {
        "fitted": written(fraud.score(log, data.states, data.infra, data.rates, model, threshold, ["txn_id"]), "scored"),
        "saved": fraud.score_saved(path, log, ["txn_id"]), "stream": stream,
    }
    p = F.col("fraud_probability")
    base = ways["fitted"].select("txn_id", F.round(p, 9).alias("_p"))
    lines = []
    for name, scored in ways.items():
        met = base.join(scored, "txn_id", "full_outer")
        wrong = ~F.round(p, 9).eqNullSafe(F.col("_p")) | ~F.col("fraud_flag").eqNullSafe((p >= threshold).cast("int"))
        lines.append(met.agg(F.lit(name).alias("way"), F.count("*").alias("n_rows"), F.count_if(wrong).alias("n_wrong")))
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


QUERIES["scores_agree"] = _scores_agree
ORACLE["scores_agree"] = sql.query(
    "SELECT way, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_wrong FROM txn, (VALUES ('fitted'), ('saved'), ('stream')) AS w(way) GROUP BY way", sql.TXN
)


def _model_roundtrip(spark, d):
    """What is saved beside a model and read again."""
    data = prepared(spark, d)
    path = scratch_path(spark, "saved-model")
    fraud.save_scorer(data, fraud.fit(data, 5, 3), 0.4, path, {"auc": 0.5}, "7")
    saved = load_model(spark, path)
    shares = sum(saved.importances.values())
    row = (saved.version, saved.model_type, saved.threshold, len(saved.features), len(saved.importances), abs(shares - 1) < 1e-6, saved.metrics["auc"])
    line = spark.createDataFrame([row], "version string, model_type string, threshold double, n_features int, n_importances int, sums_to_one boolean, auc double")
    counts = saved.infra.agg(F.count("*").alias("infra_rows")), data.states.table.agg(F.count("*").alias("states"))
    return line.withColumns({c.columns[0]: c.scalar() for c in counts}).withColumn("states_saved", F.lit(len(saved.states)).cast("long"))


QUERIES["model_roundtrip"] = _model_roundtrip
ORACLE["model_roundtrip"] = sql.query(
    """SELECT '7' AS version, 'RandomForestClassificationModel' AS model_type, CAST(0.4 AS DOUBLE) AS threshold, CAST(18 AS INTEGER) AS n_features,
    CAST(18 AS INTEGER) AS n_importances, true AS sums_to_one, CAST(0.5 AS DOUBLE) AS auc, (SELECT count(*) FROM infra) AS infra_rows,
    (SELECT n FROM state_names) AS states, (SELECT n FROM state_names) AS states_saved""",
    sql.TXN, sql.STATES, sql.INFRA,
)


def _input_kind(spark, d):
    """Which kind of input the raw log, the log with features, and another table are taken for."""
    log, given = roles.txn(spark, d, labels=False), featured(spark, d)
    tables = {"raw": log, "features": attach_rate(given, fit_rate(given)).withColumn("type_index", F.lit(0)), "other": load(spark, "region", d)}
    lines = None
    for name, table in tables.items():
        try:
            kind = detect_input(table)
        except ValueError:
            kind = "error"
        line = table.agg(F.lit(name).alias("given"), F.lit(kind).alias("kind"), F.count("*").alias("n_rows"))
        lines = line if lines is None else lines.unionByName(line)
    return lines


QUERIES["input_kind"] = _input_kind
ORACLE["input_kind"] = sql.query(
    """SELECT 'raw' AS given, 'raw' AS kind, count(*) AS n_rows FROM txn
    UNION ALL SELECT 'features', 'engineered', count(*) FROM txn UNION ALL SELECT 'other', 'error', count(*) FROM region""",
    sql.TXN,
)

# Streams.


def _stream_input(spark, d):
    schema = load(spark, "orders", d).schema
    orders = scoring.read_files(spark, d, schema, "orders.parquet")
    return roles.orders_as_txn(orders, spark, d).drop("_status")


def _stream_score(spark, d):
    data = prepared(spark, d)
    model = fraud.fit(data)
    threshold = fraud.choose_threshold(data, model)
    stream = scoring.score_stream(_stream_input(spark, d), data.states, data.infra, data.rates, model, threshold, ["txn_id"])
    return scoring.drain_to_table(stream, "scored")


QUERIES["stream_score"] = _stream_score


def _stream_mix(spark, d):
    schema = load(spark, "events", d).schema
    events = scoring.read_files(spark, d, schema, "events.parquet")
    history = events.select(F.when(col("event_type") == "error", "FRAUD").otherwise("SAFE").alias("prediction"))
    return scoring.drain_counts(scoring.stream_mix(history), f"mix_{uuid.uuid4().hex[:8]}")


QUERIES["stream_mix"] = _stream_mix
ORACLE["stream_mix"] = """SELECT CASE WHEN event_type = 'error' THEN 'FRAUD' ELSE 'SAFE' END AS prediction,
count(*) AS n FROM events GROUP BY 1"""


def _stream_features(spark, d):
    """The scorer's inputs computed on a stream: assignment, enrichment and features."""
    infra = fraud.state_infra(roles.infra(spark, d))
    rows = rounded(fraud.features(_stream_input(spark, d), roles.states(spark, d), infra).select(*FEATURES))
    return scoring.drain_to_table(rows, "stream-features")


QUERIES["stream_features"] = _stream_features
ORACLE["stream_features"] = FRAUD_ORACLE["txn_features"]


def _stream_dedup(spark, d):
    """A log whose rows come again, within a part and late in the next one, each row once."""
    events = load(spark, "events", d).select("event_id", "ts", "user_id", "event_type", "value")
    folder, table, out = scratch_path(spark, "log"), scratch_path(spark, "log-once"), None
    slices = [events.filter(f"dayofmonth(ts) {bound}") for bound in ("<= 10", "between 11 and 20", "> 20")]
    for i, part in enumerate(slices):
        again = part.filter("event_id % 3 = 0")
        late = slices[i - 1].filter("event_id % 4 = 0") if i else part.limit(0)
        part.unionByName(again).unionByName(late).write.mode("append").parquet(folder)
        # Each run goes on where the last one ended.
        stream = state.distinct_stream(scoring.read_files(spark, folder, events.schema), "ts", "12 days")
        out = scoring.drain_to_table(stream, "log-once", table)
    return out.select("event_id", "user_id", "event_type", "value")


QUERIES["stream_dedup"] = _stream_dedup
ORACLE["stream_dedup"] = "SELECT DISTINCT event_id, user_id, event_type, value FROM events"


def _stream_history(spark, d):
    """The newest 30 rows of each client after a stream in three parts, neither in order nor in one run."""
    events = load(spark, "events", d).select("event_id", "ts", "user_id", "event_type", "value")
    folder, table, out = scratch_path(spark, "history"), scratch_path(spark, "history-lists"), None
    for part in (1, 0, 2):
        events.filter(f"event_id % 3 = {part}").write.mode("append").parquet(folder)
        stream = state.newest_stream(scoring.read_files(spark, folder, events.schema), "user_id", ["ts", "event_id"])
        with state.keyed_state(spark):
            out = scoring.drain_to_table(stream, "history-lists", table)
    return state.last_versions(out, "user_id").select("user_id", "rank", "event_id", "value")


QUERIES["stream_history"] = _stream_history
ORACLE["stream_history"] = """SELECT user_id, rank, event_id, value FROM (SELECT *,
row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 30"""
