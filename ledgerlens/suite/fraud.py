"""Queries over the transaction and infrastructure roles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import quality
from ledgerlens.operators.infrastructure import infra_by_state, normalise_infra
from ledgerlens.operators.rates import attach_rate, fit_rate, fold_rates
from ledgerlens.operators.sampling import balanced_train, split, stratified_side, with_fold
from ledgerlens.operators.transactions import rename_labels, type_codes
from ledgerlens.plans.lookup import as_lookup, lookup_default
from ledgerlens.session import scratch_path, written
from ledgerlens.sources import roles
from ledgerlens.sources.models import log_run, read_runs
from ledgerlens.sources.payloads import open_payloads, payload_schema
from ledgerlens.sources.roles import load
from ledgerlens.sources.tables import explode_records, load_csv, save, save_csv, spread
from ledgerlens.suite import sql
from ledgerlens.suite.common import (
    Query,
    enriched,
    featured,
    infra_table,
    rounded,
    scored,
    txn_with_state,
)

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}
FEATURES = [
    "txn_id", "state", "total_pos_devices", "total_gov_amount_lakh", "amount_to_gov_ratio", "pos_density_flag",
    "log_gov_amount", "log_pos_devices", "balance_diff_orig", "balance_diff_dest", "orig_balance_zero_flag",
]
RAW = [
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest",
    "newbalanceDest",
]
_FEATURE_SQL = """SELECT txn_id, state, total_pos_devices, round(total_gov_amount_lakh, 6) AS total_gov_amount_lakh,
round({ratio}, 6) AS amount_to_gov_ratio, {density} AS pos_density_flag, round(log_gov_amount, 6) AS log_gov_amount,
round(log_pos_devices, 6) AS log_pos_devices, round(balance_diff_orig, 6) AS balance_diff_orig,
round(balance_diff_dest, 6) AS balance_diff_dest, orig_balance_zero_flag FROM featured"""
_PLAIN = {"ratio": "amount_to_gov_ratio", "density": "pos_density_flag"}
_TO_STATE = (sql.TXN, sql.STATES)
_TO_FEATURES = (*_TO_STATE, sql.INFRA, sql.ENRICHED, sql.FEATURED)


def _labelled(spark, d):
    return rename_labels(roles.txn(spark, d, balances=False))


# Infrastructure and state assignment.

QUERIES["infra_clean"] = lambda spark, d: normalise_infra(roles.infra(spark, d))
ORACLE["infra_clean"] = sql.query("SELECT * FROM infra_clean", sql.INFRA)

QUERIES["infra_by_state"] = lambda spark, d: rounded(infra_by_state(normalise_infra(roles.infra(spark, d))), 2)
ORACLE["infra_by_state"] = sql.query(
    "SELECT state, total_pos_devices, round(total_gov_amount_lakh, 2) AS total_gov_amount_lakh FROM infra", sql.INFRA
)

QUERIES["state_list"] = lambda spark, d: quality.distinct_values(normalise_infra(roles.infra(spark, d)), "state")
ORACLE["state_list"] = sql.query("SELECT DISTINCT state FROM infra_clean", sql.INFRA)

QUERIES["state_assign"] = lambda spark, d: txn_with_state(spark, d).select("txn_id", "nameOrig", "state")
ORACLE["state_assign"] = sql.query("SELECT txn_id, nameOrig, state FROM txn_state", *_TO_STATE)

QUERIES["enrich_left"] = lambda spark, d: rounded(
    enriched(spark, d, balances=False, labels=False).select(
        "txn_id", "state", "amount", "total_pos_devices", "total_gov_amount_lakh"
    )
)
ORACLE["enrich_left"] = sql.query(
    "SELECT txn_id, state, amount, total_pos_devices, round(total_gov_amount_lakh, 6) AS total_gov_amount_lakh FROM enriched",
    *_TO_STATE, sql.INFRA, sql.ENRICHED,
)

def _state_lookup(spark, d):
    """The three features of an entered state; states without a known rate get the default."""
    labelled = txn_with_state(spark, d, labels=True).select("txn_id", "state", "is_fraud")
    rates = as_lookup(fit_rate(labelled).filter("fraud_rate > 0"), "rates")
    infra = {"total_pos_devices": 500, "total_gov_amount_lakh": 10.0}
    found = lookup_default(labelled.drop("is_fraud"), infra_table(spark, d), "state", infra)
    return rounded(lookup_default(found, rates, "state", {"fraud_rate": 0.02}))


QUERIES["state_lookup"] = _state_lookup
ORACLE["state_lookup"] = sql.query(
    """SELECT txn_id, e.state, coalesce(total_pos_devices, 500) AS total_pos_devices,
    round(coalesce(total_gov_amount_lakh, 10), 6) AS total_gov_amount_lakh, round(coalesce(fraud_rate, 0.02::DOUBLE), 6) AS fraud_rate
    FROM enriched e LEFT JOIN (SELECT state, avg(is_fraud) AS fraud_rate FROM txn_state GROUP BY 1 HAVING avg(is_fraud) > 0) r
      ON r.state = e.state""",
    *_TO_STATE, sql.INFRA, sql.ENRICHED,
)

QUERIES["type_codes"] = lambda spark, d: type_codes(
    roles.txn(spark, d, balances=False, labels=False).select("txn_id", "type"), PRIORITY_CODES
)
ORACLE["type_codes"] = """SELECT o_orderkey AS txn_id, o_orderpriority AS type,
CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 END AS type_index
FROM orders"""

# Features.

QUERIES["txn_features"] = lambda spark, d: rounded(featured(spark, d).select(*FEATURES))
ORACLE["txn_features"] = sql.query(_FEATURE_SQL.format(**_PLAIN), *_TO_FEATURES)

QUERIES["txn_features_late_fill"] = lambda spark, d: rounded(featured(spark, d, fill="after").select(*FEATURES))
ORACLE["txn_features_late_fill"] = sql.query(
    _FEATURE_SQL.format(
        ratio="amount_to_gov_ratio",
        density="CASE WHEN state IN (SELECT state FROM infra WHERE total_pos_devices < 1000) THEN 1 ELSE 0 END",
    ),
    *_TO_FEATURES,
)

QUERIES["txn_features_form"] = lambda spark, d: rounded(featured(spark, d, ratio="plus_one").select(*FEATURES))
ORACLE["txn_features_form"] = sql.query(
    _FEATURE_SQL.format(ratio="amount / (total_gov_amount_lakh + 1)", density="pos_density_flag"), *_TO_FEATURES
)


def _with_copies(spark, d):
    rows = roles.txn(spark, d, labels=False)
    copies = F.when(F.col("txn_id") % 10 == 0, 3).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select(*RAW)


QUERIES["dedup_full"] = lambda spark, d: quality.dedup_full(_with_copies(spark, d))
ORACLE["dedup_full"] = sql.query(f"SELECT DISTINCT {', '.join(RAW)} FROM txn", sql.TXN)

# Exploratory aggregates.

QUERIES["class_balance"] = lambda spark, d: quality.class_counts(_labelled(spark, d), ["is_fraud"])
ORACLE["class_balance"] = sql.query("SELECT is_fraud, count(*) AS n FROM txn GROUP BY is_fraud", sql.TXN)

QUERIES["imbalance"] = lambda spark, d: rounded(quality.imbalance(_labelled(spark, d)))
ORACLE["imbalance"] = sql.query(
    """SELECT total, fraud, total - fraud AS non_fraud, round(100.0::DOUBLE * fraud / total, 6) AS fraud_pct,
    round(100 - 100.0::DOUBLE * fraud / total, 6) AS non_fraud_pct,
    round((total - fraud)::DOUBLE / nullif(fraud, 0), 6) AS ratio
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE is_fraud = 1) AS fraud FROM txn)""",
    sql.TXN,
)


def _rate_sql(dim: str, source: str) -> str:
    return f"""SELECT {dim}, count(*) AS total_txns, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
    round(100.0::DOUBLE * sum(is_fraud) / count(*), 6) AS fraud_rate_pct FROM {source} GROUP BY {dim}"""


QUERIES["rate_by_state"] = lambda spark, d: rounded(quality.rate_by(txn_with_state(spark, d, labels=True), "state"))
ORACLE["rate_by_state"] = sql.query(_rate_sql("state", "txn_state"), *_TO_STATE)

QUERIES["top_states"] = lambda spark, d: rounded(
    quality.rate_by(txn_with_state(spark, d, labels=True), "state", top=10)
)
ORACLE["top_states"] = ORACLE["rate_by_state"] + " ORDER BY sum(is_fraud)::DOUBLE / count(*) DESC, state LIMIT 10"

QUERIES["rate_by_type"] = lambda spark, d: rounded(quality.rate_by(_labelled(spark, d), "type"))
ORACLE["rate_by_type"] = sql.query(_rate_sql("type", "txn"), sql.TXN)

QUERIES["amount_stats"] = lambda spark, d: rounded(quality.stats_by(_labelled(spark, d), "is_fraud", "amount"), 4)
ORACLE["amount_stats"] = sql.query(
    """SELECT is_fraud, round(avg(amount), 4) AS avg_amount, round(stddev_samp(amount), 4) AS std_amount,
    round(min(amount), 4) AS min_amount, round(max(amount), 4) AS max_amount FROM txn GROUP BY is_fraud""",
    sql.TXN,
)

QUERIES["null_audit"] = lambda spark, d: quality.null_audit(
    enriched(spark, d, balances=False, labels=False),
    {"total_pos_devices": "null_pos_devices", "total_gov_amount_lakh": "null_gov_amount"},
)
ORACLE["null_audit"] = sql.query(
    """SELECT count(*) FILTER (WHERE total_pos_devices IS NULL) AS null_pos_devices,
    count(*) FILTER (WHERE total_gov_amount_lakh IS NULL) AS null_gov_amount FROM enriched""",
    *_TO_STATE, sql.INFRA, sql.ENRICHED,
)


def _state_scores(spark, d):
    return quality.state_summary(scored(spark, d, state=True))


_SUMMARY = """summary AS (
  SELECT *, CASE WHEN fraud_rate_pct > 10 THEN 'HIGH' WHEN fraud_rate_pct >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
  FROM (
    SELECT state, count(*) AS total_transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
           sum(is_fraud)::DOUBLE / count(*) * 100 AS fraud_rate_pct, avg(amount) AS avg_transaction_amount,
           avg(fraud_probability) AS avg_prob_fraud, max(total_gov_amount_lakh) AS total_gov_amount_lakh,
           max(total_pos_devices) AS total_pos_devices
    FROM scored GROUP BY state
  )
)"""
_TO_SUMMARY = (*_TO_FEATURES, sql.scored("filled"), _SUMMARY)

QUERIES["state_summary"] = lambda spark, d: rounded(_state_scores(spark, d))
ORACLE["state_summary"] = sql.query(
    """SELECT state, total_transactions, fraud_count, round(fraud_rate_pct, 6) AS fraud_rate_pct,
    round(avg_transaction_amount, 6) AS avg_transaction_amount, round(avg_prob_fraud, 6) AS avg_prob_fraud,
    round(total_gov_amount_lakh, 6) AS total_gov_amount_lakh, total_pos_devices, risk_tier FROM summary""",
    *_TO_SUMMARY,
)

QUERIES["tier_distribution"] = lambda spark, d: quality.tier_distribution(_state_scores(spark, d))
ORACLE["tier_distribution"] = sql.query(
    """SELECT risk_tier, count(*) AS num_states, CAST(sum(total_transactions) AS BIGINT) AS total_txns,
    CAST(sum(fraud_count) AS BIGINT) AS total_fraud FROM summary GROUP BY risk_tier""",
    *_TO_SUMMARY,
)

# Splits, encoding, balancing.

_SPLIT = f"""sided AS (
  SELECT *, {sql.share("txn_id", 42)} < 0.8 AS is_train FROM txn_state
),
rates AS (SELECT state, avg(is_fraud) AS fraud_rate FROM sided WHERE is_train GROUP BY state)"""


def _split_counts(spark, d):
    train, test = split(_labelled(spark, d), "txn_id")
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return quality.class_counts(both, ["side", "is_fraud"])


QUERIES["split_counts"] = _split_counts
ORACLE["split_counts"] = sql.query(
    """SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS side, is_fraud, count(*) AS n
    FROM sided GROUP BY ALL""",
    *_TO_STATE, _SPLIT,
)

QUERIES["stratified_split"] = lambda spark, d: stratified_side(
    written(_labelled(spark, d).select("txn_id", "is_fraud"), "labelled"), "txn_id", "is_fraud"
)
ORACLE["stratified_split"] = sql.query(
    f"""SELECT txn_id, is_fraud,
    row_number() OVER (PARTITION BY is_fraud ORDER BY {sql.word("txn_id", 42)}, txn_id)
      <= round(0.8::DOUBLE * count(*) OVER (PARTITION BY is_fraud)) AS is_train FROM txn""",
    sql.TXN,
)


def _encoded(spark, d):
    """All rows with the rates of the training rows, and which side each is on."""
    rows = written(txn_with_state(spark, d, labels=True).select("txn_id", "state", "is_fraud"), "labelled")
    train, test = split(rows, "txn_id")
    rates = as_lookup(fit_rate(train), "rates")
    sides = train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))
    return attach_rate(sides, rates)


QUERIES["target_encode"] = lambda spark, d: rounded(
    _encoded(spark, d).select("txn_id", "state", "is_train", "fraud_rate", "high_fraud_state_flag")
)
ORACLE["target_encode"] = sql.query(
    """SELECT txn_id, s.state, is_train, round(coalesce(fraud_rate, 0), 6) AS fraud_rate,
    CASE WHEN coalesce(fraud_rate, 0) > 0.05 THEN 1 ELSE 0 END AS high_fraud_state_flag
    FROM sided s LEFT JOIN rates r ON r.state = s.state""",
    *_TO_STATE, _SPLIT,
)

QUERIES["fold_rates"] = lambda spark, d: rounded(
    fold_rates(with_fold(txn_with_state(spark, d, labels=True).select("txn_id", "state", "is_fraud"), "txn_id", 3, seed=7))
)
ORACLE["fold_rates"] = sql.query(
    f"""SELECT d.fold, s.state, round(avg(s.is_fraud), 6) AS fraud_rate
    FROM (SELECT DISTINCT CAST({sql.word("txn_id", 7)} % 3 AS INTEGER) AS fold FROM txn_state) d
    JOIN (SELECT state, is_fraud, CAST({sql.word("txn_id", 7)} % 3 AS INTEGER) AS fold FROM txn_state) s ON s.fold <> d.fold
    GROUP BY ALL""",
    *_TO_STATE,
)

QUERIES["describe_rate"] = lambda spark, d: rounded(
    quality.describe(_encoded(spark, d).filter("is_train"), "fraud_rate"), 8
)
ORACLE["describe_rate"] = sql.query(
    """SELECT count(fraud_rate) AS count, round(avg(fraud_rate), 8) AS mean, round(stddev_samp(fraud_rate), 8) AS stddev,
    round(min(fraud_rate), 8) AS min, round(max(fraud_rate), 8) AS max
    FROM sided s JOIN rates r ON r.state = s.state WHERE is_train""",
    *_TO_STATE, _SPLIT,
)

QUERIES["balanced_train"] = lambda spark, d: rounded(
    balanced_train(split(_labelled(spark, d), "txn_id")[0], "txn_id").select("txn_id", "is_fraud", "sample_weight")
)
ORACLE["balanced_train"] = sql.query(
    f"""SELECT txn_id, is_fraud, round(CASE WHEN is_fraud = 1 THEN neg::DOUBLE / pos ELSE 1 END, 6) AS sample_weight
    FROM sided, (SELECT count(*) FILTER (WHERE is_fraud = 1) AS pos, count(*) FILTER (WHERE is_fraud = 0) AS neg
                 FROM sided WHERE is_train)
    WHERE is_train AND (is_fraud = 1 OR {sql.share("txn_id", 43)} < floor(pos * 5)::DOUBLE / neg)""",
    *_TO_STATE, _SPLIT,
)

# Sources.


def _json_records(spark, d):
    events = spread(load(spark, "events", d), "event_id")
    record = F.to_json(F.struct("event_id", "value", F.col("user_id").alias("k")))
    records = F.concat(F.lit('{"dataframe_records": ['), record, F.lit(", "), F.col("props"), F.lit("]}"))
    row = F.concat(F.lit("["), "user_id", F.lit(", "), "event_id", F.lit(", "), F.to_json(F.array("event_type")), F.lit("]"))
    by_position = F.concat(F.lit('{"dataframe_split": {"columns": ["k", "event_id", "kind"], "data": ['), row, F.lit("]}}"))
    payloads = events.select(
        F.col("event_id").alias("payload_id"), F.explode(F.array(records, by_position)).alias("payload")
    )
    # Every tenth event comes with a payload that is cut off.
    cut = events.filter("event_id % 10 = 0").select(F.col("event_id").alias("payload_id"), F.expr("left('{\"dataframe_records\": [', 12)").alias("payload"))
    payloads = payloads.unionByName(cut)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("k", T.LongType()),
        ]
    )
    return explode_records(payloads, "payload", schema, ["payload_id"])


QUERIES["json_records"] = _json_records
ORACLE["json_records"] = """
SELECT event_id AS payload_id, true AS valid, 0 AS pos, event_id, value, user_id AS k FROM events
UNION ALL
SELECT event_id, true, 1, NULL, NULL, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events
UNION ALL
SELECT event_id, true, 0, event_id, NULL, user_id FROM events
UNION ALL
SELECT event_id, false, NULL, NULL, NULL, NULL FROM events WHERE event_id % 10 = 0"""


def _event_payloads(spark, d):
    """Events as payloads: nested, with fields that only some have, and some cut off."""
    whole = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("value").alias("overall"), F.array("user_id", "event_id").alias("ids")).alias("scores"),
        F.when(F.expr("event_id % 3 = 0"), F.struct(F.col("event_type").alias("kind"))).alias("note"),
        F.when(F.expr("event_id % 4 = 0"), F.col("user_id")).alias("user"),
    ))
    return load(spark, "events", d).select("event_id", F.when(F.expr("event_id % 10 = 0"), F.left(whole, F.lit(15))).otherwise(whole).alias("payload"))


QUERIES["open_payloads"] = lambda spark, d: open_payloads(
    _event_payloads(spark, d), "payload", {"id": ("$.id", "bigint"), "overall": ("$.scores.overall", "double"), "second": ("$.scores.ids[1]", "bigint")}, ["event_id"]
).select("event_id", "valid", "id", "overall", "second", F.try_element_at("other", F.lit("note")).alias("note"), F.coalesce(F.size("other"), F.lit(-1)).alias("n_other"))
ORACLE["open_payloads"] = """SELECT event_id, event_id % 10 <> 0 AS valid, CASE WHEN event_id % 10 <> 0 THEN event_id END AS id,
CASE WHEN event_id % 10 <> 0 THEN value END AS overall, CASE WHEN event_id % 10 <> 0 THEN event_id END AS second,
CASE WHEN event_id % 10 <> 0 AND event_id % 3 = 0 THEN '{"kind":"' || event_type || '"}' END AS note,
CASE WHEN event_id % 10 = 0 THEN -1 ELSE (event_id % 3 = 0)::INTEGER + (event_id % 4 = 0)::INTEGER END AS n_other FROM events"""

# How many digits a decimal has follows from the values.
QUERIES["payload_schema"] = lambda spark, d: payload_schema(_event_payloads(spark, d), "payload").withColumn(
    "schema", F.regexp_replace("schema", r"DECIMAL\(\d+,\d+\)", "DECIMAL")
)
ORACLE["payload_schema"] = """SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_id % 10 <> 0) AS n_valid,
'OBJECT<id: BIGINT, note: OBJECT<kind: STRING>, scores: OBJECT<ids: ARRAY<BIGINT>, overall: DECIMAL>, user: BIGINT>' AS schema FROM events"""


def _table_roundtrip(spark, d):
    """A table that is replaced by another schema and read back."""
    rows = roles.txn(spark, d, labels=False).select("txn_id", *RAW)
    path = scratch_path(spark, "table")
    save(rows.select("txn_id"), path)
    save(rows, path)
    return spark.read.parquet(path)


def _run_log(spark, d):
    """Two runs logged one after the other."""
    path = scratch_path(spark, "runs")
    orders = load(spark, "orders", d).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top")).first()
    log_run(spark, path, "first", {"trees": 100, "depth": 10}, {"rows": orders["n"]})
    log_run(spark, path, "second", metrics={"largest": round(orders["top"], 2)})
    return read_runs(spark, path)


QUERIES["run_log"] = _run_log
ORACLE["run_log"] = """SELECT 'first' AS run_id, 'param' AS kind, 'trees' AS name, '100' AS value
UNION ALL SELECT 'first', 'param', 'depth', '10'
UNION ALL SELECT 'first', 'metric', 'rows', CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) FROM orders
UNION ALL SELECT 'second', 'metric', 'largest', CAST(round(max(o_totalprice), 2) AS VARCHAR) FROM orders"""


def _csv_roundtrip(spark, d):
    rows = roles.txn(spark, d, labels=False).select("txn_id", *RAW)
    path = scratch_path(spark, "csv")
    save_csv(rows, path)
    return load_csv(spark, path, rows.schema)


QUERIES["csv_roundtrip"] = _csv_roundtrip
ORACLE["csv_roundtrip"] = sql.query(f"SELECT txn_id, {', '.join(RAW)} FROM txn", sql.TXN)

QUERIES["table_roundtrip"] = _table_roundtrip
ORACLE["table_roundtrip"] = ORACLE["csv_roundtrip"]
