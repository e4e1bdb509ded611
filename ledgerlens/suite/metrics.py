"""Queries over scored transactions and prediction history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.expressions import decide, preview
from ledgerlens.operators import metrics, quality, score_sketch
from ledgerlens.operators.training import binary_metrics
from ledgerlens.session import written
from ledgerlens.sources import roles
from ledgerlens.suite import sql
from ledgerlens.suite.common import Query, rounded, scored

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_SCORED = (sql.TXN, sql.scored("txn"))
_SWEEP = """cells AS (
  SELECT t / 10.0::DOUBLE AS threshold,
         count(*) FILTER (WHERE is_fraud = 1 AND fraud_probability >= t / 10.0::DOUBLE) AS tp,
         count(*) FILTER (WHERE is_fraud = 0 AND fraud_probability >= t / 10.0::DOUBLE) AS fp,
         count(*) FILTER (WHERE is_fraud = 1 AND fraud_probability < t / 10.0::DOUBLE) AS fn,
         count(*) FILTER (WHERE is_fraud = 0 AND fraud_probability < t / 10.0::DOUBLE) AS tn
  FROM scored, (SELECT unnest(range(2, 10)) AS t) GROUP BY t
),
pr AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall
  FROM cells
),
sweep AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr
)"""
_ROUNDED = """threshold, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"""


def _decide(spark, d):
    parts = decide(F.col("fraud_probability"), 0.5)
    return rounded(
        scored(spark, d).select(
            "txn_id", parts["flag"].alias("flag"), parts["label"].alias("label"), parts["confidence"].alias("confidence")
        )
    )


QUERIES["decide"] = _decide
ORACLE["decide"] = sql.query(
    """SELECT txn_id, fraud_flag AS flag, CASE WHEN fraud_flag = 1 THEN 'FRAUD' ELSE 'SAFE' END AS label,
    round(greatest(fraud_probability, 1 - fraud_probability), 6) AS confidence FROM scored""",
    *_SCORED,
)

QUERIES["confusion"] = lambda spark, d: metrics.confusion(scored(spark, d))
ORACLE["confusion"] = sql.query(
    "SELECT is_fraud, CAST(fraud_flag AS DOUBLE) AS prediction, count(*) AS n FROM scored GROUP BY ALL", *_SCORED
)

QUERIES["confusion_at"] = lambda spark, d: rounded(metrics.confusion_at(scored(spark, d), 0.7))
ORACLE["confusion_at"] = sql.query(f"SELECT {_ROUNDED} FROM sweep WHERE threshold = 0.7", *_SCORED, _SWEEP)

QUERIES["threshold_sweep"] = lambda spark, d: rounded(metrics.threshold_sweep(scored(spark, d)))
ORACLE["threshold_sweep"] = sql.query(f"SELECT {_ROUNDED} FROM sweep", *_SCORED, _SWEEP)

QUERIES["best_threshold"] = lambda spark, d: rounded(
    metrics.accepted(metrics.best_threshold(metrics.threshold_sweep(scored(spark, d))))
)
ORACLE["best_threshold"] = sql.query(
    f"""SELECT {_ROUNDED}, precision >= 0.8 AS precision_ok, recall >= 0.7 AS recall_ok,
    CASE WHEN (SELECT count(*) FROM sweep s WHERE s.f1 = b.f1) = 1 THEN 1
         WHEN (SELECT count(*) FROM sweep s WHERE s.f1 = b.f1 AND s.recall = b.recall) = 1 THEN 2 ELSE 3 END AS tier
    FROM sweep b ORDER BY b.f1 DESC, b.recall DESC, fp, threshold LIMIT 1""",
    *_SCORED, _SWEEP,
)

def _sketched_threshold(spark, d):
    """The threshold from three merged sketches beside the exact one: how many rows, and whether F1 is within the stated error."""
    rows = scored(spark, d).select("txn_id", "is_fraud", "fraud_probability")
    whole = score_sketch.merged(*(score_sketch.score_sketch(rows.filter(f"txn_id % 3 = {i}")) for i in range(3)))
    found = score_sketch.sketched_threshold(whole)
    exact = metrics.pr_threshold(rows).select("f1").scalar()
    return found.select(
        rows.agg(F.count("*")).scalar().alias("n_rows"), ((exact - F.col("f1") <= F.col("f1_error") + 1e-9) & (F.col("f1") <= exact + 1e-9)).alias("within")
    )


QUERIES["sketched_threshold"] = _sketched_threshold
ORACLE["sketched_threshold"] = sql.query("SELECT count(*) AS n_rows, true AS within FROM txn", sql.TXN)

QUERIES["pr_threshold"] = lambda spark, d: rounded(metrics.pr_threshold(scored(spark, d)))
ORACLE["pr_threshold"] = sql.query(
    """SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
    round(2 * precision * recall / (precision + recall + 1e-10), 6) AS f1
    FROM (
      SELECT fraud_probability AS threshold, sum(pos) OVER w / sum(n) OVER w AS precision,
             sum(pos) OVER w / sum(pos) OVER () AS recall
      FROM (SELECT fraud_probability, sum(is_fraud)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM scored GROUP BY 1)
      WINDOW w AS (ORDER BY fraud_probability DESC)
    )
    ORDER BY 2 * precision * recall / (precision + recall + 1e-10) DESC, threshold LIMIT 1""",
    *_SCORED,
)

_CURVE = """curve AS (
  SELECT *, coalesce(lag(tp) OVER o, 0) AS tp0, coalesce(lag(fp) OVER o, 0) AS fp0,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM (
    SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
    FROM (SELECT fraud_probability AS s, sum(is_fraud)::DOUBLE AS pos, sum(1 - is_fraud)::DOUBLE AS neg
          FROM scored GROUP BY fraud_probability)
    WINDOW w AS (ORDER BY s DESC)
  ) WINDOW o AS (ORDER BY s DESC)
)"""
_AREAS = """sum((fp - fp0) * (tp + tp0) / 2) / (max(p) * max(n)) AS auc_roc,
sum((tp - tp0) / p * (tp / (tp + fp) + CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE tp / (tp + fp) END) / 2) AS pr_auc"""

QUERIES["ranking_areas"] = lambda spark, d: rounded(metrics.ranking_areas(scored(spark, d)))
ORACLE["ranking_areas"] = sql.query(
    f"SELECT round(auc_roc, 6) AS auc_roc, round(pr_auc, 6) AS pr_auc FROM (SELECT {_AREAS} FROM curve)", *_SCORED, _CURVE
)

QUERIES["score_metrics"] = lambda spark, d: rounded(
    binary_metrics(written(scored(spark, d).select("is_fraud", "fraud_probability", "prediction"), "scored"),
                   "is_fraud", "fraud_probability")
)
ORACLE["score_metrics"] = sql.query(
    f"""SELECT round(auc_roc, 6) AS auc_roc, round(pr_auc, 6) AS pr_auc, round((tp + tn) / total, 6) AS accuracy,
    round((p1 * (tp + fn) + p0 * (tn + fp)) / total, 6) AS weighted_precision, round((tp + tn) / total, 6) AS weighted_recall,
    round((2 * p1 * r1 / nullif(p1 + r1, 0) * (tp + fn) + 2 * p0 * r0 / nullif(p0 + r0, 0) * (tn + fp)) / total, 6) AS weighted_f1,
    round(p1, 6) AS positive_precision, round(r1, 6) AS positive_recall
    FROM (SELECT {_AREAS} FROM curve),
         (SELECT *, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0
          FROM (SELECT count(*) FILTER (WHERE is_fraud = 1 AND fraud_flag = 1)::DOUBLE AS tp,
                       count(*) FILTER (WHERE is_fraud = 0 AND fraud_flag = 1)::DOUBLE AS fp,
                       count(*) FILTER (WHERE is_fraud = 1 AND fraud_flag = 0)::DOUBLE AS fn,
                       count(*) FILTER (WHERE is_fraud = 0 AND fraud_flag = 0)::DOUBLE AS tn,
                       count(*)::DOUBLE AS total FROM scored))""",
    *_SCORED, _CURVE,
)

QUERIES["flag_stats"] = lambda spark, d: rounded(metrics.flag_stats(scored(spark, d)))
ORACLE["flag_stats"] = sql.query(
    """SELECT total, flagged, fraud_in_flagged, round(flagged / total::DOUBLE * 100, 6) AS flag_pct,
    round(fraud_in_flagged / flagged::DOUBLE * 100, 6) AS flagged_precision_pct
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE fraud_flag = 1) AS flagged,
                 count(*) FILTER (WHERE fraud_flag = 1 AND is_fraud = 1) AS fraud_in_flagged FROM scored)""",
    *_SCORED,
)

QUERIES["class_report"] = lambda spark, d: rounded(metrics.class_report(scored(spark, d)))
ORACLE["class_report"] = sql.query(
    """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
      SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, support FROM per_class
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class
      UNION ALL SELECT 'accuracy', avg(hit), avg(hit), avg(hit), count(*)
                FROM (SELECT CAST(is_fraud = fraud_flag AS INTEGER) AS hit FROM scored)
    )""",
    *_SCORED,
    """per_class AS (
      SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
      FROM (
        SELECT c, count(*) FILTER (WHERE is_fraud = c) AS support,
               coalesce(count(*) FILTER (WHERE is_fraud = c AND fraud_flag = c)::DOUBLE
                        / nullif(count(*) FILTER (WHERE fraud_flag = c), 0), 0) AS precision,
               coalesce(count(*) FILTER (WHERE is_fraud = c AND fraud_flag = c)::DOUBLE
                        / nullif(count(*) FILTER (WHERE is_fraud = c), 0), 0) AS recall
        FROM scored, (VALUES (0), (1)) AS classes(c) GROUP BY c
      )
    )""",
)

QUERIES["top_risk"] = lambda spark, d: rounded(
    quality.top_n(scored(spark, d), 20, "fraud_probability", "txn_id").select(
        "txn_id", "nameOrig", "amount", "type", "is_fraud", "fraud_probability", "fraud_flag"
    )
)
ORACLE["top_risk"] = sql.query(
    """SELECT txn_id, nameOrig, amount, type, is_fraud, round(fraud_probability, 6) AS fraud_probability, fraud_flag
    FROM scored ORDER BY fraud_probability DESC, txn_id LIMIT 20""",
    *_SCORED,
)

QUERIES["prediction_mix"] = lambda spark, d: metrics.prediction_mix(roles.history(spark, d))
ORACLE["prediction_mix"] = """SELECT CASE WHEN event_type = 'error' THEN 'FRAUD' ELSE 'SAFE' END AS prediction,
count(*) AS n, (SELECT count(*) FROM events) AS total FROM events GROUP BY 1"""

QUERIES["latest_history"] = lambda spark, d: quality.latest(roles.history(spark, d)).select(
    "event_id", F.date_format("ts", "HH:mm:ss").alias("time"), "nameOrig", "amount", "prediction"
)
ORACLE["latest_history"] = """SELECT event_id, strftime(ts, '%H:%M:%S') AS time, 'C' || user_id AS nameOrig, value AS amount,
CASE WHEN event_type = 'error' THEN 'FRAUD' ELSE 'SAFE' END AS prediction FROM events ORDER BY ts DESC, event_id DESC LIMIT 30"""

QUERIES["preview"] = lambda spark, d: roles.load(spark, "documents", d).select(
    "doc_id", preview(F.col("text"), 300).alias("preview")
)
ORACLE["preview"] = "SELECT doc_id, substr(text, 1, 300) || '...' AS preview FROM documents"
