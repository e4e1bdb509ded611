import hashlib

import pytest
from helpers import FIVE, FIVE_SCHEMA, FORM_STATES, by, plan, rows
from pyspark.sql import functions as F

from ledgerlens.operators.infrastructure import infra_by_state, normalise_infra
from ledgerlens.operators.quality import (
    dedup_full,
    describe,
    imbalance,
    latest,
    null_audit,
    rate_by,
    state_summary,
    stats_by,
    tier_distribution,
    top_n,
)
from ledgerlens.operators.rates import attach_rate, fit_rate
from ledgerlens.operators.transactions import (
    ENGINEERED_COLUMNS,
    RAW_COLUMNS,
    detect_input,
    enrich,
    rename_labels,
    txn_features,
    type_codes,
)
from ledgerlens.plans.lookup import (
    as_lookup,
    assign_state,
    lookup_default,
)


@pytest.fixture(scope="module")
def five(spark):
    return spark.createDataFrame(FIVE, FIVE_SCHEMA)


@pytest.fixture(scope="module")
def form_table(spark):
    rows_ = [(s, d, a, r) for s, (d, a, r) in FORM_STATES.items()]
    return spark.createDataFrame(rows_, "state string, total_pos_devices bigint, total_gov_amount_lakh double, fraud_rate double")


# Worked out by hand: state, ratio plain, ratio plus one, few devices, log amount, log devices, differences.
GOLDEN = {
    "P-ada": ("north", 10.0, 9.0, 1, 2.302585, 6.907755, 90, 90),
    "P-bo": ("south", 0.404040, 0.4, 1, 4.605170, 2.302585, 40, 40),
    "P-cy": ("east", 104.210526, 99.0, 0, 2.995732, 9.210340, 1980, 1980),
    "P-di": ("west", 2.25, 1.8, 1, 1.609438, 4.605170, 9, 9),
    "P-ed": ("delta", 500.0, 250.0, 0, 0.693147, 6.908755, 500, 0),
}


@pytest.mark.parametrize("ratio,column", [("plain", 1), ("plus_one", 2)])
def test_five_transactions(five, form_table, ratio, column):
    states = F.create_map(*[F.lit(x) for name, want in GOLDEN.items() for x in (name, want[0])])
    with_state = five.withColumn("state", states[F.col("nameOrig")])
    got = by(txn_features(enrich(with_state, form_table), ratio=ratio), "nameOrig")
    for name, want in GOLDEN.items():
        row = got[name]
        assert row["state"] == want[0]
        assert row["amount_to_gov_ratio"] == pytest.approx(want[column], abs=1e-6)
        assert row["pos_density_flag"] == want[3]
        assert row["log_gov_amount"] == pytest.approx(want[4], abs=1e-6)
        assert row["log_pos_devices"] == pytest.approx(want[5], abs=1e-6)
        assert (row["balance_diff_orig"], row["balance_diff_dest"]) == want[6:8]
        assert row["orig_balance_zero_flag"] == 0
    rated = attach_rate(with_state, form_table.select("state", "fraud_rate"))
    assert all(r["high_fraud_state_flag"] == 0 for r in rows(rated))


def test_missing_infrastructure_before_and_after(five, form_table):
    with_state = five.withColumn("state", F.lit("XX"))
    joined = enrich(with_state, form_table)
    before, after = txn_features(joined).first(), txn_features(joined, fill="after").first()
    assert (before["pos_density_flag"], after["pos_density_flag"]) == (1, 0)
    for row in (before, after):
        assert row["total_pos_devices"] == 0 and row["total_gov_amount_lakh"] == 0.0
        assert row["amount_to_gov_ratio"] == 0.0 and row["log_gov_amount"] == 0.0 and row["log_pos_devices"] == 0.0


def test_options_are_checked(five):
    with pytest.raises(ValueError):
        txn_features(five, fill="never")


def test_detect_input(spark, five):
    assert detect_input(five) == "raw"
    both = spark.createDataFrame([], ", ".join(f"{c} double" for c in {*RAW_COLUMNS, *ENGINEERED_COLUMNS}))
    assert detect_input(both) == "engineered"
    # Without the amounts and balances the features alone are not enough.
    with pytest.raises(ValueError):
        detect_input(both.select([c for c in ENGINEERED_COLUMNS if c != "amount"]))


def test_type_codes(five):
    assert [r["type_index"] for r in rows(type_codes(five).orderBy("step"))] == [0, 1, 2, 0, 1]


def test_infra(spark):
    raw = spark.createDataFrame(
        [("A", "10", "1.5"), ("A", "x", "2.5"), ("B", None, "oops"), (None, "5", "5")],
        "`State/UT` string, `No. of PoS devices sanctioned` string, `Amount sanctioned in lakh` string",
    )
    clean = normalise_infra(raw)
    assert dict(clean.dtypes) == {"state": "string", "pos_devices": "int", "gov_amount": "double"}
    got = by(infra_by_state(clean), "state")
    assert got["A"] == {"state": "A", "total_pos_devices": 10, "total_gov_amount_lakh": 4.0}
    assert got["B"] == {"state": "B", "total_pos_devices": None, "total_gov_amount_lakh": None}
    assert len(got) == 2


def test_state_assignment(spark):
    names = [f"S{i:03d}" for i in range(97)]
    keys = spark.range(3000).select(F.concat(F.lit("C"), "id").alias("nameOrig")).union(
        spark.createDataFrame([(None,)], "nameOrig string")
    )
    found = by(assign_state(keys, "nameOrig", spark.createDataFrame([(n,) for n in [*names, names[3], None]], "state string")), "nameOrig")
    assert found[None]["state"] is None and len(found) == 3001
    for key in ("C0", "C17", "C2999"):
        assert found[key]["state"] == names[int(hashlib.md5(key.encode()).hexdigest(), 16) % 97]
    # The order in which states arrive does not matter, nor how many there are.
    assert by(assign_state(keys, "nameOrig", names[::-1]), "nameOrig") == found
    many = by(assign_state(keys, "nameOrig", spark.range(6000).select(F.format_string("S%05d", "id").alias("state"))), "nameOrig")
    assert many["C5"]["state"] == f"S{int(hashlib.md5(b'C5').hexdigest(), 16) % 6000:05d}"


def test_lookup_is_broadcast_only_while_it_is_small(spark, form_table):
    table = as_lookup(form_table)
    txn = spark.range(1000).select(F.concat(F.lit("U"), F.col("id") % 30).alias("state"), "id")
    assert "BroadcastHashJoin" in plan(enrich(txn, table))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 100)
    try:
        large = enrich(txn, table)
        assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" in plan(large)
        assert large.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_default(spark, form_table):
    df = spark.createDataFrame([("north",), ("ZZ",)], "state string")
    got = by(lookup_default(df, form_table, "state", {"total_pos_devices": 500, "total_gov_amount_lakh": 10.0, "fraud_rate": 0.02}), "state")
    assert got["north"]["total_pos_devices"] == 999
    assert got["ZZ"] == {"state": "ZZ", "total_pos_devices": 500, "total_gov_amount_lakh": 10.0, "fraud_rate": 0.02}


def test_rates_come_from_training_rows_only(spark):
    train = spark.createDataFrame([("A", 1), ("A", 0), ("B", 0)], "state string, is_fraud int")
    rates = fit_rate(train)
    assert {r["state"]: r["fraud_rate"] for r in rates.collect()} == {"A": 0.5, "B": 0.0}
    new = spark.createDataFrame([("A", 9.0), ("C", 9.0), (None, 9.0)], "state string, fraud_rate double")
    got = by(attach_rate(new, rates), "state")
    assert got["A"]["fraud_rate"] == 0.5 and got["A"]["high_fraud_state_flag"] == 1
    assert got["C"]["fraud_rate"] == 0.0 and got[None]["fraud_rate"] == 0.0


def test_rename_and_dedup(spark):
    df = spark.createDataFrame([(1, 0, "x"), (1, 0, "x"), (1, 0, None), (1, 0, None)], "isFraud int, isFlaggedFraud int, t string")
    out = dedup_full(rename_labels(df))
    assert out.columns == ["is_fraud", "is_flagged_fraud", "t"] and out.count() == 2


def test_imbalance_without_positives_or_rows(spark):
    none = imbalance(spark.createDataFrame([(0,), (0,)], "is_fraud int")).first()
    assert (none["total"], none["fraud"], none["fraud_pct"], none["ratio"]) == (2, 0, 0.0, None)
    empty = imbalance(spark.createDataFrame([], "is_fraud int")).first()
    assert (empty["total"], empty["fraud_pct"], empty["ratio"]) == (0, None, None)


def test_summary_and_tiers(spark):
    data = [("A", 1, 10.0, 0.9), ("A", 0, 30.0, 0.1), ("B", 0, 5.0, 0.2)]
    df = spark.createDataFrame(data, "state string, is_fraud int, amount double, fraud_probability double")
    df = df.withColumn("total_gov_amount_lakh", F.lit(7.0)).withColumn("total_pos_devices", F.lit(3))
    summary = state_summary(df)
    got = rows(summary)
    assert [g["state"] for g in got] == ["A", "B"]
    assert got[0]["fraud_rate_pct"] == 50.0 and got[0]["risk_tier"] == "HIGH" and got[0]["avg_transaction_amount"] == 20.0
    assert got[1]["risk_tier"] == "LOW" and got[1]["total_pos_devices"] == 3
    tiers = by(tier_distribution(summary), "risk_tier")
    assert tiers["HIGH"]["total_txns"] == 2 and tiers["LOW"]["num_states"] == 1


def test_small_reports(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (0, None)], "k int, v double")
    assert by(stats_by(df, "k", "v"), "k")[1]["std_v"] == pytest.approx(2**0.5)
    assert rows(null_audit(df, {"v": "nulls"})) == [{"nulls": 1}]
    d = describe(df, "v").first()
    assert (d["count"], d["mean"], d["min"], d["max"]) == (2, 3.0, 2.0, 4.0)
    rated = rows(rate_by(df.withColumnRenamed("k", "is_fraud").withColumn("g", F.lit("x")), "g"))
    assert rated[0]["fraud_rate_pct"] == pytest.approx(200 / 3)


def test_top_n_and_latest_break_ties_by_key(spark):
    df = spark.range(100).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("ts"))
    assert [r["event_id"] for r in latest(df, 3).collect()] == [98, 95, 92]
    assert [r["event_id"] for r in top_n(df, 3, "ts", "event_id").collect()] == [2, 5, 8]
    assert "TakeOrderedAndProject" in plan(latest(df))
