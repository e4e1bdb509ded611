import pytest
from helpers import FORM_STATES, by, rows
from pyspark.sql import functions as F

from ledgerlens.plans import fraud
from ledgerlens.session import scratch_path
from ledgerlens.sources import roles
from ledgerlens.streaming import scoring
from ledgerlens.suite import learning


@pytest.fixture(scope="module")
def prepared(spark, smoke_dir):
    data = learning.prepared(spark, smoke_dir)
    return data, fraud.fit(data, trees=5, depth=4)


def test_stream_equals_batch(spark, smoke_dir, prepared):
    data, model = prepared
    states = [r["state"] for r in roles.states(spark, smoke_dir).collect()]
    log = roles.txn(spark, smoke_dir, labels=False)
    # Several files, taken one per micro-batch.
    folder = scratch_path(spark, "stream-input")
    log.repartition(4).write.parquet(folder)
    stream = scoring.read_files(spark, folder, log.schema, per_trigger=1)
    args = (states, data.infra, data.rates, model, 0.5, ["txn_id"])
    got = by(scoring.drain_to_table(scoring.score_stream(stream, *args), "streamed"), "txn_id")
    assert got == by(fraud.score(log, *args), "txn_id") and len(got) == log.count()


def test_a_later_run_goes_on_where_the_last_one_ended(spark):
    folder, table = scratch_path(spark, "parts"), scratch_path(spark, "table")
    spark.range(10).write.parquet(folder)

    def drain():
        return scoring.drain_to_table(scoring.read_files(spark, folder, spark.range(1).schema), "parts", table)

    assert drain().count() == 10
    spark.range(10, 15).write.mode("append").parquet(folder)
    assert sorted(r["id"] for r in drain().collect()) == list(range(15))


def test_mix_counts_every_row(spark):
    folder = scratch_path(spark, "mix-input")
    labels = spark.range(100).select(F.when(F.col("id") % 4 == 0, "FRAUD").otherwise("SAFE").alias("prediction"))
    labels.repartition(3).write.parquet(folder)
    stream = scoring.read_files(spark, folder, labels.schema, per_trigger=1)
    got = rows(scoring.drain_counts(scoring.stream_mix(stream), "mix_test"))
    assert {g["prediction"]: g["n"] for g in got} == {"FRAUD": 25, "SAFE": 75}


def test_mix_of_scores(spark):
    folder = scratch_path(spark, "score-input")
    scores = spark.createDataFrame([(0.5,), (0.2,), (0.9,)], "fraud_probability double")
    scores.write.parquet(folder)
    got = rows(scoring.drain_counts(scoring.stream_mix(scoring.read_files(spark, folder, scores.schema)), "mix_scores"))
    assert {g["prediction"]: g["n"] for g in got} == {"FRAUD": 2, "SAFE": 1}


def test_features_run_on_a_stream_without_state(spark, smoke_dir):
    assert set(FORM_STATES) and learning.QUERIES["stream_features"](spark, smoke_dir).count() == roles.load(spark, "orders", smoke_dir).count()
