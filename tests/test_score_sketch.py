"""Sketches of scores: merging, the bound on F1, odd scores, streams."""

import random

import pytest

from ledgerlens.operators.score_sketch import merged, score_sketch, sketched_threshold
from ledgerlens.session import scratch_path
from ledgerlens.streaming import scoring

SCHEMA = "is_fraud int, fraud_probability double"


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(y, min(1.0, max(0.0, rng.gauss(0.6 if y else 0.35, 0.15)))) for y in (int(rng.random() < 0.2) for _ in range(n))]


def best_f1(data):
    positives = sum(y for y, _ in data)
    return max(2 * sum(y for y, p in data if p >= t) / (positives + sum(p >= t for _, p in data)) for t in {p for _, p in data})


@pytest.mark.parametrize("bits", [3, 6, 14])
def test_f1_is_within_its_bound(spark, bits):
    data = rows(700)
    found = sketched_threshold(score_sketch(spark.createDataFrame(data, SCHEMA), bits=bits), bits).first()
    exact = best_f1(data)
    assert found.f1 <= exact + 1e-12 and exact - found.f1 <= found.f1_error + 1e-12
    flagged = [y for y, p in data if p >= found.threshold]
    assert found.precision == pytest.approx(sum(flagged) / len(flagged)) and found.recall == pytest.approx(sum(flagged) / sum(y for y, _ in data))
    assert bits < 14 or found.f1_error < 0.01


def test_merged_parts_and_a_stream_are_the_whole(spark):
    data = rows(600, 2)
    whole = {tuple(r) for r in score_sketch(spark.createDataFrame(data, SCHEMA)).collect()}
    parts = [score_sketch(spark.createDataFrame(data[i::3], SCHEMA)) for i in range(3)]
    assert {tuple(r) for r in merged(*parts).collect()} == whole
    folder = scratch_path(spark, "scored-parts")
    for i in range(3):
        spark.createDataFrame(data[i::3], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = scoring.read_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, per_trigger=1)
    assert {tuple(r) for r in scoring.drain_counts(score_sketch(stream), "sketch_test").collect()} == whole


def test_odd_scores(spark):
    df = spark.createDataFrame([(1, None), (None, 0.5), (1, float("nan")), (1, 1.0), (0, -3.0), (1, 7.0)], SCHEMA)
    assert {tuple(r) for r in score_sketch(df, bits=4).collect()} == {(0, 1, 0), (15, 2, 2)}
    assert sketched_threshold(score_sketch(df.filter("is_fraud = 0"))).count() == 0
    assert sketched_threshold(score_sketch(df.limit(0))).count() == 0
