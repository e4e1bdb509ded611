import pytest
from helpers import by, rows
from pyspark.sql import functions as F

from ledgerlens.operators.sampling import balanced_train, split, stratified_side, stratified_split, with_fold
from ledgerlens.plans.running import running_sum


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(10000).select("id", F.when(F.col("id") % 37 == 0, 1).otherwise(0).alias("is_fraud")).cache()


def test_split_is_disjoint_complete_and_about_the_share(labelled):
    train, test = split(labelled, "id")
    a, b = ({r["id"] for r in side.collect()} for side in (train, test))
    assert not a & b and len(a | b) == 10000 and abs(len(a) - 8000) < 200


def test_split_does_not_depend_on_the_partitioning(labelled):
    first = {r["id"] for r in split(labelled, "id")[0].collect()}
    second = {r["id"] for r in split(labelled.repartition(13, "is_fraud"), "id")[0].collect()}
    assert first == second


def test_random_split_is_an_option(labelled):
    train, test = split(labelled, "id", method="random")
    assert train.count() + test.count() == 10000


def test_stratified_split_is_exact_per_class(labelled):
    n = {r["is_fraud"]: r["n"] for r in labelled.groupBy("is_fraud").agg(F.count("*").alias("n")).collect()}
    train, test = stratified_split(labelled, "id", "is_fraud")
    got = {r["is_fraud"]: r["n"] for r in train.groupBy("is_fraud").agg(F.count("*").alias("n")).collect()}
    assert got == {c: round(0.8 * k) for c, k in n.items()}
    assert test.count() == 10000 - sum(got.values())


def test_missing_labels_are_a_class_of_their_own(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 5 > 0, (F.col("id") % 2).cast("int")).alias("is_fraud"))
    train, test = stratified_split(df, "id", "is_fraud")
    assert train.filter("is_fraud IS NULL").count() == 16 and test.filter("is_fraud IS NULL").count() == 4
    assert train.count() + test.count() == 100


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_stratified_shares(spark, share):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)] + [(99, "c")], "id int, y string")
    got = {r["y"]: r["n"] for r in stratified_side(df, "id", "y", share).filter("is_train").groupBy("y").agg(F.count("*").alias("n")).collect()}
    want = {"a": int(5 * share + 0.5), "b": int(5 * share + 0.5), "c": int(share + 0.5)}
    assert got == {k: v for k, v in want.items() if v}


def test_balanced_train(labelled):
    pos = labelled.filter("is_fraud = 1").count()
    neg = 10000 - pos
    got = balanced_train(labelled, "id")
    counts = {r["is_fraud"]: r["n"] for r in got.groupBy("is_fraud").agg(F.count("*").alias("n")).collect()}
    assert counts[1] == pos and abs(counts[0] - 5 * pos) < 0.1 * 5 * pos
    weights = {r["is_fraud"]: r["w"] for r in got.groupBy("is_fraud").agg(F.max("sample_weight").alias("w")).collect()}
    assert weights == {0: 1.0, 1: neg / pos}
    assert balanced_train(labelled, "id", weights=False).agg(F.max("sample_weight")).first()[0] == 1.0
    # More wanted than there are: all stay.
    assert balanced_train(labelled, "id", ratio=1000.0).count() == 10000


def test_balanced_train_without_positives(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "id int, is_fraud int")
    assert balanced_train(df, "id").count() == 0


def test_folds(labelled):
    counts = [r["count"] for r in with_fold(labelled, "id", 5).groupBy("fold").count().collect()]
    assert len(counts) == 5 and min(counts) > 1800


@pytest.mark.parametrize("descending", [False, True])
def test_running_sum(spark, descending):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("k"), (F.col("id") % 11).alias("v"))
    got = by(running_sum(df, "k", ["v"], descending), "k")
    total = 0
    for r in sorted(rows(df), key=lambda r: r["k"], reverse=descending):
        total += r["v"]
        assert got[r["k"]]["sum_v"] == total
    assert len(got) == 2000
