import hashlib
import math

import pytest
from helpers import by, rows
from pyspark.sql import functions as F

from ledgerlens.functions import prompts
from ledgerlens.functions.expressions import (
    TYPE_CODES,
    code_map,
    decide,
    flag,
    guarded_log1p,
    guarded_ratio,
    language_name,
    preview,
    risk_tier,
)
from ledgerlens.functions.hashing import content_id, hash_share, md5_mod
from ledgerlens.functions.templates import fill


@pytest.mark.parametrize("n", [1, 2, 7, 10, 25, 36, 4096, 1_000_003, 2**31 - 1])
def test_md5_mod_is_the_whole_128_bit_number(spark, n):
    keys = [f"C{i * 7919}" for i in range(500)] + ["", "é", "a b", "C" * 300]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", md5_mod(F.col("k"), n).alias("m"))
    for r in df.collect():
        assert r["m"] == int(hashlib.md5(r["k"].encode()).hexdigest(), 16) % n


def test_md5_mod_of_null_is_null(spark):
    assert spark.createDataFrame([(None,)], "k string").select(md5_mod(F.col("k"), 5).alias("m")).first()["m"] is None


def test_content_id_reads_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    got = [r[0] for r in df.select(content_id("x", "y", "z")).collect()]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in ("a||||c", "||||")]


def test_hash_share_is_uniform_and_depends_on_the_seed(spark):
    df = spark.range(20000).select(hash_share(F.col("id"), 1).alias("a"), hash_share(F.col("id"), 2).alias("b"))
    r = df.agg(F.min("a"), F.max("a"), F.avg("a"), F.corr("a", "b")).first()
    assert r[0] >= 0 and r[1] < 1 and abs(r[2] - 0.5) < 0.01 and abs(r[3]) < 0.03


def test_guards(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, -1.0), (10.0, None)], "a double, b double")
    got = rows(
        df.select(
            guarded_ratio(F.col("a"), F.col("b")).alias("ratio"),
            guarded_log1p(F.col("b")).alias("log"),
            flag(F.col("b") < 1).alias("flag"),
        )
    )
    assert [g["ratio"] for g in got] == [5.0, 0.0, 0.0, 0.0]
    assert got[0]["log"] == pytest.approx(math.log1p(2)) and [g["log"] for g in got[1:]] == [0.0, 0.0, 0.0]
    assert [g["flag"] for g in got] == [0, 1, 1, 0]


def test_risk_tier_edges(spark):
    df = spark.createDataFrame([(10.01,), (10.0,), (5.0,), (4.99,), (0.0,)], "r double")
    assert [r[0] for r in df.select(risk_tier(F.col("r"))).collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_code_map_gives_null_for_an_unknown_type(spark):
    df = spark.createDataFrame([(t,) for t in [*TYPE_CODES, "OTHER", None]], "t string")
    assert [r[0] for r in df.select(code_map(F.col("t"), TYPE_CODES)).collect()] == [0, 1, 2, 3, 4, None, None]


def test_language_names(spark):
    df = spark.createDataFrame([("TAMIL",), ("gujarati",), ("french",), (None,)], "t string")
    assert [r[0] for r in df.select(language_name(F.col("t"))).collect()] == ["Tamil", "Gujarati", "English", "English"]


def test_preview(spark):
    df = spark.createDataFrame([("abcdef",), ("ab",)], "t string")
    assert [r[0] for r in df.select(preview(F.col("t"), 3)).collect()] == ["abc...", "ab..."]


def test_decide_includes_the_threshold(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (None,)], "p double")
    parts = decide(F.col("p"), 0.5, ("Rejected", "Approved"))
    got = rows(df.select(*[c.alias(n) for n, c in parts.items()]))
    assert [g["flag"] for g in got] == [1, 0, None]
    assert [g["label"] for g in got] == ["Approved", "Rejected", None]
    assert got[1]["confidence"] == pytest.approx(0.51)


def test_templates_read_like_formatted_strings(spark):
    df = spark.createDataFrame([("q {context} $1", "c\nd", None)], "q string, c string, g string")
    values = {"question": F.col("q"), "expected": F.col("c"), "generated": F.col("g")}
    got = df.select(fill(prompts.JUDGE_USER, **values)).first()[0]
    want = prompts.JUDGE_USER
    for name, value in (("{expected}", "c\nd"), ("{generated}", "None"), ("{question}", "q {context} $1")):
        want = want.replace(name, value)
    assert got == want
    assert '{\n  "accuracy": <score>,' in got


def test_by_helper(spark):
    assert by(spark.range(2), "id")[1] == {"id": 1}
