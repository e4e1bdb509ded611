"""The test tables in the roles of the real inputs (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources import tables
from ledgerlens.sources.tables import spread

# Columns of the test tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

EPOCH = "1992-01-01"
STATE_COLUMN = "State/UT"
DEVICES_COLUMN = "No. of PoS devices sanctioned"
AMOUNT_COLUMN = "Amount sanctioned in lakh"


def load(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return tables.load(spark, name, sf_dir, SCHEMAS[name])


def step_of(date: Column) -> Column:
    return F.datediff(date.cast("date"), F.lit(EPOCH).cast("date"))


def txn(spark: SparkSession, sf_dir: str, balances: bool = True, labels: bool = True) -> DataFrame:
    """Orders as a transaction log.

    ``balances`` and ``labels`` add the columns that need further tables, so
    that a query without them does not pay for the joins.
    """
    orders = load(spark, "orders", sf_dir)
    df = orders_as_txn(spread(orders, "o_orderkey") if balances else orders, spark, sf_dir, balances)
    if labels:
        returned = (
            load(spark, "lineitem", sf_dir)
            .filter(F.col("l_returnflag") == "R")
            .groupBy(F.col("l_orderkey").alias("txn_id"))
            .agg(F.sum("l_quantity").alias("returned"))
            .filter(F.col("returned") >= 100)
        )
        df = df.join(returned, "txn_id", "left").withColumn(
            "isFraud",
            F.when((F.col("_status") == "F") & F.col("returned").isNotNull(), 1).otherwise(0),
        )
        df = df.withColumn("isFlaggedFraud", F.when(F.col("amount") > 450000, 1).otherwise(0))
        df = df.drop("returned")
    return df.drop("_status")


def orders_as_txn(orders: DataFrame, spark: SparkSession, sf_dir: str, balances: bool = True) -> DataFrame:
    """The unlabelled part of ``txn``; ``orders`` may be a stream."""
    df = orders.select(
        F.col("o_orderkey").alias("txn_id"),
        step_of(F.col("o_orderdate")).alias("step"),
        F.col("o_orderpriority").alias("type"),
        F.col("o_totalprice").alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("nameOrig"),
        F.col("o_orderstatus").alias("_status"),
        F.col("o_custkey").alias("_custkey"),
    )
    if not balances:
        return df.drop("_custkey")
    customer = load(spark, "customer", sf_dir).select(
        F.col("c_custkey").alias("_custkey"), F.col("c_acctbal").alias("_orig")
    )
    supplier = load(spark, "supplier", sf_dir).select(
        F.col("s_suppkey").alias("_suppkey"), F.col("s_acctbal").alias("oldbalanceDest")
    )
    suppliers = load(spark, "supplier", sf_dir).agg(F.count("*")).scalar()
    old = F.when(F.col("txn_id") % 7 == 0, 0.0).otherwise(F.col("_orig"))
    return (
        df.withColumn("_suppkey", F.col("txn_id") % suppliers)
        .join(customer, "_custkey")
        .join(supplier, "_suppkey")
        .withColumn("oldbalanceOrg", old)
        .withColumn("newbalanceOrig", F.greatest(F.col("oldbalanceOrg") - F.col("amount"), F.lit(0.0)))
        .withColumn("nameDest", F.concat(F.lit("M"), F.col("_suppkey")))
        .withColumn("newbalanceDest", F.col("oldbalanceDest") + F.col("amount"))
        .drop("_custkey", "_suppkey", "_orig")
    )


def infra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sanctioned infrastructure; some counts are not numbers, some states are unknown."""
    nation = load(spark, "nation", sf_dir)
    devices = F.when(F.col("s_suppkey") % 17 == 0, "n/a").otherwise((10 + F.col("s_suppkey") % 90).cast("string"))
    return (
        load(spark, "supplier", sf_dir)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("s_suppkey") % 23 != 0, F.col("n_name")).alias(STATE_COLUMN),
            devices.alias(DEVICES_COLUMN),
            F.col("s_acctbal").cast("string").alias(AMOUNT_COLUMN),
        )
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations, and one further state that has no infrastructure."""
    named = load(spark, "nation", sf_dir).select(F.col("n_name").alias("state"))
    return named.union(spark.range(1).select(F.lit("OFFSHORE")))


def corpus_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as question-answer rows; every tenth one appears twice, with another date."""
    key = F.col("doc_id")
    first_date = F.concat(F.lit("2024-"), F.lpad((key % 14).cast("string"), 2, "0"), F.lit("-15"))
    dates = F.when(key % 10 == 0, F.array(first_date, F.lit("2025-01-31"))).otherwise(F.array(first_date))
    return spread(load(spark, "documents", sf_dir), "doc_id").select(
        F.concat(F.lit(" doc-"), key, F.lit(" ")).alias("document"),
        F.col("source").alias("filename"),
        F.col("lang").alias("regulation_area"),
        F.col("source").alias("applicable_to"),
        F.explode(dates).alias("issued_on"),
        F.concat(F.lit("topic-"), key % 5).alias("key_topics"),
        F.col("text").alias("chunks_text"),
        (key % 4 == 0).alias("is_table"),
        F.concat(F.lit("What does  document "), key, F.lit(" say?")).alias("question"),
        F.col("text").alias("answer"),
    )


def corpus_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as evaluation questions, without the chunk columns."""
    return load(spark, "benchmark", sf_dir).select(
        F.concat(F.lit("item-"), "item_id").alias("document"),
        F.lit("2024-06-01").alias("issued_on"),
        F.concat(F.lit("Who is meant by: "), "text").alias("question"),
        F.col("text").alias("answer"),
        F.concat(F.lit("In other words: "), "text").alias("rephrased_question"),
        F.col("text").alias("rephrased_answer"),
        F.lit("states the same facts").alias("evaluation_criteria"),
        (F.col("item_id") % 3).cast("string").alias("category"),
        (F.col("item_id") % 2).cast("string").alias("estimated_difficulty"),
    )


def generated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user message and the reply that follows it, one row per answered question.

    Joined on (conversation, turn), which stays balanced however long one
    conversation is.
    """
    talk = load(spark, "conversations", sf_dir)
    asked = talk.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    replied = talk.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply")
    )
    return asked.join(replied, ["conv_id", "turn"])


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's reply to every generated answer, as JSON text; some fenced, every seventh one malformed."""
    key = F.col("conv_id") * 5 + F.col("turn")
    body = F.concat(
        F.lit('{"accuracy": '), key % 11,
        F.lit(', "completeness": '), (key * 3) % 11,
        F.lit(', "clarity": '), (key * 5) % 12,
        F.lit(', "relevance": '), F.length("reply") % 11,
        F.lit(', "overall_score": 5, "reasoning": "answer '), key, F.lit('"}'),
    )
    reply = (
        F.when(key % 7 == 6, F.lit("The answer is good."))
        .when(key % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .otherwise(body)
    )
    return generated_answers(spark, sf_dir).select(
        F.concat(F.lit("item-"), "conv_id").alias("document"), F.col("turn").alias("answer_id"), reply.alias("evaluation")
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as past predictions."""
    return load(spark, "events", sf_dir).select(
        "event_id",
        "ts",
        F.concat(F.lit("C"), "user_id").alias("nameOrig"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", "FRAUD").otherwise("SAFE").alias("prediction"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, "embeddings", sf_dir).select("vec_id", "embedding")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of the label's vectors."""
    return (
        load(spark, "embeddings", sf_dir)
        .select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("parts"))
        .select("query_id", F.col("parts.x").alias("embedding"))
    )


def loan_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as loan applications."""
    key = F.col("o_orderkey")
    customer = load(spark, "customer", sf_dir).select("c_custkey", "c_acctbal")
    joined = load(spark, "orders", sf_dir).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    co = F.when(key % 3 == 0, 0.0).otherwise(F.greatest(F.lit(0.4) * F.col("c_acctbal"), F.lit(0.0)))
    approved = (F.col("o_orderstatus") != "F") & (F.col("o_totalprice") < 420000)
    return joined.select(
        key.alias("loan_id"),
        (key % 2).cast("double").alias("Gender"),
        (F.floor(key / 2) % 2).cast("double").alias("Married"),
        (F.floor(key / 4) % 4).cast("double").alias("Dependents"),
        (F.floor(key / 16) % 2).cast("int").alias("Education"),
        (F.floor(key / 32) % 2).cast("double").alias("Self_Employed"),
        F.greatest(F.col("c_acctbal"), F.lit(150.0)).alias("ApplicantIncome"),
        co.alias("CoapplicantIncome"),
        (F.col("o_totalprice") / 1000).alias("LoanAmount"),
        (36 + 12 * (key % 38)).cast("double").alias("Loan_Amount_Term"),
        F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(1.0).alias("Credit_History"),
        (key % 3).cast("int").alias("Property_Area"),
        F.when(approved, 1).otherwise(0).alias("Loan_Status"),
    )
