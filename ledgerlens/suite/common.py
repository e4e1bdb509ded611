"""Helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.infrastructure import infra_by_state, normalise_infra
from ledgerlens.operators.transactions import enrich, rename_labels, txn_features
from ledgerlens.plans.lookup import as_lookup, assign_state
from ledgerlens.sources import roles

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with another engine's summation order."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def infra_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_lookup(infra_by_state(normalise_infra(roles.infra(spark, sf_dir))), "infra")


def txn_with_state(spark: SparkSession, sf_dir: str, balances: bool = False, labels: bool = False) -> DataFrame:
    txn = rename_labels(roles.txn(spark, sf_dir, balances, labels))
    return assign_state(txn, "nameOrig", roles.states(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str, balances: bool = True, labels: bool = True) -> DataFrame:
    return enrich(txn_with_state(spark, sf_dir, balances, labels), infra_table(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    return txn_features(enriched(spark, sf_dir), **options)


def scored(spark: SparkSession, sf_dir: str, state: bool = False) -> DataFrame:
    """Labelled transactions with a score that needs no model: the share of the largest amount."""
    if state:
        df = enriched(spark, sf_dir, balances=False).fillna({"total_pos_devices": 0, "total_gov_amount_lakh": 0.0})
    else:
        df = rename_labels(roles.txn(spark, sf_dir, balances=False))
    largest = roles.txn(spark, sf_dir, balances=False, labels=False).agg(F.max("amount")).scalar()
    p = F.col("fraud_probability")
    return df.withColumn("fraud_probability", F.col("amount") / largest).withColumns(
        {"prediction": F.when(p >= 0.5, 1.0).otherwise(0.0), "fraud_flag": F.when(p >= 0.5, 1).otherwise(0)}
    )
