"""Features of single transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import TYPE_CODES, code_map, flag, guarded_log1p, guarded_ratio

# Defaults for a state without infrastructure.
INFRA_DEFAULTS = {"total_pos_devices": 0, "total_gov_amount_lakh": 0.0}

# Input columns of a raw batch, and of an engineered one.
RAW_COLUMNS = [
    "step", "nameOrig", "type", "amount",
    "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
]

NUMERIC_FEATURES = [
    "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "total_pos_devices", "total_gov_amount_lakh", "fraud_rate", "amount_to_gov_ratio",
    "pos_density_flag", "high_fraud_state_flag", "log_gov_amount", "log_pos_devices",
    "balance_diff_orig", "balance_diff_dest", "orig_balance_zero_flag",
]

ENGINEERED_COLUMNS = [*NUMERIC_FEATURES, "type_index"]


def rename_labels(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"isFraud": "is_fraud", "isFlaggedFraud": "is_flagged_fraud"})


def enrich(txn: DataFrame, infra: DataFrame) -> DataFrame:
    """Add the totals of the transaction's state; NULL where the state has none."""
    return txn.join(infra, "state", "left")


def txn_features(df: DataFrame, fill: str = "before", ratio: str = "plain") -> DataFrame:
    """Ratio, flag, log and balance features of enriched transactions.

    ``fill`` says whether missing infrastructure is set to 0 before the
    features are computed (the flag for few devices is then 1, as when
    scoring) or after (the flag is 0). Training and scoring must agree, so
    both use "before" here. ``ratio="plus_one"`` divides by ``amount + 1``
    without a guard, as the entry form does.
    """
    if fill not in ("before", "after") or ratio not in ("plain", "plus_one"):
        raise ValueError(f"unknown option: fill={fill!r}, ratio={ratio!r}")
    if fill == "before":
        df = df.fillna(INFRA_DEFAULTS)
    gov, devices = F.col("total_gov_amount_lakh"), F.col("total_pos_devices")
    amount = F.col("amount")
    out = df.withColumns(
        {
            "amount_to_gov_ratio": guarded_ratio(amount, gov) if ratio == "plain" else amount / (gov + 1.0),
            "pos_density_flag": flag(devices < 1000),
            "log_gov_amount": guarded_log1p(gov),
            "log_pos_devices": guarded_log1p(devices),
            "balance_diff_orig": F.col("oldbalanceOrg") - F.col("newbalanceOrig"),
            "balance_diff_dest": F.col("newbalanceDest") - F.col("oldbalanceDest"),
            "orig_balance_zero_flag": flag(F.col("oldbalanceOrg") == 0),
        }
    )
    return out.fillna(INFRA_DEFAULTS) if fill == "after" else out


def type_codes(df: DataFrame, codes: dict[str, int] = TYPE_CODES) -> DataFrame:
    """Add the fixed code of the transaction type, NULL for an unknown type."""
    return df.withColumn("type_index", code_map(F.col("type"), codes))


def detect_input(df: DataFrame) -> str:
    """``engineered`` or ``raw``, from the column names alone; engineered wins."""
    columns = set(df.columns)
    if columns.issuperset(ENGINEERED_COLUMNS):
        return "engineered"
    if columns.issuperset(RAW_COLUMNS):
        return "raw"
    missing = sorted(set(RAW_COLUMNS) - columns)
    raise ValueError(f"neither raw nor engineered transactions; a raw batch also needs {missing}")
