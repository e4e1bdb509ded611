"""Per-state payment infrastructure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names of the source table.
RENAMED = {
    "State/UT": "state",
    "No. of PoS devices sanctioned": "pos_devices",
    "Amount sanctioned in lakh": "gov_amount",
}


def normalise_infra(df: DataFrame) -> DataFrame:
    """Plain column names and number types; unreadable numbers become NULL, unknown states go."""
    return (
        df.withColumnsRenamed(RENAMED)
        .filter(F.col("state").isNotNull())
        .withColumns(
            {
                "pos_devices": F.col("pos_devices").try_cast("int"),
                "gov_amount": F.col("gov_amount").try_cast("double"),
            }
        )
    )


def infra_by_state(df: DataFrame) -> DataFrame:
    """Sanctioned devices and amount per state, from a normalised table."""
    return df.groupBy("state").agg(
        F.sum("pos_devices").alias("total_pos_devices"),
        F.sum("gov_amount").alias("total_gov_amount_lakh"),
    )
