"""What the tests share."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def by(df: DataFrame, key: str) -> dict:
    return {r[key]: r for r in rows(df)}


def plan(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


# Five transactions of our own, with round numbers: step, nameOrig, type, amount, balances of both sides.
FIVE = [
    (101, "P-ada", "TRANSFER", 90.0, 100.0, 10.0, 5.0, 95.0),
    (102, "P-bo", "CASH_OUT", 40.0, 50.0, 10.0, 60.0, 100.0),
    (103, "P-cy", "PAYMENT", 1980.0, 2000.0, 20.0, 0.0, 1980.0),
    (104, "P-di", "TRANSFER", 9.0, 9.0, 0.0, 1.0, 10.0),
    (105, "P-ed", "CASH_OUT", 500.0, 700.0, 200.0, 0.0, 0.0),
]
FIVE_SCHEMA = (
    "step int, nameOrig string, type string, amount double, oldbalanceOrg double, newbalanceOrig double, "
    "oldbalanceDest double, newbalanceDest double"
)

# Invented states with devices, amount and rate; one more than most of them is a power or a round number.
FORM_STATES = {
    "north": (999, 9.0, 0.01), "south": (9, 99.0, 0.02), "east": (9999, 19.0, 0.03), "west": (99, 4.0, 0.04),
    "delta": (1000, 1.0, 0.05), "coast": (500, 49.0, 0.011), "hills": (1500, 24.0, 0.012), "lake": (49, 14.0, 0.013),
    "plain": (2999, 39.0, 0.014), "isle": (0, 0.0, 0.045),
}
