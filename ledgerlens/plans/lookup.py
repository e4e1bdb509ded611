"""Left joins to lookup tables, and the assignment of states."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import md5_mod
from ledgerlens.session import written


def as_lookup(df: DataFrame, name: str = "lookup") -> DataFrame:
    """Store an aggregated table so that its real size decides how it is joined.

    No broadcast hint is given: below ``spark.sql.autoBroadcastJoinThreshold``
    the planner broadcasts the files it can measure; above it the join
    shuffles, and adaptive execution splits hot keys.
    """
    return written(df, name)


@dataclass
class NumberedStates:
    """The sorted distinct states with their numbers from 0, stored, and how many there are."""

    table: DataFrame
    n: int


def number_states(states: DataFrame | list[str] | NumberedStates, spark: SparkSession | None = None) -> NumberedStates:
    """Number the states once; plans hand the result on instead of the states.

    Distinct states are far fewer than keys: they are numbered in one task and
    written by one job.
    """
    if isinstance(states, NumberedStates):
        return states
    if not isinstance(states, DataFrame):
        states = spark.createDataFrame([(s,) for s in states], "state string")
    distinct = states.select("state").dropna().distinct()
    numbered = distinct.withColumn("_bucket", F.row_number().over(Window.orderBy("state")) - 1)
    table = as_lookup(numbered, "numbered-states")
    return NumberedStates(table, table.count())


def assign_state(df: DataFrame, key: str, states: DataFrame | list[str] | NumberedStates) -> DataFrame:
    """Add ``state``, a stable choice per key out of the sorted states; NULL for a NULL key.

    The md5 of the key modulo the number of states is joined to the stored
    table of numbers: the same for few and many, for batches and streams.
    States that aren't numbered yet are numbered while the plan is built.
    """
    numbered = number_states(states, df.sparkSession)
    if not numbered.n:
        return df.withColumn("state", F.lit(None).cast("string"))
    return df.withColumn("_bucket", md5_mod(F.col(key), numbered.n)).join(numbered.table, "_bucket", "left").drop("_bucket")


def lookup_default(df: DataFrame, table: DataFrame, on: str, defaults: dict[str, object]) -> DataFrame:
    """Left join with a default for keys the table lacks."""
    return df.join(table, on, "left").fillna(defaults)
