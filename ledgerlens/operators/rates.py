"""Target-mean rates, fitted on training rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expressions import flag
from ledgerlens.functions.hashing import hash_word
from ledgerlens.plans.running import running_sum
from ledgerlens.session import written

# Fixed value: a state above this share of fraud is a high-fraud state.
HIGH_RATE = 0.05


def fit_rate(train: DataFrame, key: str = "state", label: str = "is_fraud") -> DataFrame:
    """Mean label per key."""
    return train.groupBy(key).agg(F.avg(label).alias("fraud_rate"))


def attach_rate(df: DataFrame, rates: DataFrame, key: str = "state") -> DataFrame:
    """Add the rate (0 for an unseen key) and the high-rate flag."""
    joined = df.drop("fraud_rate").join(rates, key, "left").fillna({"fraud_rate": 0.0})
    return joined.withColumn("high_fraud_state_flag", flag(F.col("fraud_rate") > HIGH_RATE))


def fold_rates(rows: DataFrame, key: str = "state", label: str = "is_fraud", fold: str = "fold") -> DataFrame:
    """Mean label per fold and key over the rows of all *other* folds.

    One grouping by fold and key; a fold's rows are subtracted from the key's
    totals. Keys that only one fold has get no row for it.
    """
    part = rows.groupBy(fold, key).agg(F.sum(label).alias("_sum"), F.count(label).alias("_n"))
    whole = part.groupBy(key).agg(F.sum("_sum").alias("_all"), F.sum("_n").alias("_rows"))
    folds = part.select(fold).distinct()
    # Folds are few, so every key meets each of them.
    listed = whole.withColumn(fold, F.explode(folds.agg(F.collect_set(fold)).scalar()))
    kept = listed.alias("a").join(
        part.alias("b"), (F.col(f"a.{fold}") == F.col(f"b.{fold}")) & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "left"
    )
    others = F.col("_rows") - F.coalesce("_n", F.lit(0))
    rate = (F.col("_all") - F.coalesce("_sum", F.lit(0))) / others
    return kept.filter(others > 0).select(F.col(f"a.{fold}"), F.col(f"a.{key}"), rate.alias("fraud_rate"))


def ordered_rates(df: DataFrame, category: str, label: str, key: str, weight: float = 1.0, seed: int = 42) -> DataFrame:
    """Add ``ordered_rate``: the mean label of the rows of the same category before this one, in a hashed order.

    No row sees its own label or that of a later one, so a model can be trained
    on the rate of the rows it was made from. The overall mean counts as
    ``weight`` more rows. Rows without a label get a rate and add nothing to
    others'; a null category is one of its own. ``key`` must be unique.

    The order goes over all rows, category by category, and running totals are
    taken per range of it: a category with most of the rows is in many ranges.
    """
    n, y = F.col(label).isNotNull().cast("int"), F.coalesce(F.col(label).cast("double"), F.lit(0.0))
    order = F.struct(F.col(category), hash_word(F.col(key), seed), F.col(key))
    rows = running_sum(df.withColumns({"_n": n, "_y": y, "_order": order}), "_order", ["_n", "_y"])
    before = {"_n": F.col("sum__n") - F.col("_n"), "_y": F.col("sum__y") - F.col("_y")}
    rows = rows.withColumns({f"{c}_before": value for c, value in before.items()})
    # What all smaller categories have in total: one row a category.
    first = F.min_by(F.struct("_n_before", "_y_before"), "_order").alias("_f")
    start = written(rows.groupBy(F.col(category).alias("_category")).agg(first), "category-starts")
    met = rows.join(start, F.col(category).eqNullSafe(F.col("_category")))
    mean = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    rate = (F.col("_y_before") - F.col("_f._y_before") + weight * mean) / (F.col("_n_before") - F.col("_f._n_before") + weight)
    return met.withColumn("ordered_rate", rate).select(*df.columns, "ordered_rate")


def smoothed_rates(train: DataFrame, category: str, label: str, weight: float = 1.0) -> DataFrame:
    """The rate of each category over all training rows, with the same weight of the overall mean: for new rows."""
    y = F.col(label).cast("double")
    mean = train.agg(F.avg(y)).scalar()
    return train.groupBy(category).agg(((F.coalesce(F.sum(y), F.lit(0.0)) + weight * mean) / (F.count(label) + weight)).alias("ordered_rate"))
