"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction type codes.
TYPE_CODES = {"TRANSFER": 0, "CASH_OUT": 1, "PAYMENT": 2, "CASH_IN": 3, "DEBIT": 4}

# Names of the answer languages.
LANGUAGE_NAMES = {
    "tamil": "Tamil",
    "english": "English",
    "telugu": "Telugu",
    "kannada": "Kannada",
    "malayalam": "Malayalam",
    "bengali": "Bengali",
    "marathi": "Marathi",
    "gujarati": "Gujarati",
}


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(0.0)


def guarded_log1p(value: Column) -> Column:
    return F.when(value > 0, F.log1p(value)).otherwise(0.0)


def share_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def f1_score(precision: Column, recall: Column) -> Column:
    total = precision + recall
    return F.when(total > 0, 2 * (precision * recall) / total).otherwise(0.0)


def risk_tier(rate_pct: Column) -> Column:
    return F.when(rate_pct > 10, "HIGH").when(rate_pct >= 5, "MEDIUM").otherwise("LOW")


def code_map(col: Column, codes: dict[str, int]) -> Column:
    """Look a category up in a fixed map; unknown categories give NULL."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def language_name(col: Column) -> Column:
    """Display name of a target language, English for any other text."""
    pairs = [F.lit(x) for item in LANGUAGE_NAMES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(col)), F.lit("English"))


def preview(col: Column, n: int) -> Column:
    """The first ``n`` characters and an ellipsis, for display only."""
    return F.concat(F.substring(col, 1, n), F.lit("..."))


def class_probability(col: Column, index: int = 1) -> Column:
    """One class's probability out of an ML probability vector."""
    return F.element_at(vector_to_array(col), index + 1)


def decide(
    probability: Column, threshold: float | Column, labels: tuple[str, str] = ("SAFE", "FRAUD")
) -> dict[str, Column]:
    """Flag (``p >= t``), label and confidence for a probability column."""
    hit = probability >= (F.lit(threshold) if isinstance(threshold, (int, float)) else threshold)
    return {
        "flag": F.when(hit, 1).when(~hit, 0),
        "label": F.when(hit, labels[1]).when(~hit, labels[0]),
        "confidence": F.greatest(probability, 1 - probability),
    }
