"""The document layers, each stored once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlens.operators.documents import bronze, gold_chunks, gold_eval, silver
from ledgerlens.session import written


@dataclass
class Layers:
    bronze: DataFrame
    silver: DataFrame
    gold_chunks: DataFrame
    gold_eval: DataFrame


def build_layers(train: DataFrame, eval_: DataFrame, store=written) -> Layers:
    """Bronze to gold. Cleaning runs once: both gold tables read the stored silver one.

    ``store(df, name)`` writes a table and returns it read back.
    """
    raw = store(bronze(train, eval_), "bronze")
    clean = store(silver(raw), "silver")
    return Layers(raw, clean, store(gold_chunks(clean), "gold-chunks"), store(gold_eval(clean), "gold-eval"))
