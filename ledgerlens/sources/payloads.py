"""Payloads of open shape: VARIANT columns, typed fields by path, and what else a payload holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def open_payloads(df: DataFrame, payload: str, fields: dict[str, tuple[str, str]], keep: list[str] = ()) -> DataFrame:
    """(keep, valid, fields, other): JSON texts parsed once into a VARIANT.

    ``fields`` gives each column's path and type, as in
    ``{"score": ("$.scores.overall", "double")}``; a value that is missing or of
    another type is NULL. ``other`` maps every other top-level name to its
    value as JSON, so that fields nobody asked for are kept. A payload that
    isn't JSON has ``valid`` false and nothing else; a NULL one too.
    """
    parsed = df.select(*keep, F.try_parse_json(F.col(payload)).alias("_v"))
    held = {path.removeprefix("$.").split(".")[0].split("[")[0] for path, _ in fields.values()}
    named = [F.try_variant_get("_v", path, kind).alias(name) for name, (path, kind) in fields.items()]
    # Values that aren't objects have no names.
    names = F.try_variant_get("_v", "$", "map<string, variant>")
    other = F.transform_values(F.map_filter(names, lambda k, _: ~k.isin(*held)), lambda _, v: F.to_json(v))
    return parsed.select(*keep, F.col("_v").isNotNull().alias("valid"), *named, other.alias("other"))


def payload_schema(df: DataFrame, payload: str) -> DataFrame:
    """(n_rows, n_valid, schema): the one shape that all payloads fit, merged by an aggregate over all rows."""
    v = F.try_parse_json(F.col(payload))
    return df.agg(F.count("*").alias("n_rows"), F.count(v).alias("n_valid"), F.schema_of_variant_agg(v).alias("schema"))
