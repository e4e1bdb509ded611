"""Table, CSV and JSON-record sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(
    spark: SparkSession, name: str, directory: str | None = None, schema: str | T.StructType | None = None
) -> DataFrame:
    """A catalog table, or ``directory/name.parquet``.

    A given schema saves the job that would look for it in the files.
    """
    if directory is None:
        return spark.read.table(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Deal a scan's rows out by the hash of a unique key: the caller's choice.

    For a file with one row group, which is one task however heavy the work on
    its rows. A table of many files needs no such shuffle.
    """
    return scan.repartition(F.col(key))


def save(df: DataFrame, target: str, format: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    """Replace a stored table, schema included.

    ``target`` is a path when it holds a slash, a catalog name otherwise.
    """
    writer = df.write.format(format).mode(mode).options(**options)
    if format == "delta":
        writer = writer.option("overwriteSchema", "true")
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def load_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """CSV with a header; values that do not fit the schema become NULL."""
    return spark.read.schema(schema).options(header=True, mode="PERMISSIVE", **options).csv(path)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    df.write.mode(mode).options(header=True, **options).csv(path)


def explode_records(df: DataFrame, col: str, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Rows out of scoring payloads, one per record.

    Reads both forms: ``{"dataframe_records": [{..}, ..]}`` and
    ``{"dataframe_split": {"columns": [..], "data": [[..], ..]}}``. In the
    split form a column is found by its position in ``columns``, so the order
    does not matter and missing columns are NULL. ``pos`` is the index of the
    record in its payload. A payload that cannot be read gives one row with
    ``valid`` false and nothing else; one that lists no records gives none.
    """
    payload_type = T.StructType(
        [
            T.StructField("dataframe_records", T.ArrayType(schema)),
            T.StructField(
                "dataframe_split",
                T.StructType(
                    [
                        T.StructField("columns", T.ArrayType(T.StringType())),
                        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
                    ]
                ),
            ),
        ]
    )
    payload = F.from_json(F.col(col), payload_type)

    def split_field(row: Column, names: Column, field: T.StructField) -> Column:
        position = F.array_position(names, field.name)
        value = F.when(position > 0, F.try_element_at(row, position.cast("int")))
        return value.try_cast(field.dataType).alias(field.name)

    names = F.col("_payload.dataframe_split.columns")
    from_split = F.transform(
        F.col("_payload.dataframe_split.data"),
        lambda row: F.struct(*[split_field(row, names, f) for f in schema.fields]),
    )
    # The outer form: for the inner one the optimizer adds a filter on the array's
    # size below it, and that filter would parse every payload again.
    return (
        df.select(*keep, payload.alias("_payload"))
        .select(*keep, F.coalesce(F.col("_payload.dataframe_records"), from_split).alias("_rows"))
        .withColumn("valid", F.col("_rows").isNotNull())
        .select(*keep, "valid", F.posexplode_outer("_rows").alias("pos", "_row"))
        .filter(F.col("pos").isNotNull() | ~F.col("valid"))
        .select(*keep, "valid", "pos", "_row.*")
    )


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Row counts of several tables as one result, one row per table."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows") for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)
