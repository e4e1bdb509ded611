"""Fitted pipelines with their metadata, and the log of runs."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_META = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("states", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("importances", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("version", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("saved_on", T.DateType()),
    ]
)

_RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


@dataclass
class SavedModel:
    """Everything a scorer needs besides the transactions."""

    model: PipelineModel
    threshold: float
    features: list[str] = field(default_factory=list)
    metrics: dict[str, float] = field(default_factory=dict)
    states: list[str] = field(default_factory=list)
    description: str = ""
    rates: DataFrame | None = None
    infra: DataFrame | None = None
    importances: dict[str, float] = field(default_factory=dict)
    version: str = ""
    model_type: str = ""
    saved_on: datetime.date | None = None


def save_model(spark: SparkSession, saved: SavedModel, path: str) -> None:
    """Write pipeline, metadata (a one-row table), state rates and infrastructure under ``path``."""
    saved.model.write().overwrite().save(f"{path}/pipeline")
    row = (
        saved.features,
        float(saved.threshold),
        {k: float(v) for k, v in saved.metrics.items()},
        saved.states,
        saved.description,
        {k: float(v) for k, v in saved.importances.items()},
        saved.version,
        saved.model_type or type(saved.model.stages[-1]).__name__,
        saved.saved_on or datetime.date.today(),
    )
    spark.createDataFrame([row], _META).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    if saved.rates is not None:
        saved.rates.write.mode("overwrite").parquet(f"{path}/rates")
    if saved.infra is not None:
        saved.infra.write.mode("overwrite").parquet(f"{path}/infra")


def load_model(spark: SparkSession, path: str, with_rates: bool = True) -> SavedModel:
    meta = spark.read.schema(_META).parquet(f"{path}/meta").first()
    return SavedModel(
        model=PipelineModel.load(f"{path}/pipeline"),
        threshold=meta["threshold"],
        features=list(meta["features"] or []),
        metrics=dict(meta["metrics"] or {}),
        states=list(meta["states"] or []),
        description=meta["description"],
        rates=spark.read.parquet(f"{path}/rates") if with_rates else None,
        infra=table_if_any(spark, f"{path}/infra"),
        importances=dict(meta["importances"] or {}),
        version=meta["version"] or "",
        model_type=meta["model_type"] or "",
        saved_on=meta["saved_on"],
    )


def table_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """A table, or None where nothing was written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    return spark.read.parquet(path) if there else None


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: dict[str, object] | None = None,
    metrics: dict[str, float] | None = None,
) -> None:
    """Append one run's parameters and metrics to the run table."""
    rows = [(run_id, "param", k, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, repr(float(v))) for k, v in (metrics or {}).items()]
    spark.createDataFrame(rows, _RUN).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_RUN).parquet(path)
