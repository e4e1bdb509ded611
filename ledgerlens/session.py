"""Session set-up for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "ledgerlens", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks; on a cluster use the session it gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine, since
    executors on other hosts could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            base = tempfile.mkdtemp(prefix="ledgerlens-")
            spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/ledgerlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch root, never used before."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts the lineage, so a lost executor re-reads files instead of re-running
    joins. The file size is also what the planner sees: a lookup table read
    back this way is broadcast only if it is below the broadcast threshold,
    and is joined by shuffle (with skew splitting) if it has grown past it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
