"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH = "spark.checkpoint.dir"
_local_scratch: str | None = None


def build_session(app_name: str = "tidemark", master: str | None = None,
                  **settings: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for local runs."""
    global _local_scratch
    named = spark.conf.get(_SCRATCH, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {_SCRATCH} to a folder all executors can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: every later consumer sees the same rows in the same files,
    also after an executor is lost, and the planner knows the true size.
    """
    spark = df.sparkSession
    path = (f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
            f"/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_count(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """Rows over at least as many partitions as the session shuffles into.

    For row sets that are read many times by heavy work, before ``materialise``.
    """
    return df.repartition(spread_count(df.sparkSession))


def release_scratch(spark: SparkSession) -> None:
    """Delete what ``materialise`` wrote in this application."""
    path = f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
