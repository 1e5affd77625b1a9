"""Saved models, plain or versioned (versions are our extension)."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve.functions.times import new_batch_ts

REGISTRY_SCHEMA = "version int, path string, saved_ts timestamp, coefficients array<double>, intercept double"


def _registry_path(path: str) -> str:
    return f"{path.rstrip('/')}/registry"


def save_model(
    model: PipelineModel, path: str, *, version: int | None = None, saved_ts: datetime | None = None
) -> str:
    """Save; returns where.  Without a version an earlier model is replaced.

    With ``version`` the model goes to a folder of its own and a line about it
    is added to a Parquet table next to it.  A version never changes: saving
    one that exists is refused.
    """
    if version is None:
        model.write().overwrite().save(path)
        return path
    target = f"{path.rstrip('/')}/v{version}"
    model.save(target)
    lr = model.stages[-1]
    line = (
        version,
        target,
        saved_ts or new_batch_ts(),
        [float(c) for c in lr.coefficients],
        float(lr.intercept),
    )
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([line], REGISTRY_SCHEMA).write.mode("append").parquet(_registry_path(path))
    return target


def registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per version, the last save of each."""
    lines = spark.read.schema(REGISTRY_SCHEMA).parquet(_registry_path(path))
    newest = lines.groupBy("version").agg(F.max_by(F.struct("*"), "saved_ts").alias("line"))
    return newest.select("line.*")


def load_model(spark: SparkSession, path: str, *, version: int | str | None = None) -> PipelineModel:
    """Load a model; ``version`` is a number or "latest"."""
    if version is None:
        return PipelineModel.load(path)
    if version == "latest":
        version = registry(spark, path).agg(F.max("version")).first()[0]
    return PipelineModel.load(f"{path.rstrip('/')}/v{version}")
