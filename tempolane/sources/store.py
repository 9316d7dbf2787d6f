"""Saved models: a table with one row per series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig


# Hidden from readers of the folder above it.
RANGES = "_ranges"


def save_model(models: DataFrame, path: str, save_updater: bool | None = None, ranges: DataFrame | None = None) -> None:
    """Write trained models; fails if `path` exists. The state of the updater is
    kept only if asked for, by default as the models' own configuration says.
    `ranges` (keys, scaler) of the series of a model for all go along with it."""
    if save_updater is None:
        keep = F.get_json_object("config", "$.save_updater") == "true"
        models = models.withColumn("updater", F.when(keep, F.col("updater")))
    elif not save_updater:
        models = models.withColumn("updater", F.lit(None).cast("array<double>"))
    models.write.mode("errorifexists").parquet(path)
    if ranges is not None:
        ranges.write.parquet(f"{path}/{RANGES}")


def load_model(spark: SparkSession, path: str) -> DataFrame:
    """Models to score with, without training."""
    return spark.read.parquet(path)


def load_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(keys, scaler) stored with a model for all series."""
    return spark.read.parquet(f"{path}/{RANGES}")


def model_config(models: DataFrame) -> ForecastConfig:
    """The configuration models were trained with."""
    return ForecastConfig.from_json(models.select("config").first()["config"])
