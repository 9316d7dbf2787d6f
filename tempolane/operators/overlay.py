"""Actual, check and forecast values side by side, and their error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions.columns import plan_columns
from tempolane.operators.heads import to_long
from tempolane.operators.position import with_position


def overlay(
    df: DataFrame,
    check: DataFrame,
    forecast: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    align: str = "true",
) -> DataFrame:
    """(keys, pos, target, actual, check, forecast), missing values null.

    `align="true"` puts predictions at the rows they belong to. `align="tail"`
    draws the check rows over the last known rows and the forecast after them."""
    keys = list(spec.keys)
    rows = with_position(df, spec, cfg.long_rows)
    check, forecast = to_long(check, spec), to_long(forecast, spec)
    if align == "tail":
        # The number of check rows follows from the plan; nothing is counted.
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        check_rows = (plan_columns(F.col("n"), cfg)["n_test"] - 1) * (cfg.steps + 1) + 1
        shift = F.col("n") - check_rows + F.col("batch") * (cfg.steps + 1) + F.col("step")
        check = _with_sizes(check, sizes, keys, shift)
        forecast = _with_sizes(forecast, sizes, keys, F.col("n") + F.col("step") - 1)
    elif align != "true":
        raise ValueError(f"align must be 'true' or 'tail', got {align!r}")
    place = [*keys, "pos", "target"]
    fitted = check.select(*place, F.col("value").alias("check")).join(
        forecast.select(*place, F.col("value").alias("forecast")), place, "full"
    )
    actual = to_long(rows.select(*keys, "pos", *spec.targets), spec).withColumnRenamed("value", "actual")
    return actual.join(fitted, place, "full")


def _with_sizes(predicted: DataFrame, sizes: DataFrame, keys: list[str], pos: Column) -> DataFrame:
    if keys:
        joined = predicted.join(sizes, keys)
    else:
        joined = predicted.withColumn("n", F.lit(sizes.first()["n"]))
    return joined.withColumn("pos", pos)


def mean_squared_error(predicted: DataFrame, y: Column, yhat: Column, by: list[str]) -> DataFrame:
    """`mse` of each group."""
    return predicted.groupBy(*by).agg(F.avg((y - yhat) * (y - yhat)).alias("mse"))
