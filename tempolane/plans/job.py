"""The whole job: train or load, report the fit, forecast, and keep the results."""

from __future__ import annotations

import time
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.operators.heads import slice_steps
from tempolane.plans.score import score_heads
from tempolane.plans.train import train_per_series, train_pooled, training_stats
from tempolane.sources.series import write_check, write_forecast
from tempolane.sources.shared import new_path, settled
from tempolane.sources.store import load_model, load_ranges, model_config, save_model


class JobResult(NamedTuple):
    run_id: str
    models: DataFrame
    check: DataFrame
    forecast: DataFrame


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.text(path).inputFiles())
    except AnalysisException:
        return False


def forecast_job(
    df: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig | None,
    output: str,
    *,
    model_name: str | None = None,
    model_path: str | None = None,
    pooled: bool = False,
    rounds_per_epoch: int | None = None,
    warm: bool = True,
    refit_scaler: bool = True,
    on_error: str = "raise",
    run_id: str | None = None,
    fmt: str = "parquet",
) -> JobResult:
    """Write `output`/check and `output`/forecast, each partitioned by run, and
    `output`/stats if a model was trained.

    `model_path` names saved models to use instead of training; without `cfg` the
    configuration is theirs, and one that disagrees with their network stops the
    job. `model_name` saves the trained ones as `output`/<model_name>. An empty
    text is no name. A name or a run that is there already is refused at once."""
    spark = df.sparkSession
    if run_id and _exists(spark, f"{output}/check/run_id={run_id}"):
        raise ValueError(f"run {run_id!r} has results already")
    if model_name and not model_path and _exists(spark, f"{output}/{model_name}"):
        raise ValueError(f"[PATH_ALREADY_EXISTS] a model {model_name!r} is there already")
    run_id = run_id or f"{int(time.time())}-{uuid.uuid4().hex[:8]}"
    if cfg is None and not model_path:
        raise ValueError("training needs a configuration")
    ranges = None
    if model_path:
        models = load_model(spark, model_path)
        if not refit_scaler and not all(k in models.columns for k in spec.keys):
            ranges = load_ranges(spark, model_path)
        cfg = cfg or model_config(models)
    else:
        if pooled:
            models, stats, ranges = train_pooled(df, spec, cfg, rounds_per_epoch, on_error, model_name or None)
        else:
            models, stats = train_per_series(df, spec, cfg, on_error, model_name or None), None
        if model_name:
            save_model(models, f"{output}/{model_name}", ranges=ranges)
            models = load_model(spark, f"{output}/{model_name}")
        else:
            models = settled(models, new_path(spark, "models"))
        found = training_stats(models, run_id).drop("run_id") if stats is None else stats
        found.write.mode("append").parquet(f"{output}/stats/run_id={run_id}")
    # Scored once; check and forecast are two cuts of the same heads.
    heads = settled(
        score_heads(df, models, spec, cfg, warm, on_error, refit_scaler, ranges=ranges), new_path(spark, "heads")
    )
    check = slice_steps(heads, spec, cfg, "check")
    forecast = slice_steps(heads, spec, cfg, "forecast")
    write_check(check, spec, f"{output}/check", run_id, fmt)
    write_forecast(forecast, spec, f"{output}/forecast", run_id, fmt)
    return JobResult(run_id, models, check, forecast)
