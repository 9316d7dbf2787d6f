"""How each series is split into lost, train and test examples, and whether it can be."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions.columns import div, plan_columns, plan_error

PLAN = ("total_size", "n_batches", "n_test", "n_train", "train_size", "test_size", "lost")


class SeriesError(ValueError):
    """A series cannot be modelled under the given configuration."""


def split_plan(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig) -> DataFrame:
    """One row per series: n, total_size, n_batches, n_test, n_train, train_size,
    test_size, lost."""
    spec.check(df.schema)
    sizes = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))
    plan = plan_columns(F.col("n"), cfg)
    return sizes.select(*spec.keys, "n", *[plan[c].alias(c) for c in PLAN])


def validate(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig) -> DataFrame:
    """(keys, error) of every series that cannot be modelled; empty if all can."""
    spec.check(df.schema)
    missing = functools.reduce(
        lambda a, b: a | b, [F.col(v).isNull() | F.isnan(F.col(v).cast("double")) for v in spec.values]
    )
    sizes = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or(missing), F.lit(False)).alias("_tl_missing")
    )
    error = F.when(F.col("_tl_missing"), F.lit("missing values")).otherwise(plan_error(F.col("n"), cfg))
    return sizes.select(*spec.keys, error.alias("error")).where(F.col("error").isNotNull())


def require_valid(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig) -> None:
    """Raise on the first series that fails `validate`."""
    bad = validate(df, spec, cfg).first()
    if bad is not None:
        name = {k: bad[k] for k in spec.keys} or "series"
        raise SeriesError(f"{name}: {bad['error']}")


def with_plan(rows: DataFrame, cfg: ForecastConfig, on_error: str = "skip") -> DataFrame:
    """Add the split sizes to positioned rows and leave out rows that no example
    uses: the oldest `lost` rows, and with `on_error="skip"` series that fail the
    plan; with "raise" such a series stops the job. Pure arithmetic on `n`, so
    that nothing has to be joined, and done before any example exists."""
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")
    plan, error = plan_columns(F.col("n"), cfg), plan_error(F.col("n"), cfg)
    fits = error.isNull()
    if on_error == "raise":
        fits = F.when(fits, F.lit(True)).otherwise(F.raise_error(error).cast("boolean"))
    return (
        rows.where(fits & (F.col("pos") >= plan["lost"]))
        .withColumns({c: plan[c] for c in ("lost", "n_train", "n_test")})
    )


def example_columns(i, cfg: ForecastConfig) -> dict:
    """Split, mini-batch and slot of example `i`, given the plan columns."""
    at = i - F.col("lost")
    return {
        "split": F.when(at < F.col("n_train") * cfg.batch, F.lit("train")).otherwise(F.lit("test")),
        "batch": div(at, cfg.batch),
        "slot": (at % cfg.batch).cast("int"),
    }
