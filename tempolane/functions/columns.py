"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig


def div(a: Column, b) -> Column:
    """Integer division, exact for BIGINT (a double would lose digits)."""
    return F.call_function("div", a, F.lit(b).cast("bigint") if isinstance(b, int) else b)


def scale(x: Column, lo: Column, hi: Column) -> Column:
    """To [0, 1] by the training range. A constant column becomes 0."""
    return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


def unscale(x: Column, lo: Column, hi: Column) -> Column:
    return x * (hi - lo) + lo


def required(name: str) -> Column:
    """The value as a double; a missing one stops the job."""
    value = F.col(name).cast("double")
    return F.when(
        value.isNull() | F.isnan(value), F.raise_error(F.lit(f"missing value in column {name}"))
    ).otherwise(value).alias(name)


def plan_columns(n: Column, cfg: ForecastConfig) -> dict[str, Column]:
    """Sizes of the chronological split for a series of `n` rows.

    Examples are counted in whole mini-batches; the newest ones are the test
    part and the oldest examples that fill no mini-batch are lost."""
    total = F.greatest(n - cfg.window, F.lit(0)).cast("bigint")
    batches = div(total, cfg.batch)
    # DOUBLE, not DECIMAL; the cast truncates.
    n_test = (batches * F.lit(float(cfg.test_ratio))).cast("bigint")
    n_train = batches - n_test
    return {
        "total_size": total,
        "n_batches": batches,
        "n_test": n_test,
        "n_train": n_train,
        "train_size": n_train * cfg.batch,
        "test_size": n_test * cfg.batch,
        "lost": total - batches * cfg.batch,
    }


def plan_error(n: Column, cfg: ForecastConfig) -> Column:
    """Why a series of `n` rows cannot be modelled; null if it can."""
    plan = plan_columns(n, cfg)
    return (
        F.when(plan["n_test"] <= 1, F.lit("too few test batches: raise test_ratio or lower batch"))
        .when(F.lit(cfg.steps >= cfg.window), F.lit("steps must be smaller than window"))
        .when(F.lit(cfg.batch) > div(plan["total_size"], 2), F.lit("batch is too big for this series"))
    )
