"""Min-max scaling by the training part of each series.

Inputs and labels are scaled by different ranges, because a label lies `window`
rows after the start of its example. Both ranges are intervals of positions, so
the minimum and maximum need the rows only, not the (window times larger) examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions.columns import scale, unscale
from tempolane.operators.plan import with_plan
from tempolane.operators.position import Lanes, position_lanes

ROLES = ("feature", "label")


def _in_training(role: str, cfg: ForecastConfig) -> Column:
    """Whether a row is seen in this role by any training example."""
    at = F.col("pos") - F.col("lost")
    train = F.col("n_train") * cfg.batch
    if role == "feature":
        return (at >= 0) & (at < train + cfg.window - 1)
    return (at >= cfg.window) & (at < train + cfg.window)


def scaler_fields(spec: SeriesSpec) -> list[tuple[str, str, str]]:
    """(role, variable, column name of the minimum); the maximum ends in `_max`."""
    return [("feature", v, f"_tl_f_{v}") for v in spec.values] + [
        ("label", t, f"_tl_l_{t}") for t in spec.targets
    ]


def scaler_aggregates(spec: SeriesSpec, cfg: ForecastConfig) -> dict[str, Column]:
    out = {}
    for role, variable, name in scaler_fields(spec):
        seen = F.when(_in_training(role, cfg), F.col(variable))
        out[f"{name}_min"] = F.min(seen)
        out[f"{name}_max"] = F.max(seen)
    return out


def series_scalers(rows: DataFrame, spec: SeriesSpec, cfg: ForecastConfig) -> DataFrame:
    """One row per series with its minima and maxima, from rows with a plan.
    Partial aggregation first: long series cost no more than short ones."""
    found = scaler_aggregates(spec, cfg)
    return rows.groupBy(*spec.keys).agg(*[c.alias(name) for name, c in found.items()])


def fit_minmax(
    df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, roles: tuple[str, ...] = ROLES, on_error: str = "raise"
) -> DataFrame:
    """(keys, role, variable, min, max)."""
    lanes = position_lanes(df, spec, cfg.long_rows).map(lambda rows: with_plan(rows, cfg, on_error))
    # Each lane on its own: the short one is already laid out by series.
    fitted = lanes.map(lambda rows: series_scalers(rows, spec, cfg)).union()
    cells = [
        F.struct(
            F.lit(role).alias("role"),
            F.lit(variable).alias("variable"),
            F.col(f"{name}_min").alias("min"),
            F.col(f"{name}_max").alias("max"),
        )
        for role, variable, name in scaler_fields(spec)
        if role in roles
    ]
    return fitted.select(*spec.keys, F.explode(F.array(*cells)).alias("cell")).select(*spec.keys, "cell.*")


def attach_scalers(
    lanes: Lanes, spec: SeriesSpec, cfg: ForecastConfig, scalers: DataFrame | None = None
) -> Lanes:
    """Add each series' minima and maxima to its rows.

    In the short lane by a window over the series, without a shuffle of its own.
    In the long lane by a join with one row a series, which is broadcast if small.
    `scalers` replaces the fit by stored ranges."""
    found = scaler_aggregates(spec, cfg)
    keys = list(spec.keys)

    def constant(rows: DataFrame, table: DataFrame) -> DataFrame:
        one = table.first()  # without keys there is one series
        return rows.withColumns({c: F.lit(one[c]) for c in found})

    def short(rows: DataFrame) -> DataFrame:
        if scalers is not None:
            return rows.join(scalers, keys, "left") if keys else constant(rows, scalers)
        series = Window.partitionBy(*keys)
        return rows.withColumns({name: c.over(series) for name, c in found.items()})

    def long(rows: DataFrame) -> DataFrame:
        table = series_scalers(rows, spec, cfg) if scalers is None else scalers
        if not keys:
            return constant(rows, table)
        if scalers is not None:
            table = scalers.join(lanes.names, keys, "left_semi")
        return rows.join(lanes.sent(table, len(found)), keys, "left")

    return lanes.map(short, long)


def _unit(x: Column, name: str) -> Column:
    return scale(x, F.col(f"{name}_min"), F.col(f"{name}_max"))


def scaled_columns(spec: SeriesSpec) -> tuple[Column, Column]:
    """The row as input and as label: two DOUBLE arrays."""
    parts = {"feature": [], "label": []}
    for role, variable, name in scaler_fields(spec):
        parts[role].append(_unit(F.col(variable), name))
    return F.array(*parts["feature"]), F.array(*parts["label"])


def scaler_struct(spec: SeriesSpec) -> Column:
    """All minima and maxima of a series as one struct of arrays."""
    names = {role: [n for r, _, n in scaler_fields(spec) if r == role] for role in ROLES}
    return F.struct(
        F.array(*[F.col(f"{n}_min") for n in names["feature"]]).alias("f_min"),
        F.array(*[F.col(f"{n}_max") for n in names["feature"]]).alias("f_max"),
        F.array(*[F.col(f"{n}_min") for n in names["label"]]).alias("l_min"),
        F.array(*[F.col(f"{n}_max") for n in names["label"]]).alias("l_max"),
    )


def unpack_scalers(models: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Model rows back to the columns `attach_scalers` joins."""
    out = []
    for role, lo, hi in (("feature", "f_min", "f_max"), ("label", "l_min", "l_max")):
        names = [n for r, _, n in scaler_fields(spec) if r == role]
        for at, name in enumerate(names):
            out.append(F.get(f"scaler.{lo}", F.lit(at)).alias(f"{name}_min"))
            out.append(F.get(f"scaler.{hi}", F.lit(at)).alias(f"{name}_max"))
    return models.select(*spec.keys, *out)


def scale_rows(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, on_error: str = "raise") -> DataFrame:
    """(keys, pos, role, variable, value, scaled) of every row an example uses.
    Scaled test values can leave [0, 1]."""
    lanes = position_lanes(df, spec, cfg.long_rows).map(lambda rows: with_plan(rows, cfg, on_error))
    rows = attach_scalers(lanes, spec, cfg).union()
    cells = [
        F.struct(
            F.lit(role).alias("role"),
            F.lit(variable).alias("variable"),
            F.col(variable).alias("value"),
            _unit(F.col(variable), name).alias("scaled"),
            F.col(f"{name}_min").alias("min"),
            F.col(f"{name}_max").alias("max"),
        )
        for role, variable, name in scaler_fields(spec)
    ]
    return rows.select(*spec.keys, "pos", F.explode(F.array(*cells)).alias("cell")).select(
        *spec.keys, "pos", "cell.*"
    )


def unscale_rows(scaled: DataFrame) -> DataFrame:
    """The inverse, on the output of `scale_rows`; needs its `min` and `max`."""
    return scaled.withColumn("restored", unscale(F.col("scaled"), F.col("min"), F.col("max")))
