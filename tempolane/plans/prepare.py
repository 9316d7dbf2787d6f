"""From raw rows to scaled rows and bounded pieces of series, ready for the network."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.operators.plan import SeriesError, with_plan
from tempolane.operators.position import Lanes, measure, position_lanes
from tempolane.operators.scaling import attach_scalers, scaled_columns, scaler_struct
from tempolane.operators.windows import into_blocks

PLACE = ("pos", "lost", "n_train", "n_test")


class Prepared(NamedTuple):
    lanes: Lanes
    tasks: int  # for steps that fix their own layout
    total: int  # rows of all series


def prepare(
    df: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    on_error: str = "raise",
    scalers: DataFrame | None = None,
) -> Prepared:
    """Lanes of (keys, pos, lost, n_train, n_test, xs, ys, scaler): the scaled
    row as input and as label, oldest lost rows left out.

    One shuffle for short series: numbering, sizes and ranges share its layout.
    `on_error="skip"` leaves out series that fail `validate`."""
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', got {on_error!r}")
    sizes = measure(df, spec, cfg)
    if sizes.error and on_error == "raise":
        raise SeriesError(sizes.error)
    tasks = sizes.tasks(df.sparkSession)
    lanes = position_lanes(df, spec, cfg.long_rows, sizes, tasks).map(lambda rows: with_plan(rows, cfg))
    xs, ys = scaled_columns(spec)
    scaled = attach_scalers(lanes, spec, cfg, scalers).map(
        lambda rows: rows.select(
            *spec.keys, *PLACE, xs.alias("xs"), ys.alias("ys"), scaler_struct(spec).alias("scaler")
        )
    )
    return Prepared(scaled, tasks, sizes.total)


def row_in_plan() -> Column:
    """Number of a row, counted from the first example."""
    return F.col("pos") - F.col("lost")


def in_training(cfg: ForecastConfig) -> Column:
    """Rows that training examples or their labels use."""
    return row_in_plan() < F.col("n_train") * cfg.batch + cfg.window


def pieces(
    rows: DataFrame,
    spec: SeriesSpec,
    examples: int,
    reach: int,
    used: Column,
    count: Column,
    tasks: int | None,
) -> DataFrame:
    """Records of at most `examples` consecutive examples, with all their rows:
    (keys, piece, lost, n_train, n_test, xs, ys, scaler), rows flattened into
    arrays. A piece holds examples piece*examples.. and overlaps the next by
    `reach` rows, so that it can be worked on alone, wherever it runs. `used`
    selects the rows and `count` is the number of examples that are needed.

    Pieces are laid out freely over `tasks`, or keep to the layout of their
    series if there is no such number."""
    keys = list(spec.keys)
    cut = into_blocks(rows.where(used), row_in_plan(), examples, reach, "piece").where(
        F.col("piece") * examples < count
    )
    if tasks:
        cut = cut.repartition(tasks, *keys, "piece")
    # Groups of at most examples + reach rows.
    return (
        cut.groupBy(*keys, "piece")
        .agg(
            *[F.first(c).alias(c) for c in ("lost", "n_train", "n_test", "scaler")],
            F.sort_array(F.collect_list(F.struct("pos", "xs", "ys"))).alias("rows"),
        )
        .select(
            *keys, "piece", "lost", "n_train", "n_test", "scaler",
            F.flatten("rows.xs").alias("xs"),
            F.flatten("rows.ys").alias("ys"),
        )
    )


def first_row_of(mark: Column, value: Column) -> Column:
    """A value once per series instead of on every row."""
    return F.when(mark, value)


def in_series_order(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    return rows.sortWithinPartitions(*spec.keys, "pos")
