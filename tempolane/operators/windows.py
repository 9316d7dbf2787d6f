"""Sliding examples: `window` rows and the row after them as label.

Short series use one window per key. For long ones, every row is sent to the
block that starts at or before it and, if it is among the first rows of a
block, to the block before as well (a halo). Blocks hold a bounded number of
rows and are worked on independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions.columns import div
from tempolane.operators.plan import example_columns, with_plan
from tempolane.operators.position import position_lanes

BLOCK_EXAMPLES = 4_096


def into_blocks(rows: DataFrame, at: Column, examples: int, reach: int, name: str) -> DataFrame:
    """Copy each row into every block of `examples` examples that needs it.

    `at` counts rows from the first example; example `a` uses rows a..a+reach."""
    first = F.greatest(div(at - reach, examples), F.lit(0).cast("bigint"))
    return rows.withColumn(name, F.explode(F.sequence(first, div(at, examples))))


def _frames(rows: DataFrame, spec: SeriesSpec, window: int, part: list[str]) -> DataFrame:
    by_pos = Window.partitionBy(*part).orderBy("pos")
    return rows.select(
        *part,
        "pos",
        *[c for c in ("n", "lost", "n_train", "n_test") if c in rows.columns],
        F.collect_list(F.struct(*spec.values)).over(by_pos.rowsBetween(0, window - 1)).alias("x"),
        F.lead(F.struct(*spec.targets), window).over(by_pos).alias("y"),
    ).where(F.col("y").isNotNull())


def _example_rows(lanes, spec: SeriesSpec, window: int, start: Column, block: int) -> DataFrame:
    keys = list(spec.keys)

    def long(rows: DataFrame) -> DataFrame:
        blocks = into_blocks(rows, F.col("pos") - start, block, window, "_tl_block")
        frames = _frames(blocks, spec, window, [*keys, "_tl_block"])
        # Halo rows start no example of their own block.
        return frames.where(div(F.col("pos") - start, block) == F.col("_tl_block")).drop("_tl_block")

    return lanes.map(lambda rows: _frames(rows, spec, window, keys), long).union()


def sliding_windows(
    df: DataFrame, spec: SeriesSpec, window: int, long_rows: int = 200_000, block: int = BLOCK_EXAMPLES
) -> DataFrame:
    """(keys, i, x, y): all stride-1 examples; `x` holds rows i..i+window-1 and
    `y` the targets of row i+window."""
    lanes = position_lanes(df, spec, long_rows)
    examples = _example_rows(lanes, spec, window, F.lit(0), block)
    return examples.select(*spec.keys, F.col("pos").alias("i"), "x", "y")


def split_windows(
    df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, block: int = BLOCK_EXAMPLES, on_error: str = "raise"
) -> DataFrame:
    """(keys, i, split, batch, slot, x, y): the examples of the split plan."""
    lanes = position_lanes(df, spec, cfg.long_rows).map(lambda rows: with_plan(rows, cfg, on_error))
    examples = _example_rows(lanes, spec, cfg.window, F.col("lost"), block)
    place = example_columns(F.col("pos"), cfg)
    return examples.select(
        *spec.keys, F.col("pos").alias("i"), *[c.alias(name) for name, c in place.items()], "x", "y"
    )


def split_rows(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, on_error: str = "raise") -> DataFrame:
    """(keys, i, split, batch, slot) of every example, without its rows."""
    rows = position_lanes(df, spec, cfg.long_rows).map(lambda r: with_plan(r, cfg, on_error)).union()
    place = example_columns(F.col("pos"), cfg)
    return rows.where(F.col("pos") + cfg.window < F.col("n")).select(
        *spec.keys, F.col("pos").alias("i"), *[c.alias(name) for name, c in place.items()]
    )


def window_cells(examples: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Long form (keys, i, step, variable, value) of the inputs."""
    steps = examples.select(*spec.keys, "i", F.posexplode("x").alias("step", "row"))
    cells = F.explode(
        F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"row.`{v}`").alias("value")) for v in spec.values])
    )
    return steps.select(*spec.keys, "i", "step", cells.alias("cell")).select(
        *spec.keys, "i", "step", "cell.variable", "cell.value"
    )


def label_cells(examples: DataFrame, spec: SeriesSpec, window: int) -> DataFrame:
    """Long form (keys, i, step, target, value) of the labels. A label belongs
    to the last step of its example; the other steps have none."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"y.`{t}`").alias("value")) for t in spec.targets])
    )
    return examples.select(*spec.keys, "i", F.lit(window - 1).alias("step"), cells.alias("cell")).select(
        *spec.keys, "i", "step", "cell.target", "cell.value"
    )
