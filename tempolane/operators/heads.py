"""Which predictions are reported, and where they belong.

Of every mini-batch only its first example, the head, is reported. A head
predicts at each of its steps; the value of step `s` of example `i` is taken for
row `i + s + 1`. All test heads but the newest fill the check table with steps
0..F. The newest gives step 0 to the check and steps 1..F to the forecast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions.columns import div
from tempolane.operators.plan import with_plan
from tempolane.operators.position import position_lanes


def pick_batch_head(examples: DataFrame) -> DataFrame:
    """Test examples in slot 0, from the output of `split_windows`."""
    return examples.where((F.col("split") == "test") & (F.col("slot") == 0))


def head_cells(rows: DataFrame, cfg: ForecastConfig, last_step: int, first_batch=None) -> DataFrame:
    """Send each row with a plan to the heads that read it: adds `k`, the number
    of the mini-batch, and `step` <= last_step. Heads lie `batch` rows apart, so
    no example has to be built to find them."""
    at = F.col("pos") - F.col("lost")
    low = F.greatest(div(at - last_step + cfg.batch - 1, cfg.batch), F.lit(0).cast("bigint"))
    if first_batch is not None:
        low = F.greatest(low, first_batch)
    high = F.least(div(at, cfg.batch), F.col("n_train") + F.col("n_test") - 1)
    heads = F.when(low <= high, F.sequence(low, high))
    return rows.withColumn("k", F.explode(heads)).withColumn(
        "step", (at - F.col("k") * cfg.batch).cast("int")
    )


def persistence_heads(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, on_error: str = "raise") -> DataFrame:
    """Test heads with the row itself as prediction for the next one: the
    yardstick any model has to beat, in the form of `score_heads`."""
    rows = position_lanes(df, spec, cfg.long_rows).map(lambda r: with_plan(r, cfg, on_error)).union()
    cells = head_cells(rows, cfg, cfg.steps, F.col("n_train"))
    row = F.array(*[F.col(t) for t in spec.targets])
    # Groups of steps + 1 rows.
    return (
        cells.groupBy(*spec.keys, "k", "lost", "n_train", "n_test")
        .agg(F.sort_array(F.collect_list(F.struct("step", row.alias("row")))).alias("cells"))
        .select(
            *spec.keys,
            (F.col("k") - F.col("n_train")).alias("batch"),
            (F.col("lost") + F.col("k") * cfg.batch).alias("i"),
            (F.col("k") == F.col("n_train") + F.col("n_test") - 1).alias("is_last"),
            F.col("cells.row").alias("yhat"),
        )
    )


def slice_steps(heads: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, part: str) -> DataFrame:
    """The check or forecast rows of predicted heads, one column per target."""
    steps = heads.select(*spec.keys, "batch", "i", "is_last", F.posexplode("yhat").alias("step", "row"))
    newest, step = F.col("is_last"), F.col("step")
    if part == "check":
        kept = (~newest & (step <= cfg.steps)) | (newest & (step == 0))
    elif part == "forecast":
        kept = newest & (step >= 1) & (step <= cfg.steps)
    else:
        raise ValueError(f"part must be 'check' or 'forecast', got {part!r}")
    place = ["i", "step"] if part == "forecast" else ["batch", "i", "step"]
    return steps.where(kept).select(
        *spec.keys,
        *place,
        (F.col("i") + step + 1).alias("pos"),
        *[F.get("row", F.lit(at)).alias(t) for at, t in enumerate(spec.targets)],
    )


def to_long(wide: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per target: (…, target, value)."""
    rest = [c for c in wide.columns if c not in spec.targets]
    cells = [F.struct(F.lit(t).alias("target"), F.col(t).alias("value")) for t in spec.targets]
    return wide.select(*rest, F.explode(F.array(*cells)).alias("cell")).select(*rest, "cell.*")
