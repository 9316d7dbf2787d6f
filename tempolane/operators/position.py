"""Row positions, for any mix of short and very long series.

A DataFrame has no order, so every later step works on an explicit `pos`. A
keyed window gives it in one shuffle, but puts a whole series into one task.
Series above a length limit are therefore laid out in ranges of their keys and
all order columns, so that a range ends anywhere in a series. The layout is
written, rows are counted by range and series, and what a series has in earlier
ranges is added to a row's place in its own: exact for orders of any type.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions.columns import plan_error, required
from tempolane.sources.shared import new_path, settled

# Tables with a row for each long series are sent to all tasks up to so many
# bytes, and joined by a shuffle beyond.
SENT_BYTES = 64 << 20
# Where the layout is fixed: most rows a task should get, rows that are worth a
# task of their own, and most tasks of a shuffle.
TASK_ROWS = 500_000
WORTH_ROWS = 50_000
MAX_TASKS = 50_000


@dataclass(frozen=True)
class Lanes:
    """One table, cut by series length. In `short`, a series fits into one task.
    A series in `long` never has to; their keys are in `names`. Each lane may be
    absent."""

    short: DataFrame | None
    long: DataFrame | None
    names: DataFrame | None = None
    most: int = 1  # bound on the number of long series
    key_bytes: int = 0  # of the widest key

    def map(self, short: Callable, long: Callable | None = None) -> Lanes:
        return Lanes(
            None if self.short is None else short(self.short),
            None if self.long is None else (long or short)(self.long),
            self.names, self.most, self.key_bytes,
        )

    def union(self) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, [p for p in (self.short, self.long) if p is not None])

    def sent(self, table: DataFrame, values: int, each: int = 1) -> DataFrame:
        """A table with `each` rows of `values` numbers for a long series, marked
        for broadcast if it is surely small."""
        size = self.most * each * (self.key_bytes + 8 * values + 64)
        return F.broadcast(table) if size <= SENT_BYTES else table


class Sizes(NamedTuple):
    """What is known about all series of a table."""

    top: int  # rows of the longest
    total: int  # rows of all
    error: str | None  # why one cannot be modelled, if asked for
    key_bytes: int  # of the widest key, written as text

    def tasks(self, spark: SparkSession) -> int:
        """Tasks for steps that compute more than they read. Fixed, because
        merging partitions by their small size would leave executors idle, and
        growing with the data."""
        asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return max(
            spark.sparkContext.defaultParallelism,
            min(asked, self.total // WORTH_ROWS),
            min(MAX_TASKS, -(-self.total // TASK_ROWS)),
        )


def _lengths(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))


def measure(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig | None = None) -> Sizes:
    """One job over the key columns. With `cfg`, also looks for a series that
    the split plan does not fit."""
    spec.check(df.schema)
    nameless = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys], F.lit(False))
    error = plan_error(F.col("n"), cfg) if cfg else F.lit(None).cast("string")
    told = F.concat_ws(" ", F.to_json(F.struct(*spec.keys)) if spec.keys else F.lit("series"), error)
    width = F.octet_length(F.to_json(F.struct(*spec.keys))) if spec.keys else F.lit(0)
    top, total, bad, first, widest = (
        _lengths(df, spec)
        .agg(F.max("n"), F.sum("n"), F.max(nameless), F.min(F.when(error.isNotNull(), told)), F.max(width))
        .first()
    )
    if bad:
        raise ValueError(f"null in the key columns {list(spec.keys)}: fill or filter these rows first")
    return Sizes(top or 0, total or 0, first, widest or 0)


def cut_by_length(df: DataFrame, spec: SeriesSpec, long_rows: int, sizes: Sizes) -> tuple[Lanes, int]:
    """The lanes, and the number of rows in the long one."""
    if sizes.top <= long_rows:
        return Lanes(df, None), 0
    if not spec.keys:
        return Lanes(None, df), sizes.total
    on = list(spec.keys)
    # Written, so that each use does not count the series again.
    found = _lengths(df, spec).where(F.col("n") > long_rows).select(*on, "n")
    found = settled(found, new_path(df.sparkSession, "long"))
    lanes = Lanes(None, None, found.select(*on), sizes.total // long_rows, sizes.key_bytes)
    names = lanes.sent(lanes.names, 0)
    short, long = (df.join(names, on, how) for how in ("left_anti", "left_semi"))
    return Lanes(short, long, *list(vars(lanes).values())[2:]), found.agg(F.sum("n")).first()[0]


def _number_short(df: DataFrame, spec: SeriesSpec, partitions: int | None) -> DataFrame:
    if partitions and spec.keys:
        df = df.repartition(partitions, *spec.keys)
    series = Window.partitionBy(*spec.keys)
    return df.withColumn(
        "pos", F.row_number().over(series.orderBy(*spec.order)).cast("bigint") - 1
    ).withColumn("n", F.count(F.lit(1)).over(series))


def _ranged(df: DataFrame, spec: SeriesSpec, ranges: int) -> DataFrame:
    """The rows in ranges of about equal size, sorted, each with its range and its
    place in it. Written: what follows must see the same layout twice."""
    place = [*spec.keys, *spec.order]
    laid = df.repartitionByRange(ranges, *place).sortWithinPartitions(*place)
    laid = laid.withColumns({
        "_tl_range": F.spark_partition_id(),
        # The lower bits of this number count the rows of a partition.
        "_tl_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    return settled(laid, new_path(df.sparkSession, "ranges"))


def _number_long(df: DataFrame, spec: SeriesSpec, ranges: int, lanes: Lanes) -> DataFrame:
    laid = _ranged(df, spec, ranges)
    place = ["_tl_range", *spec.keys]
    # A row for each series in each range: only series that cross a border have several.
    counts = laid.groupBy(*place).agg(F.count(F.lit(1)).alias("_tl_rows"), F.min("_tl_at").alias("_tl_first"))
    series = Window.partitionBy(*spec.keys)
    before = series.orderBy("_tl_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *place,
        (F.coalesce(F.sum("_tl_rows").over(before), F.lit(0)) - F.col("_tl_first")).alias("_tl_shift"),
        F.sum("_tl_rows").over(series).alias("n"),
    )
    # As many rows as long series and ranges together.
    starts = lanes.sent(starts, 3, 1 + -(-ranges // lanes.most))
    return laid.join(starts, place).withColumn("pos", F.col("_tl_at") + F.col("_tl_shift")).drop("_tl_range", "_tl_at", "_tl_shift")


def position_lanes(
    df: DataFrame,
    spec: SeriesSpec,
    long_rows: int,
    sizes: Sizes | None = None,
    partitions: int | None = None,
) -> Lanes:
    """Lanes of (keys, pos, n, values): `pos` counts a series from 0, oldest
    first, and `n` is its length. The order must be unique within a series.

    `partitions` fixes the layout of the short lane."""

    def shape(part: DataFrame) -> DataFrame:
        return part.select(*spec.keys, "pos", "n", *[required(v) for v in spec.values])

    df = df.select(*dict.fromkeys((*spec.keys, *spec.order, *spec.values)))
    sizes = sizes or measure(df, spec)
    lanes, rows = cut_by_length(df, spec, long_rows, sizes)
    # For tasks of a fit size; with fewer rows, for some of each core.
    cores = df.sparkSession.sparkContext.defaultParallelism
    ranges = min(MAX_TASKS, max(2, -(-rows // TASK_ROWS), min(-(-rows // long_rows), 4 * cores)))
    return lanes.map(
        lambda d: shape(_number_short(d, spec, partitions)), lambda d: shape(_number_long(d, spec, ranges, lanes))
    )


def with_position(df: DataFrame, spec: SeriesSpec, long_rows: int = 200_000) -> DataFrame:
    """(keys, pos, n, values) of every series."""
    return position_lanes(df, spec, long_rows).union()


def order_ties(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Order values that occur more than once in a series: they would make
    positions arbitrary. Empty for good input."""
    return (
        df.groupBy(*spec.keys, *spec.order)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
