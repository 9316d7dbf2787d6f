"""Trend and season, taken out before a series is modelled and put back after.

A straight line by least squares and the mean of what is left at each phase of a
period, fitted on the rows that training uses. Both follow from sums by series and
phase, which Spark forms piece by piece: a long series costs no more than short ones.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.operators.plan import with_plan
from tempolane.operators.position import Lanes, position_lanes

ROW = "row"


class Detrended(NamedTuple):
    """`rows` (keys, row, values) without trend and season, what describes them as a
    series, and `fitted`: (keys, center, slopes, levels, seasons), lists by value."""

    rows: DataFrame
    spec: SeriesSpec
    fitted: DataFrame


def _moments(rows: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, period: int) -> DataFrame:
    """Sums over training rows by series and phase. Rows count from the middle of the
    training part, so that no digits are lost in their squares."""
    length = F.col("n_train") * cfg.batch + cfg.window
    center = F.col("lost") + (length - 1) / F.lit(2.0)
    rows = rows.where(F.col("pos") - F.col("lost") < length).withColumn("_tl_center", center)
    c = F.col("pos") - F.col("_tl_center")
    return rows.groupBy(*spec.keys, (F.col("pos") % period).cast("int").alias("phase")).agg(
        F.first("_tl_center").alias("center"), F.count(F.lit(1)).alias("n"), F.sum(c).alias("sc"), F.sum(c * c).alias("scc"),
        F.array(*[F.sum(v) for v in spec.values]).alias("sy"), F.array(*[F.sum(c * F.col(v)) for v in spec.values]).alias("scy"),
    )


def fit_trend(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, period: int, on_error: str = "raise") -> DataFrame:
    """(keys, center, slopes, levels, seasons): the line of value `v` at row `pos` is
    levels[v] + slopes[v] * (pos - center), and seasons[v][pos % period] comes on top.
    A phase that training has no row of is 0. A period of 1 leaves the line alone."""
    if period < 1:
        raise ValueError(f"period must be at least 1, got {period}")
    lanes = position_lanes(df, spec, cfg.long_rows)
    return _fitted(lanes, spec, cfg, period, on_error)


def _fitted(lanes: Lanes, spec: SeriesSpec, cfg: ForecastConfig, period: int, on_error: str) -> DataFrame:
    sums = lanes.map(lambda rows: _moments(with_plan(rows, cfg, on_error), spec, cfg, period)).union()
    places = range(len(spec.values))
    total = lambda name, v: F.sum(F.get(name, F.lit(v)))
    # At most `period` rows a series.
    whole = sums.groupBy(*spec.keys).agg(
        F.first("center").alias("center"), F.sum("n").alias("n"), F.sum("scc").alias("scc"),
        F.array(*[total("sy", v) for v in places]).alias("sy"), F.array(*[total("scy", v) for v in places]).alias("scy"),
        F.map_from_entries(F.collect_list(F.struct("phase", F.struct("n", "sc", "sy").alias("part")))).alias("parts"),
    )
    whole = whole.where("n > 0")  # without keys, an empty table gives an empty row
    slopes = F.transform("scy", lambda x: F.when(F.col("scc") > 0, x / F.col("scc")).otherwise(0.0))
    whole = whole.withColumns({"slopes": slopes, "levels": F.transform("sy", lambda x: x / F.col("n"))})

    def season(v: int) -> Column:
        left = lambda p: (F.get(p["sy"], F.lit(v)) - F.get("slopes", F.lit(v)) * p["sc"]) / p["n"] - F.get("levels", F.lit(v))
        part = lambda k: F.try_element_at(F.col("parts"), k)
        return F.transform(F.sequence(F.lit(0), F.lit(period - 1)), lambda k: F.coalesce(left(part(k)), F.lit(0.0)))

    seasons = F.array(*[season(v) for v in places]) if period > 1 else F.array(*[F.array(F.lit(0.0)) for _ in places])
    return whole.select(*spec.keys, "center", "slopes", "levels", seasons.alias("seasons"))


def _line(pos: Column, v: int) -> Column:
    at = lambda name: F.get(name, F.lit(v))
    seasons = at("seasons")
    return at("levels") + at("slopes") * (pos - F.col("center")) + F.get(seasons, (pos % F.size(seasons)).cast("int"))


def remove_trend(df: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, period: int, on_error: str = "raise") -> Detrended:
    """Rows of every series that can be modelled, without their trend and season. The
    row number is their order: results on them come with the same `pos`."""
    if period < 1:
        raise ValueError(f"period must be at least 1, got {period}")
    lanes = position_lanes(df, spec, cfg.long_rows)
    fitted = _fitted(lanes, spec, cfg, period, on_error)
    pos = F.col("pos")
    values = [(F.col(v) - _line(pos, at)).alias(v) for at, v in enumerate(spec.values)]

    def without(rows: DataFrame, table: DataFrame) -> DataFrame:
        joined = rows.join(table, list(spec.keys)) if spec.keys else rows.join(F.broadcast(table))  # one row
        return joined.select(*spec.keys, pos.alias(ROW), *values)

    cells = len(spec.values) * (period + 2) + 1
    rows = lanes.map(lambda d: without(d, fitted), lambda d: without(d, lanes.sent(fitted, cells))).union()
    return Detrended(rows, SeriesSpec(order=ROW, values=spec.values, keys=spec.keys, targets=spec.targets), fitted)


def restore_trend(result: DataFrame, found: Detrended) -> DataFrame:
    """Results (keys, pos, targets, …) on `found.rows` with trend and season, also for
    rows after the last one."""
    spec, own = found.spec, ("center", "slopes", "levels", "seasons")
    place = {v: at for at, v in enumerate(spec.values)}
    joined = result.join(found.fitted, list(spec.keys)) if spec.keys else result.join(F.broadcast(found.fitted))
    pos = F.col("pos")
    return joined.withColumns({t: F.col(t) + _line(pos, place[t]) for t in spec.targets}).drop(*own).select(*result.columns)
