
from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolane import ForecastConfig, SeriesSpec
from tempolane.functions import cell
from tempolane.operators import heads, overlay, plan, position, scaling, select, trend, windows
from tempolane.plans import score, train
from tempolane.plans.job import forecast_job
from tempolane.sources import series, store
from tempolane.sources.shared import new_path, send_package, settled

# The corpus operators are a part that may be absent, or lack a library here.
try:
    import corpus_pipeline
    from tempolane.llm import queries as corpus

    CORPUS = {**corpus.QUERIES, "pipeline": corpus_pipeline.run}
    CORPUS_SQL = corpus.ORACLES
except ImportError:
    CORPUS, CORPUS_SQL = {}, {}

SMALL = ForecastConfig(window=8, batch=8, test_ratio=0.2, steps=5)
MIXED = ForecastConfig(window=8, batch=8, test_ratio=0.3, steps=5)
USERS = ForecastConfig(window=8, batch=4, test_ratio=0.2, steps=5)
TRAINED = dataclasses.replace(SMALL, epochs=3, learning_rate=0.01)
TRAINED_USERS = dataclasses.replace(USERS, epochs=3, learning_rate=0.01)
# Low limits send the series of the test tables down the path of very long ones.
LONG_ROWS = 200
BLOCK = 256

HOURLY = SeriesSpec(keys="sid", order="hour", values=("total", "cnt"))
DAILY = SeriesSpec(order="day", values=("total", "cnt"))
SHIP = SeriesSpec(keys="sid", order="day", values=("qty", "price", "disc"))
USER = SeriesSpec(keys="sid", order="ts", values="amount")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(name: str) -> F.Column:
    # Exact sums, whatever the order of addition.
    return F.sum(F.col(name).cast("decimal(18,2)")).cast("double")


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type, a row per hour."""
    return (
        _table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("sid"), F.date_trunc("hour", "ts").alias("hour"))
        .agg(_cents("value").alias("total"), F.count(F.lit(1)).cast("double").alias("cnt"))
    )


def events_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series: one per user, a row per event."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("sid"), "ts", F.col("value").alias("amount")
    )


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single series without a key."""
    return (
        _table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").alias("day"))
        .agg(_cents("o_totalprice").alias("total"), F.count(F.lit(1)).cast("double").alias("cnt"))
    )


def ship_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few series of three variables."""
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.concat("l_returnflag", "l_linestatus").alias("sid"), F.col("l_shipdate").alias("day"))
        .agg(
            _cents("l_quantity").alias("qty"),
            _cents("l_extendedprice").alias("price"),
            _cents("l_discount").alias("disc"),
        )
    )


# --- queries -----------------------------------------------------------------


def _series_position(spark, d):
    hourly = position.with_position(events_hourly(spark, d), HOURLY).select("sid", "pos", "total", "cnt")
    daily = position.with_position(orders_daily(spark, d), DAILY).select(
        F.lit("orders").alias("sid"), "pos", "total", "cnt"
    )
    return hourly.unionByName(daily)


def _series_position_long(spark, d):
    return position.with_position(events_user(spark, d), USER, long_rows=60).select("sid", "pos", "n", "amount")


def _order_ties(spark, d):
    # Raw order dates are not unique: the reason why they are summed by day.
    orders = _table(spark, d, "orders").select(F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("total"))
    return position.order_ties(orders, SeriesSpec(order="day", values="total"))


def _select_targets(spark, d):
    return select.select_targets(ship_daily(spark, d), SHIP, "price,weight,qty", ignore_unknown=True)


def _select_features(spark, d):
    return select.select_features(ship_daily(spark, d), SHIP)


def _split_plan(spark, d):
    return plan.split_plan(events_hourly(spark, d), HOURLY, SMALL)


def _validate(spark, d):
    return plan.validate(events_user(spark, d), USER, MIXED)


def _drop_and_split(spark, d):
    return windows.split_rows(events_hourly(spark, d), HOURLY, SMALL)


def _sliding_windows(spark, d):
    return windows.window_cells(windows.sliding_windows(ship_daily(spark, d), SHIP, SMALL.window), SHIP)


def _sliding_windows_halo(spark, d):
    return windows.window_cells(
        windows.sliding_windows(orders_daily(spark, d), DAILY, SMALL.window, LONG_ROWS, BLOCK), DAILY
    )


def _window_labels(spark, d):
    spec = SeriesSpec(keys="sid", order="day", values=SHIP.values, targets=("price", "disc"))
    examples = windows.split_windows(ship_daily(spark, d), spec, SMALL)
    cells = windows.label_cells(examples, spec, SMALL.window)
    return cells.select("sid", "i", "step", "target", "value")


def _minmax(role, spark, d):
    return scaling.fit_minmax(ship_daily(spark, d), SHIP, SMALL, (role,)).drop("role")


def _minmax_long(spark, d):
    cfg = ForecastConfig(window=8, batch=8, steps=5, long_rows=LONG_ROWS)
    return scaling.fit_minmax(orders_daily(spark, d), DAILY, cfg)


def _scale_windows(spark, d):
    cells = scaling.scale_rows(events_hourly(spark, d), HOURLY, SMALL)
    return cells.select("sid", "pos", "role", "variable", F.round("scaled", 6).alias("scaled"))


def _unscale_roundtrip(spark, d):
    cells = scaling.unscale_rows(scaling.scale_rows(events_hourly(spark, d), HOURLY, SMALL))
    return cells.select("sid", "pos", "role", "variable", F.round("restored", 2).alias("restored"))


def _persistence(part, spark, d):
    found = heads.persistence_heads(events_hourly(spark, d), HOURLY, SMALL)
    return heads.to_long(heads.slice_steps(found, HOURLY, SMALL, part), HOURLY)


def _overlay(align, spark, d):
    daily = orders_daily(spark, d)
    found = heads.persistence_heads(daily, DAILY, SMALL)
    check = heads.slice_steps(found, DAILY, SMALL, "check")
    forecast = heads.slice_steps(found, DAILY, SMALL, "forecast")
    return overlay.overlay(daily, check, forecast, DAILY, SMALL, align)


def _mse(spark, d):
    ship = ship_daily(spark, d)
    check = heads.to_long(
        heads.slice_steps(heads.persistence_heads(ship, SHIP, SMALL), SHIP, SMALL, "check"), SHIP
    )
    actual = heads.to_long(position.with_position(ship, SHIP).select("sid", "pos", *SHIP.values), SHIP)
    both = check.withColumnRenamed("value", "yhat").join(actual, ["sid", "pos", "target"])
    found = overlay.mean_squared_error(both, F.col("value"), F.col("yhat"), ["sid", "target"])
    return found.select("sid", "target", F.round("mse", 2).alias("mse"))


def _read_series(spark, d):
    # A sorted table as a folder of CSV parts, and back.
    path = new_path(spark, "csv")
    daily = orders_daily(spark, d).orderBy("day").select("total", "cnt")
    daily.write.option("header", True).csv(path)
    found = series.read_series(spark, path)
    return position.with_position(found, series.series_spec(found)).select("pos", "total", "cnt")


def _write_read(part, spark, d):
    # Through the sinks: written by run, read back.
    found = heads.persistence_heads(events_hourly(spark, d), HOURLY, SMALL)
    rows = heads.slice_steps(found, HOURLY, SMALL, part)
    path = new_path(spark, part)
    write = series.write_check if part == "check" else series.write_forecast
    write(rows, HOURLY, path, "7")
    return spark.read.schema(rows.schema.add("run_id", "string")).parquet(path)


def _models(spark, d):
    """Trained once and written, for the queries that score."""
    models = train.train_per_series(events_hourly(spark, d), HOURLY, TRAINED)
    return settled(models, new_path(spark, "models"))


def _train_per_series(spark, d):
    return train.train_per_series(events_user(spark, d), USER, TRAINED_USERS, on_error="skip").select(
        "sid", "params", "scaler"
    )


def _train_long_series(spark, d):
    cfg = dataclasses.replace(TRAINED, epochs=2, long_rows=LONG_ROWS)
    return train.train_per_series(orders_daily(spark, d), DAILY, cfg).select("params", "scaler")


def _train_pooled(spark, d):
    return train.train_pooled(ship_daily(spark, d), SHIP, TRAINED).models.select("params")


def _training_stats(spark, d):
    models = train.train_per_series(ship_daily(spark, d), SHIP, TRAINED)
    return train.training_stats(models, "1").select("run_id", "sid", "epoch", "round", "n_windows", "loss")


def _warm_state(spark, d):
    return score.score_heads(events_hourly(spark, d), _models(spark, d), HOURLY, TRAINED)


def _warm_state_long(spark, d):
    cfg = dataclasses.replace(TRAINED, long_rows=LONG_ROWS)
    return score.score_heads(events_hourly(spark, d), _models(spark, d), HOURLY, cfg, piece_batches=16)


def _score_windows(spark, d):
    return score.score_windows(events_hourly(spark, d), _models(spark, d), HOURLY, TRAINED)


def _check_fit(spark, d):
    return heads.to_long(score.check_fit(events_hourly(spark, d), _models(spark, d), HOURLY, TRAINED), HOURLY)


def _forecast(spark, d):
    return heads.to_long(score.forecast(events_hourly(spark, d), _models(spark, d), HOURLY, TRAINED), HOURLY)


def _aligned_fit(spark, d):
    return score.aligned_fit(events_hourly(spark, d), _models(spark, d), HOURLY, TRAINED)


def _save_load_model(spark, d):
    path = new_path(spark, "saved")
    store.save_model(train.train_per_series(events_hourly(spark, d), HOURLY, TRAINED), path)
    return store.load_model(spark, path).select("sid", "config", "params", "updater", "scaler")


def _score_saved_model(spark, d):
    path = new_path(spark, "saved")
    store.save_model(train.train_per_series(events_hourly(spark, d), HOURLY, TRAINED), path)
    saved = store.load_model(spark, path)
    return score.forecast(events_hourly(spark, d), saved, HOURLY, TRAINED, refit_scaler=False)


def _forecast_job(spark, d):
    done = forecast_job(events_hourly(spark, d), HOURLY, TRAINED, new_path(spark, "job"), model_name="m", run_id="7")
    return done.forecast


def _check_places(part, spark, d):
    """Where the values of a trained model are put, without the values."""
    rows = _check_fit(spark, d) if part == "check" else _forecast(spark, d)
    return rows.drop("value")


# A network of set weights, small enough to be written out in SQL.
FIXED = dataclasses.replace(SMALL, hidden=2)
FIXED_WEIGHTS = [((37 * k) % 101 - 50) / 100 for k in range(52)]


SOFT = dataclasses.replace(FIXED, activation="SOFTSIGN")


def _fixed_model(spark, cfg: ForecastConfig | None = None):
    model = spark.range(1).select(
        F.lit(FIXED_WEIGHTS).alias("params"),
        F.lit(list(HOURLY.values)).alias("inputs"),
        F.lit(list(HOURLY.targets)).alias("targets"),
    )
    return model if cfg is None else model.withColumns({"config": F.lit(cfg.to_json()), "updater": F.col("params")})


def _rounded(rows, digits=4):
    return heads.to_long(rows, HOURLY).withColumn("value", F.round("value", digits))


def _score_windows_fixed(spark, d):
    scored = score.score_windows(events_hourly(spark, d), _fixed_model(spark), HOURLY, FIXED)
    steps = scored.select("sid", "i", F.posexplode("yhat").alias("step", "row"))
    return _rounded(
        steps.select("sid", "i", "step", *[F.get("row", F.lit(at)).alias(t) for at, t in enumerate(HOURLY.targets)])
    )


def _check_fixed(warm, long_rows, spark, d):
    cfg = dataclasses.replace(FIXED, long_rows=long_rows)
    found = score.score_heads(
        events_hourly(spark, d), _fixed_model(spark), HOURLY, cfg, warm=warm, piece_batches=16
    )
    return _rounded(heads.slice_steps(found, HOURLY, cfg, "check"))


def _forecast_fixed(spark, d):
    return _rounded(score.forecast(events_hourly(spark, d), _fixed_model(spark), HOURLY, FIXED))


def _aligned_fixed(spark, d):
    return _rounded(score.aligned_fit(events_hourly(spark, d), _fixed_model(spark), HOURLY, FIXED))


def _score_saved_fixed(spark, d):
    # Saved, and scored by a job that takes the configuration from the model.
    path = new_path(spark, "saved")
    store.save_model(_fixed_model(spark, SOFT), path)
    done = forecast_job(events_hourly(spark, d), HOURLY, None, new_path(spark, "job"), model_path=path, run_id="7")
    return _rounded(done.check)


# More steps than the window has rows, so that predictions follow from predictions alone.
AHEAD = 11


def _recursive_fixed(spark, d):
    return _rounded(score.recursive_forecast(events_hourly(spark, d), _fixed_model(spark), HOURLY, FIXED, AHEAD), 3)


def _recursive_forecast(spark, d):
    models = _models(spark, d)
    return heads.to_long(score.recursive_forecast(events_hourly(spark, d), models, HOURLY, TRAINED, AHEAD), HOURLY)


def _damaged_csv(spark, d):
    """Daily sums as text, of which some are no numbers."""
    day = F.dayofmonth("day")
    date = F.date_format("day", "yyyy-MM-dd")
    total = F.when(day == 13, F.concat(F.lit("n/a "), date)).otherwise(F.col("total").cast("string"))
    cnt = F.when(day.isin(13, 21), F.concat(date, F.lit("x"))).when(day == 17, "").otherwise(F.col("cnt").cast("string"))
    path = new_path(spark, "csv")
    rows = orders_daily(spark, d).orderBy("day").select(total.alias("total"), cnt.alias("cnt"))
    rows.write.option("header", True).csv(path)
    return series.read_series_leniently(spark, path)


def _lenient_rows(spark, d):
    found = _damaged_csv(spark, d).rows
    return position.with_position(found, series.series_spec(found)).select("pos", "total", "cnt")


def _lenient_rejects(spark, d):
    return _damaged_csv(spark, d).rejects.select("field", "text")


PERIOD = 24  # hours of a day


def _trend_fit(spark, d):
    fitted = trend.fit_trend(events_hourly(spark, d), HOURLY, SMALL, PERIOD)
    values = F.explode(F.array(*[
        F.struct(F.lit(v).alias("variable"), *[F.get(c, F.lit(at)).alias(c) for c in ("slopes", "levels", "seasons")])
        for at, v in enumerate(HOURLY.values)])).alias("x")
    cells = fitted.select("sid", "center", values).select("sid", "center", "x.*")
    cells = cells.select("sid", "variable", "center", "slopes", "levels", F.posexplode("seasons").alias("phase", "season"))
    near = lambda c: (F.round(c, 5) + 0.0)
    return cells.select("sid", "variable", "center", near("slopes").alias("slope"), near("levels").alias("level"), "phase", near("season").alias("season"))


def _trend_roundtrip(spark, d):
    found = trend.remove_trend(events_hourly(spark, d), HOURLY, SMALL, PERIOD)
    back = trend.restore_trend(found.rows.withColumnRenamed("row", "pos"), found)
    return back.select("sid", "pos", F.round("total", 2).alias("total"), F.round("cnt", 2).alias("cnt"))


def _trend_forecast(spark, d):
    """Detrended, trained, forecast after the last row, and put back."""
    found = trend.remove_trend(events_hourly(spark, d), HOURLY, TRAINED, PERIOD)
    models = settled(train.train_per_series(found.rows, found.spec, TRAINED), new_path(spark, "models"))
    ahead = score.recursive_forecast(found.rows, models, found.spec, TRAINED, PERIOD)
    return heads.to_long(trend.restore_trend(ahead, found), HOURLY)


def _validate_steps(spark, d):
    return plan.validate(events_user(spark, d), USER, dataclasses.replace(MIXED, steps=8))


# Training that takes no steps: its log is the loss of the initial weights.
STILL = dataclasses.replace(FIXED, epochs=1, learning_rate=0.0)


def _training_loss(spark, d):
    models = train.train_per_series(events_hourly(spark, d), HOURLY, STILL)
    return train.training_stats(models, "1").select("sid", "epoch", "n_windows", F.round("loss", 6).alias("loss"))


def _saved_cells(spark, d):
    """Everything of saved models, cell by cell."""
    path = new_path(spark, "saved")
    store.save_model(train.train_per_series(events_hourly(spark, d), HOURLY, STILL), path, save_updater=True)
    saved = store.load_model(spark, path)
    lists = {"params": "params", "updater": "updater", "loss": "history.loss", **{c: f"scaler.{c}" for c in ("f_min", "f_max", "l_min", "l_max")}}
    texts = {"config": F.col("config"), "inputs": F.array_join("inputs", ","), "targets": F.array_join("targets", ",")}
    found = [
        saved.select("sid", F.lit(n).alias("part"), F.posexplode(c).alias("at", "value"))
        .select("sid", "part", F.col("at").cast("bigint").alias("at"), (F.round("value", 6) + 0.0).alias("value"), F.lit(None).cast("string").alias("text"))
        for n, c in lists.items()
    ]
    found += [
        saved.select("sid", F.lit(n).alias("part"), F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("double").alias("value"), c.alias("text"))
        for n, c in texts.items()
    ]
    return functools.reduce(DataFrame.unionByName, found)


# One mini-batch of training, so that an epoch is a step, and the rest for testing.
STEPPED = dataclasses.replace(FIXED, test_ratio=0.995, learning_rate=0.05)


def _fitted(updater, spark, d):
    """Weights and the updater's state after one step and after two."""
    hourly, found = events_hourly(spark, d), []
    for epochs in (1, 2):
        models = train.train_per_series(hourly, HOURLY, dataclasses.replace(STEPPED, updater=updater, epochs=epochs))
        cells = models.select("sid", "updater", F.posexplode("params").alias("at", "w"))
        memory = F.get("updater", F.col("at"))
        found.append(cells.select(
            "sid", F.lit(epochs).alias("epochs"), F.col("at").cast("bigint").alias("at"),
            (F.round("w", 5) + 0.0).alias("weight"), (F.round(memory, 5) + 0.0).alias("memory")))
    return found[0].unionByName(found[1])


def _training_loss_pooled(spark, d):
    stats = train.train_pooled(events_hourly(spark, d), HOURLY, STILL, rounds_per_epoch=2).stats
    n = F.sum("n_windows")
    return stats.groupBy("epoch").agg(
        n.alias("n_windows"), F.round(F.sum(F.col("loss") * F.col("n_windows")) / n, 6).alias("loss")
    )


def entry(spark: SparkSession) -> DataFrame:
    return _forecast(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    return {
        "series_position": _series_position,
        "series_position_long": _series_position_long,
        "order_ties": _order_ties,
        "select_targets": _select_targets,
        "select_features": _select_features,
        "split_plan": _split_plan,
        "validate": _validate,
        "drop_and_split": _drop_and_split,
        "sliding_windows": _sliding_windows,
        "sliding_windows_halo": _sliding_windows_halo,
        "window_labels": _window_labels,
        "minmax_features": partial(_minmax, "feature"),
        "minmax_labels": partial(_minmax, "label"),
        "minmax_long": _minmax_long,
        "scale_windows": _scale_windows,
        "unscale_roundtrip": _unscale_roundtrip,
        "check_positions": partial(_persistence, "check"),
        "forecast_positions": partial(_persistence, "forecast"),
        "overlay": partial(_overlay, "true"),
        "overlay_tail": partial(_overlay, "tail"),
        "mse": _mse,
        "read_series": _read_series,
        "write_check": partial(_write_read, "check"),
        "write_forecast": partial(_write_read, "forecast"),
        "train_per_series": _train_per_series,
        "train_long_series": _train_long_series,
        "train_pooled": _train_pooled,
        "training_stats": _training_stats,
        "warm_state": _warm_state,
        "warm_state_long": _warm_state_long,
        "score_windows": _score_windows,
        "check_fit": _check_fit,
        "check_fit_places": partial(_check_places, "check"),
        "forecast": _forecast,
        "forecast_places": partial(_check_places, "forecast"),
        "aligned_fit": _aligned_fit,
        "save_load_model": _save_load_model,
        "score_saved_model": _score_saved_model,
        "forecast_job": _forecast_job,
        "fit_nesterovs": partial(_fitted, "NESTEROVS"),
        "fit_rmsprop": partial(_fitted, "RMSPROP"),
        "fit_adagrad": partial(_fitted, "ADAGRAD"),
        "recursive_forecast": _recursive_forecast,
        "recursive_forecast_fixed": _recursive_fixed,
        "score_saved_fixed": _score_saved_fixed,
        "saved_model_cells": _saved_cells,
        "read_lenient_rows": _lenient_rows,
        "read_lenient_rejects": _lenient_rejects,
        "validate_steps": _validate_steps,
        "trend_fit": _trend_fit,
        "trend_roundtrip": _trend_roundtrip,
        "trend_forecast": _trend_forecast,
        "training_loss": _training_loss,
        "training_loss_pooled": _training_loss_pooled,
        "score_windows_fixed": _score_windows_fixed,
        "check_fit_fixed": partial(_check_fixed, True, FIXED.long_rows),
        "check_fit_fixed_long": partial(_check_fixed, True, LONG_ROWS),
        "check_fit_fixed_cold": partial(_check_fixed, False, FIXED.long_rows),
        "forecast_fixed": _forecast_fixed,
        "aligned_fit_fixed": _aligned_fixed,
        **CORPUS,
    }


# --- oracles -----------------------------------------------------------------

_HOURLY_SQL = """
hourly AS (
  SELECT event_type AS sid, date_trunc('hour', ts) AS ord,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS cnt
  FROM events GROUP BY 1, 2),
hourly_pos AS (
  SELECT sid, total, cnt, row_number() OVER (PARTITION BY sid ORDER BY ord) - 1 AS pos,
         count(*) OVER (PARTITION BY sid) AS n FROM hourly)"""

_DAILY_SQL = """
daily AS (
  SELECT o_orderdate AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         CAST(count(*) AS DOUBLE) AS cnt FROM orders GROUP BY 1),
daily_pos AS (
  SELECT total, cnt, row_number() OVER (ORDER BY day) - 1 AS pos, count(*) OVER () AS n FROM daily)"""

_SHIP_SQL = """
ship AS (
  SELECT l_returnflag || l_linestatus AS sid, l_shipdate AS day,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS disc
  FROM lineitem GROUP BY 1, 2),
ship_pos AS (
  SELECT sid, qty, price, disc, row_number() OVER (PARTITION BY sid ORDER BY day) - 1 AS pos,
         count(*) OVER (PARTITION BY sid) AS n FROM ship)"""


def _plan_sql(rows: str, cfg: ForecastConfig, key: str = "sid") -> str:
    """CTE `plan` with the split sizes of each series in `rows`."""
    group = f"GROUP BY {key}" if key else ""
    lead = f"{key}, " if key else ""
    return f"""
sizes AS (SELECT {lead}count(*) AS n, greatest(count(*) - {cfg.window}, 0) AS total_size FROM {rows} {group}),
batches AS (SELECT *, total_size // {cfg.batch} AS n_batches,
  CAST(trunc((total_size // {cfg.batch}) * CAST({cfg.test_ratio} AS DOUBLE)) AS BIGINT) AS n_test FROM sizes),
plan AS (SELECT *, n_batches - n_test AS n_train, (n_batches - n_test) * {cfg.batch} AS train_size,
  n_test * {cfg.batch} AS test_size, total_size - n_batches * {cfg.batch} AS lost FROM batches)"""


def _cells_sql(rows: str, names, key: str = "sid") -> str:
    """CTE `cells`: (sid, pos, variable, value)."""
    lead = f"{key}, " if key else ""
    parts = [f"SELECT {lead}pos, '{v}' AS variable, {v} AS value FROM {rows}" for v in names]
    return "cells AS (" + " UNION ALL ".join(parts) + ")"


def _minmax_sql(role: str) -> str:
    # The slow way, over all training examples.
    shift = "BETWEEN e.i AND e.i + 7" if role == "feature" else "= e.i + 8"
    return f"""WITH {_SHIP_SQL}, {_plan_sql('ship_pos', SMALL)}, {_cells_sql('ship_pos', SHIP.values)},
examples AS (SELECT s.sid, s.pos AS i FROM ship_pos s JOIN plan p ON s.sid = p.sid
  WHERE s.pos >= p.lost AND s.pos < p.lost + p.train_size AND p.n_test > 1)
SELECT e.sid, c.variable, min(c.value) AS min, max(c.value) AS max
FROM examples e JOIN cells c ON c.sid = e.sid AND c.pos {shift} GROUP BY 1, 2"""


def _scaled_sql(cfg: ForecastConfig = SMALL) -> str:
    return f"""WITH {_HOURLY_SQL}, {_plan_sql('hourly_pos', cfg)}, {_cells_sql('hourly_pos', HOURLY.values)},
placed AS (SELECT c.*, c.pos - p.lost AS rel, p.train_size FROM cells c JOIN plan p ON c.sid = p.sid
  WHERE c.pos >= p.lost AND p.n_test > 1),
bounds AS (
  SELECT sid, variable, 'feature' AS role, min(value) AS lo, max(value) AS hi FROM placed
  WHERE rel <= train_size + 6 GROUP BY 1, 2
  UNION ALL
  SELECT sid, variable, 'label', min(value), max(value) FROM placed
  WHERE rel BETWEEN 8 AND train_size + 7 GROUP BY 1, 2)"""


def _heads_sql(rows: str, spec: SeriesSpec, cfg: ForecastConfig) -> str:
    key = spec.keys[0] if spec.keys else ""
    lead = "c.sid, " if key else ""
    on = "c.sid = p.sid" if key else "true"
    return f"""{_plan_sql(rows, cfg, key)}, {_cells_sql(rows, spec.values, key)},
cut AS (
  SELECT {lead}b.batch, p.lost + p.train_size + b.batch * {cfg.batch} AS i, b.batch = p.n_test - 1 AS newest,
         CAST(c.pos - (p.lost + p.train_size + b.batch * {cfg.batch}) AS INTEGER) AS step,
         c.pos + 1 AS pos, c.variable AS target, c.value, p.n, p.n_test
  FROM cells c JOIN plan p ON {on} JOIN (SELECT unnest(range(1000000)) AS batch) b ON b.batch < p.n_test
  WHERE p.n_test > 1
    AND c.pos BETWEEN p.lost + p.train_size + b.batch * {cfg.batch}
                  AND p.lost + p.train_size + b.batch * {cfg.batch} + {cfg.steps}),
check_rows AS (SELECT * FROM cut WHERE NOT newest OR step = 0),
forecast_rows AS (SELECT * FROM cut WHERE newest AND step >= 1)"""


def _overlay_sql(check_pos: str, forecast_pos: str) -> str:
    return f"""WITH {_DAILY_SQL}, {_heads_sql('daily_pos', DAILY, SMALL)},
c AS (SELECT {check_pos} AS pos, target, value AS "check" FROM check_rows),
f AS (SELECT {forecast_pos} AS pos, target, value AS forecast FROM forecast_rows)
SELECT pos, target, a.value AS actual, "check", forecast
FROM (SELECT pos, variable AS target, value FROM cells) a
FULL JOIN (SELECT pos, target, "check", forecast FROM c FULL JOIN f USING (pos, target)) p USING (pos, target)"""


def _cell_sql(source: str, w: list[float], soft: bool = False) -> str:
    """One step of the network with weights `w`: from `source` with the inputs
    x0, x1 and the state h0, h1, c0, c1 to the next state."""
    act = (lambda x: f"({x}) / (1 + abs({x}))") if soft else (lambda x: f"tanh({x})")
    w_in, w_state, peep, bias = w[0:16], w[16:32], w[32:38], w[38:46]

    def z(gate: int, j: int) -> str:
        q = 2 * gate + j
        terms = [f"{w_in[8 * v + q]} * x{v}" for v in range(2)] + [f"{w_state[8 * k + q]} * h{k}" for k in range(2)]
        return f"({bias[q]} + {' + '.join(terms)})"

    gates = ", ".join(
        f"1 / (1 + exp(-({z(0, j)} + {peep[j]} * c{j}))) AS i{j}, "
        f"1 / (1 + exp(-({z(1, j)} + {peep[2 + j]} * c{j}))) AS f{j}, {act(z(2, j))} AS g{j}, {z(3, j)} AS zo{j}"
        for j in range(2)
    )
    cells = ", ".join(f"f{j} * c{j} + i{j} * g{j} AS n{j}" for j in range(2))
    hidden = ", ".join(f"{act(f'n{j}')} / (1 + exp(-(zo{j} + {peep[4 + j]} * n{j}))) AS h{j}" for j in range(2))
    return f"""SELECT * EXCLUDE (h0, h1, c0, c1, n0, n1, i0, i1, f0, f1, g0, g1, zo0, zo1, x0, x1), {hidden}, n0 AS c0, n1 AS c1
  FROM (SELECT *, {cells} FROM (SELECT *, {gates} FROM ({source})))"""


def _network_sql(start: str, pos: str, last: str, w: list[float] = FIXED_WEIGHTS, soft: bool = False) -> str:
    """CTE `outputs` (columns of `start`, t, target, value): the network run over
    the rows at `pos` for t = 0..last - 1."""
    out = w[46:]
    y = [f"{out[4 + k]} + {out[k]} * h0 + {out[2 + k]} * h1" for k in range(2)]
    step = _cell_sql(
        f"SELECT r.* REPLACE (r.t + 1 AS t), u.x0, u.x1 FROM run r JOIN unit u ON u.sid = r.sid AND u.pos = {pos} WHERE r.t < {last}",
        w, soft,
    )
    return f"""{_scaled_sql().replace('WITH', 'WITH RECURSIVE', 1)},
unit AS (
  SELECT p.sid, p.pos, max((p.value - b.lo) / (b.hi - b.lo)) FILTER (p.variable = 'total') AS x0,
         max((p.value - b.lo) / (b.hi - b.lo)) FILTER (p.variable = 'cnt') AS x1
  FROM placed p JOIN bounds b ON p.sid = b.sid AND p.variable = b.variable WHERE b.role = 'feature' GROUP BY 1, 2),
run AS (
  SELECT *, CAST(0 AS DOUBLE) AS h0, CAST(0 AS DOUBLE) AS h1, CAST(0 AS DOUBLE) AS c0, CAST(0 AS DOUBLE) AS c1 FROM ({start})
  UNION ALL
  {step}),
outputs AS (
  SELECT r.* EXCLUDE (t, h0, h1, c0, c1), t - 1 AS t, 'total' AS target, ({y[0]}) * (b.hi - b.lo) + b.lo AS value
  FROM run r JOIN bounds b ON b.sid = r.sid AND b.role = 'label' AND b.variable = 'total' WHERE t > 0
  UNION ALL
  SELECT r.* EXCLUDE (t, h0, h1, c0, c1), t - 1, 'cnt', ({y[1]}) * (b.hi - b.lo) + b.lo
  FROM run r JOIN bounds b ON b.sid = r.sid AND b.role = 'label' AND b.variable = 'cnt' WHERE t > 0)"""


def _windows_fixed_sql() -> str:
    start = """SELECT h.sid, h.pos AS i, 0 AS t FROM hourly_pos h JOIN plan p ON h.sid = p.sid
      WHERE h.pos >= p.lost + p.train_size AND h.pos + 8 < p.n AND p.n_test > 1"""
    return _network_sql(start, "r.i + r.t", "8")


def _loss_sql() -> str:
    """CTE `errors`: the squared error of each training example and target."""
    start = """SELECT h.sid, h.pos AS i, 0 AS t FROM hourly_pos h JOIN plan p ON h.sid = p.sid
      WHERE h.pos >= p.lost AND h.pos < p.lost + p.train_size AND p.n_test > 1"""
    weights = [float(v) for v in cell.net_for(STILL, 2, 2).initial(STILL.seed)]
    return f"""{_network_sql(start, "r.i + r.t", "8", weights)},
errors AS (SELECT o.sid, o.i, power((o.value - p.value) / (b.hi - b.lo), 2) AS error
  FROM outputs o JOIN placed p ON p.sid = o.sid AND p.pos = o.i + 8 AND p.variable = o.target
  JOIN bounds b ON b.sid = o.sid AND b.variable = o.target AND b.role = 'label' WHERE o.t = 7)"""


def _recursive_sql(steps: int, w: list[float] = FIXED_WEIGHTS) -> str:
    """CTE `ahead`: each step runs a window of 8 rows, of which those after the last
    one are predictions that the state of the query carries along."""
    out = w[46:]
    y = [f"({out[4 + k]} + {out[k]} * h0 + {out[2 + k]} * h1)" for k in range(2)]
    row = "r.n - 8 + r.t // 8 + r.t % 8"
    ring = lambda k: f"CASE WHEN {row} < r.n THEN u.x{k} ELSE r.m{k}[{row} - r.n + 1] END AS x{k}"
    zero = ", ".join(f"CASE WHEN r.t % 8 = 0 THEN 0 ELSE r.{c} END AS {c}" for c in ("h0", "h1", "c0", "c1"))
    source = f"""SELECT r.sid, r.n, r.t + 1 AS t, r.m0, r.m1, r.v0, r.v1, r.l0, r.u0, r.l1, r.u1, r.a0, r.b0, r.a1, r.b1, {zero}, {ring(0)}, {ring(1)}
  FROM run r LEFT JOIN unit u ON u.sid = r.sid AND u.pos = {row} WHERE r.t < {8 * steps}"""
    value = [f"({y[k]} * (u{k} - l{k}) + l{k})" for k in range(2)]
    kept = ", ".join(
        f"CASE WHEN t % 8 = 0 THEN list_append(m{k}, ({value[k]} - a{k}) / (b{k} - a{k})) ELSE m{k} END AS m{k}, "
        f"CASE WHEN t % 8 = 0 THEN {value[k]} ELSE v{k} END AS v{k}" for k in range(2))
    bound = lambda role, v, side: f"max({side}) FILTER (role = '{role}' AND variable = '{v}')"
    bounds = ", ".join(
        f"{bound('label', v, 'lo')} AS l{k}, {bound('label', v, 'hi')} AS u{k}, {bound('feature', v, 'lo')} AS a{k}, {bound('feature', v, 'hi')} AS b{k}"
        for k, v in enumerate(HOURLY.values))
    return f"""{_scaled_sql().replace('WITH', 'WITH RECURSIVE', 1)},
unit AS (
  SELECT p.sid, p.pos, max((p.value - b.lo) / (b.hi - b.lo)) FILTER (p.variable = 'total') AS x0,
         max((p.value - b.lo) / (b.hi - b.lo)) FILTER (p.variable = 'cnt') AS x1
  FROM placed p JOIN bounds b ON p.sid = b.sid AND p.variable = b.variable WHERE b.role = 'feature' GROUP BY 1, 2),
wide AS (SELECT sid, {bounds} FROM bounds GROUP BY sid),
run AS (
  SELECT w.sid, p.n, CAST(0 AS BIGINT) AS t, CAST([] AS DOUBLE[]) AS m0, CAST([] AS DOUBLE[]) AS m1, CAST(0 AS DOUBLE) AS v0, CAST(0 AS DOUBLE) AS v1,
    l0, u0, l1, u1, a0, b0, a1, b1, CAST(0 AS DOUBLE) AS h0, CAST(0 AS DOUBLE) AS h1, CAST(0 AS DOUBLE) AS c0, CAST(0 AS DOUBLE) AS c1
  FROM wide w JOIN plan p ON p.sid = w.sid
  UNION ALL
  SELECT sid, n, t, m0, m1, v0, v1, l0, u0, l1, u1, a0, b0, a1, b1, h0, h1, c0, c1
  FROM (SELECT * REPLACE ({kept}) FROM ({_cell_sql(source, w)}))),
ahead AS (SELECT sid, CAST(t // 8 AS INTEGER) AS step, n + t // 8 - 1 AS pos, v0, v1 FROM run WHERE t > 0 AND t % 8 = 0)
SELECT sid, step, pos, 'total' AS target, round(v0, 3) AS value FROM ahead
UNION ALL SELECT sid, step, pos, 'cnt', round(v1, 3) FROM ahead"""


def _gradient_sql(epoch: int) -> str:
    """CTE `grad`: derivatives of the loss by each weight of `theta`, by central
    differences: the network runs with each weight a little up and a little down."""
    step = _cell_sql(
        f"SELECT r.* REPLACE (r.t + 1 AS t), u.x0, u.x1 FROM run{epoch} r JOIN unit u ON u.sid = r.sid AND u.pos = r.i + r.t WHERE r.t < 8",
        [f"w[{k + 1}]" for k in range(52)],
    )
    y = [f"(w[{51 + k}] + w[{47 + k}] * h0 + w[{49 + k}] * h1)" for k in range(2)]
    return f"""
run{epoch} AS (
  SELECT t.sid, h.pos AS i, j, s, list_transform(t.w, lambda v, k: v + CASE WHEN k = j THEN s * 1e-5 ELSE 0 END) AS w, 0 AS t,
    CAST(0 AS DOUBLE) AS h0, CAST(0 AS DOUBLE) AS h1, CAST(0 AS DOUBLE) AS c0, CAST(0 AS DOUBLE) AS c1
  FROM theta{epoch} t JOIN plan p ON p.sid = t.sid JOIN hourly_pos h ON h.sid = t.sid AND h.pos >= p.lost AND h.pos < p.lost + p.train_size
  CROSS JOIN (SELECT unnest(range(1, 53)) AS j) CROSS JOIN (SELECT unnest([1, -1]) AS s)
  UNION ALL
  {step}),
grad{epoch} AS (
  SELECT sid, j, (max(loss) FILTER (s = 1) - max(loss) FILTER (s = -1)) / 2e-5 AS g
  FROM (SELECT r.sid, r.j, r.s, avg((power({y[0]} - l.y0, 2) + power({y[1]} - l.y1, 2)) / 2) AS loss
        FROM run{epoch} r JOIN goal l ON l.sid = r.sid AND l.pos = r.i + 8 WHERE r.t = 8 GROUP BY 1, 2, 3)
  GROUP BY sid, j)"""


def _fitted_sql(updater: str) -> str:
    cfg = dataclasses.replace(STEPPED, updater=updater)
    weights = [float(v) for v in cell.net_for(cfg, 2, 2).initial(cfg.seed)]
    listed = lambda values: "[" + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in values) + "]"
    rate = cfg.learning_rate
    memory = {
        "NESTEROVS": f"{cfg.momentum} * m - {rate} * g",
        "RMSPROP": f"{cfg.rms_decay} * m + (1 - {cfg.rms_decay}) * g * g",
        "ADAGRAD": "m + g * g",
    }[updater]
    weight = {
        "NESTEROVS": f"w + (1 + {cfg.momentum}) * n - {cfg.momentum} * m",
        "RMSPROP": f"w - {rate} * g / (sqrt(n) + {cfg.rms_epsilon})",
        "ADAGRAD": f"w - {rate} * g / (sqrt(n) + {cfg.adagrad_epsilon})",
    }[updater]
    parts = []
    for epoch in (0, 1):
        parts.append(_gradient_sql(epoch))
        parts.append(f"""
theta{epoch + 1} AS (SELECT sid, list({weight} ORDER BY j) AS w, list(n ORDER BY j) AS m
  FROM (SELECT *, {memory} AS n FROM (SELECT g.sid, g.j, g.g, t.w[g.j] AS w, t.m[g.j] AS m FROM grad{epoch} g JOIN theta{epoch} t ON t.sid = g.sid))
  GROUP BY sid)""")
    rows = " UNION ALL ".join(
        f"SELECT sid, {e} AS epochs, CAST(j - 1 AS BIGINT) AS at, round(w[j], 5) + 0.0 AS weight, round(m[j], 5) + 0.0 AS memory "
        f"FROM theta{e}, (SELECT unnest(range(1, 53)) AS j)" for e in (1, 2))
    scaled = lambda role, k: f"""max((p.value - b.lo) / (b.hi - b.lo)) FILTER (b.role = '{role}' AND p.variable = '{HOURLY.values[k]}')"""
    return f"""{_scaled_sql(cfg).replace('WITH', 'WITH RECURSIVE', 1)},
unit AS (SELECT p.sid, p.pos, {scaled('feature', 0)} AS x0, {scaled('feature', 1)} AS x1
  FROM placed p JOIN bounds b ON p.sid = b.sid AND p.variable = b.variable GROUP BY 1, 2),
goal AS (SELECT p.sid, p.pos, {scaled('label', 0)} AS y0, {scaled('label', 1)} AS y1
  FROM placed p JOIN bounds b ON p.sid = b.sid AND p.variable = b.variable GROUP BY 1, 2),
theta0 AS (SELECT sid, {listed(weights)} AS w, {listed([0.0] * len(weights))} AS m FROM plan),
{", ".join(parts)}
{rows}"""


def _cells_of_models_sql() -> str:
    weights = [float(v) for v in cell.net_for(STILL, 2, 2).initial(STILL.seed)]
    listed = lambda values: "[" + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in values) + "]"
    numbers = lambda part, values: f"""SELECT sid, '{part}' AS part, CAST(i - 1 AS BIGINT) AS at, round({listed(values)}[i], 6) + 0.0 AS value, CAST(NULL AS VARCHAR) AS text
FROM series, (SELECT unnest(range(1, {len(values) + 1})) AS i)"""  # noqa: E731
    texts = {"config": STILL.to_json(), "inputs": "total,cnt", "targets": "total,cnt"}
    said = " UNION ALL ".join(f"SELECT sid, '{n}', 0, NULL, '{t}' FROM series" for n, t in texts.items())
    sides = " UNION ALL ".join(
        f"SELECT sid, '{role[0]}_{name}', CASE WHEN variable = 'total' THEN 0 ELSE 1 END, round({side}, 6), NULL FROM bounds WHERE role = '{role}'"
        for role in ("feature", "label") for name, side in (("min", "lo"), ("max", "hi")))
    return f"""{_loss_sql()}, series AS (SELECT DISTINCT sid FROM errors)
{numbers('params', weights)} UNION ALL {numbers('updater', [0.0] * len(weights))}
UNION ALL SELECT sid, 'loss', 0, round(avg(error), 6), NULL FROM errors GROUP BY sid
UNION ALL {sides} UNION ALL {said}"""


def _heads_fixed_sql(warm: bool, soft: bool = False) -> str:
    """CTE `steps` with batch, i, step of each test head. Window and mini-batch
    are equally long here, so that heads follow each other without a gap."""
    first = "lost" if warm else "lost + train_size"
    start = f"SELECT sid, {first} AS first, lost + train_size AS test, n_test, n_batches, 0 AS t FROM plan WHERE n_test > 1"
    return f"""{_network_sql(start, "r.first + r.t", "r.n_batches * 8 - (r.first - (r.test - (r.n_batches - r.n_test) * 8))", soft=soft)},
steps AS (SELECT sid, (first + t - test) // 8 AS batch, test + (first + t - test) // 8 * 8 AS i,
  CAST((first + t - test) % 8 AS INTEGER) AS step, first + t + 1 AS pos, target, round(value, 4) AS value,
  (first + t - test) // 8 = n_test - 1 AS newest FROM outputs WHERE first + t >= test)"""


def oracle_sql() -> dict[str, str]:
    """The same results from DuckDB. Trained values have no SQL counterpart."""
    fixed_check = """SELECT sid, batch, i, step, pos, target, value FROM steps
WHERE (NOT newest AND step <= 5) OR (newest AND step = 0)"""
    check_sql = f"WITH {_HOURLY_SQL}, {_heads_sql('hourly_pos', HOURLY, SMALL)}"
    place = """CASE WHEN pos - lost < train_size THEN 'train' ELSE 'test' END AS split,
  (pos - lost) // 8 AS batch, CAST((pos - lost) % 8 AS INTEGER) AS slot"""
    return {
        "series_position": f"""WITH {_HOURLY_SQL}, {_DAILY_SQL}
SELECT sid, pos, total, cnt FROM hourly_pos UNION ALL SELECT 'orders', pos, total, cnt FROM daily_pos""",
        "series_position_long": """SELECT user_id AS sid, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS pos,
  count(*) OVER (PARTITION BY user_id) AS n, value AS amount FROM events""",
        "order_ties": "SELECT o_orderdate AS day, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1",
        "select_targets": f"WITH {_SHIP_SQL} SELECT sid, day, price, qty FROM ship",
        "select_features": f"WITH {_SHIP_SQL} SELECT sid, day, qty, price, disc FROM ship",
        "split_plan": f"""WITH {_HOURLY_SQL}, {_plan_sql('hourly_pos', SMALL)}
SELECT sid, n, total_size, n_batches, n_test, n_train, train_size, test_size, lost FROM plan""",
        "validate": f"""WITH {_plan_sql('(SELECT user_id AS sid FROM events)', MIXED)},
checked AS (SELECT sid, CASE
  WHEN n_test <= 1 THEN 'too few test batches: raise test_ratio or lower batch'
  WHEN 5 >= 8 THEN 'steps must be smaller than window'
  WHEN 8 > total_size // 2 THEN 'batch is too big for this series' END AS error FROM plan)
SELECT sid, error FROM checked WHERE error IS NOT NULL""",
        "drop_and_split": f"""WITH {_HOURLY_SQL}, {_plan_sql('hourly_pos', SMALL)}
SELECT h.sid, pos AS i, {place} FROM hourly_pos h JOIN plan p ON h.sid = p.sid
WHERE n_test > 1 AND pos >= lost AND pos + 8 < p.n""",
        "sliding_windows": f"""WITH {_SHIP_SQL}, {_cells_sql('ship_pos', SHIP.values)}
SELECT a.sid, a.pos AS i, CAST(c.pos - a.pos AS INTEGER) AS step, c.variable, c.value
FROM ship_pos a JOIN cells c ON c.sid = a.sid AND c.pos BETWEEN a.pos AND a.pos + 7
WHERE a.pos + 8 < a.n""",
        "sliding_windows_halo": f"""WITH {_DAILY_SQL}, {_cells_sql('daily_pos', DAILY.values, '')}
SELECT a.pos AS i, CAST(c.pos - a.pos AS INTEGER) AS step, c.variable, c.value
FROM daily_pos a JOIN cells c ON c.pos BETWEEN a.pos AND a.pos + 7
WHERE a.pos + 8 < a.n""",
        "window_labels": f"""WITH {_SHIP_SQL}, {_plan_sql('ship_pos', SMALL)}, {_cells_sql('ship_pos', ('price', 'disc'))}
SELECT c.sid, c.pos - 8 AS i, 7 AS step, c.variable AS target, c.value FROM cells c JOIN plan p ON c.sid = p.sid
WHERE c.pos - 8 >= p.lost AND p.n_test > 1""",
        "minmax_features": _minmax_sql("feature"),
        "minmax_labels": _minmax_sql("label"),
        "minmax_long": f"""WITH {_DAILY_SQL}, {_plan_sql('daily_pos', SMALL, '')}, {_cells_sql('daily_pos', DAILY.values, '')},
examples AS (SELECT pos AS i FROM daily_pos, plan WHERE pos >= lost AND pos < lost + train_size)
SELECT 'feature' AS role, variable, min(value) AS min, max(value) AS max
FROM examples JOIN cells ON pos BETWEEN i AND i + 7 GROUP BY 2
UNION ALL
SELECT 'label', variable, min(value), max(value) FROM examples JOIN cells ON pos = i + 8 GROUP BY 2""",
        "scale_windows": f"""{_scaled_sql()}
SELECT p.sid, p.pos, b.role, p.variable, round((p.value - b.lo) / (b.hi - b.lo), 6) AS scaled
FROM placed p JOIN bounds b ON p.sid = b.sid AND p.variable = b.variable""",
        "unscale_roundtrip": f"""{_scaled_sql()}
SELECT p.sid, p.pos, b.role, p.variable, p.value AS restored
FROM placed p JOIN bounds b ON p.sid = b.sid AND p.variable = b.variable""",
        "check_positions": f"{check_sql} SELECT sid, batch, i, step, pos, target, value FROM check_rows",
        "forecast_positions": f"{check_sql} SELECT sid, i, step, pos, target, value FROM forecast_rows",
        "check_fit_places": f"{check_sql} SELECT sid, batch, i, step, pos, target FROM check_rows",
        "forecast_places": f"{check_sql} SELECT sid, i, step, pos, target FROM forecast_rows",
        "read_series": f"WITH {_DAILY_SQL} SELECT pos, total, cnt FROM daily_pos",
        "training_loss": f"""{_loss_sql()}
SELECT sid, 0 AS epoch, count(DISTINCT i) AS n_windows, round(avg(error), 6) AS loss FROM errors GROUP BY sid""",
        "training_loss_pooled": f"""{_loss_sql()}
SELECT 0 AS epoch, count(DISTINCT (sid, i)) AS n_windows, round(avg(error), 6) AS loss FROM errors""",
        "score_windows_fixed": f"""{_windows_fixed_sql()}
SELECT sid, i, t AS step, target, round(value, 4) AS value FROM outputs""",
        "aligned_fit_fixed": f"""{_windows_fixed_sql()}
SELECT sid, i, i + 8 AS pos, target, round(value, 4) AS value FROM outputs WHERE t = 7""",
        "check_fit_fixed": f"{_heads_fixed_sql(True)} {fixed_check}",
        "check_fit_fixed_long": f"{_heads_fixed_sql(True)} {fixed_check}",
        "check_fit_fixed_cold": f"{_heads_fixed_sql(False)} {fixed_check}",
        "score_saved_fixed": f"{_heads_fixed_sql(True, soft=True)} {fixed_check}",
        **{f"fit_{u.lower()}": _fitted_sql(u) for u in ("NESTEROVS", "RMSPROP", "ADAGRAD")},
        "recursive_forecast_fixed": _recursive_sql(AHEAD),
        "saved_model_cells": _cells_of_models_sql(),
        "read_lenient_rows": f"""WITH {_DAILY_SQL} SELECT row_number() OVER (ORDER BY day) - 1 AS pos, total, cnt
FROM daily WHERE day(day) NOT IN (13, 17, 21)""",
        "read_lenient_rejects": f"""WITH {_DAILY_SQL} SELECT 'total' AS field, 'n/a ' || strftime(day, '%Y-%m-%d') AS text FROM daily WHERE day(day) = 13
UNION ALL SELECT 'cnt', strftime(day, '%Y-%m-%d') || 'x' FROM daily WHERE day(day) IN (13, 21)
UNION ALL SELECT 'cnt', '' FROM daily WHERE day(day) = 17""",
        "trend_roundtrip": f"WITH {_HOURLY_SQL} SELECT sid, pos, total, cnt FROM hourly_pos",
        "trend_fit": f"""WITH {_HOURLY_SQL}, {_plan_sql('hourly_pos', SMALL)}, {_cells_sql('hourly_pos', HOURLY.values)},
used AS (SELECT c.sid, c.variable, c.pos, c.value, p.lost + (p.train_size + 7) / 2.0 AS center
  FROM cells c JOIN plan p ON c.sid = p.sid WHERE c.pos >= p.lost AND c.pos < p.lost + p.train_size + 8 AND p.n_test > 1),
line AS (SELECT sid, variable, max(center) AS center, regr_slope(value, pos - center) AS slope, avg(value) AS level FROM used GROUP BY 1, 2),
season AS (SELECT u.sid, u.variable, CAST(u.pos % 24 AS INTEGER) AS phase, avg(u.value - l.level - l.slope * (u.pos - l.center)) AS season
  FROM used u JOIN line l ON u.sid = l.sid AND u.variable = l.variable GROUP BY 1, 2, 3)
SELECT l.sid, l.variable, CAST(l.center AS DOUBLE) AS center, round(l.slope, 5) + 0.0 AS slope, round(l.level, 5) + 0.0 AS level,
  CAST(k.phase AS INTEGER) AS phase, round(coalesce(s.season, 0), 5) + 0.0 AS season
FROM line l CROSS JOIN (SELECT unnest(range(24)) AS phase) k
LEFT JOIN season s ON s.sid = l.sid AND s.variable = l.variable AND s.phase = k.phase""",
        "validate_steps": f"""WITH {_plan_sql('(SELECT user_id AS sid FROM events)', MIXED)}
SELECT sid, CASE WHEN n_test <= 1 THEN 'too few test batches: raise test_ratio or lower batch'
  ELSE 'steps must be smaller than window' END AS error FROM plan""",
        "forecast_fixed": f"""{_heads_fixed_sql(True)}
SELECT sid, i, step, pos, target, value FROM steps WHERE newest AND step BETWEEN 1 AND 5""",
        "write_check": f"""{check_sql}
SELECT sid, batch, i, step, pos, max(value) FILTER (target = 'total') AS total,
  max(value) FILTER (target = 'cnt') AS cnt, '7' AS run_id FROM check_rows GROUP BY ALL""",
        "write_forecast": f"""{check_sql}
SELECT sid, i, step, pos, max(value) FILTER (target = 'total') AS total,
  max(value) FILTER (target = 'cnt') AS cnt, '7' AS run_id FROM forecast_rows GROUP BY ALL""",
        "overlay": _overlay_sql("pos", "pos"),
        "overlay_tail": _overlay_sql("n - ((n_test - 1) * 6 + 1) + batch * 6 + step", "n + step - 1"),
        "mse": f"""WITH {_SHIP_SQL}, {_heads_sql('ship_pos', SHIP, SMALL)}
SELECT k.sid, k.target, round(avg((c.value - k.value) * (c.value - k.value)), 2) AS mse
FROM check_rows k JOIN cells c ON c.sid = k.sid AND c.pos = k.pos AND c.variable = k.target GROUP BY 1, 2""",
        **CORPUS_SQL,
    }
