"""Training: one network per series, or one network by parameter averaging.

A series trains mini-batch after mini-batch, whatever its length. Tasks train many
short series side by side, since their networks are tiny. A long one is cut into
pieces, which its task reads one after another from the shared folder, in every epoch;
its parameters are stored on the way, and another attempt goes on from there.

One network for all series trains in shards, which are a matter of the data and the
configuration, not of the cluster. All shards start a round from the same parameters,
train some mini-batches, and the average is the next start. The tasks that hold the
shards run at once as a barrier stage and exchange sums: training is one job. Sums are
exact, so that the number of tasks changes no digit.
"""

from __future__ import annotations

import functools
import json
import math
import pickle
import time
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions import cell

from tempolane.functions.columns import div
from tempolane.functions.stream import alike, field, key_columns, packs, stack, whole_series
from tempolane.operators.position import MAX_TASKS
from tempolane.plans.prepare import (
    first_row_of,
    in_series_order,
    in_training,
    pieces,
    prepare,
    row_in_plan,
)
from tempolane.sources import files
from tempolane.sources.shared import new_path, settled

HISTORY = "array<struct<epoch:int,round:int,partition:int,n_windows:bigint,loss:double,fit_ms:bigint>>"
STATS = "epoch int, round int, partition int, n_windows bigint, loss double, fit_ms bigint"
SCALER = "struct<f_min:array<double>,f_max:array<double>,l_min:array<double>,l_max:array<double>>"
# Examples of a piece of a series, and mini-batches between two stored states.
PIECE_EXAMPLES = 8_192
STORE_BATCHES = 20_000
# Rows that a shard of pooled training holds, where the configuration doesn't say how many.
SHARD_ROWS = 4_000_000
LEAST_SHARDS = 8
# Shards that are worth a task: tasks wait for each other in every round, which takes
# Spark about a second, in which a task can train so many shards.
TASK_SHARDS = 32
# Doubles in the working arrays of one numpy call: small enough for a cache.
_WORK = 1 << 18


class Trained(NamedTuple):
    models: DataFrame
    stats: DataFrame
    ranges: DataFrame  # (keys, scaler) of each series


def _key_schema(df: DataFrame, spec: SeriesSpec) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in spec.keys]


def _with_fields(fields: list[T.StructField], ddl: str) -> T.StructType:
    return T.StructType([*fields, *T.StructType.fromDDL(ddl).fields])


def _describe(models: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, model_id: str | None) -> DataFrame:
    return models.select(
        F.lit(model_id or f"m{uuid.uuid4().hex}").alias("model_id"),
        *spec.keys,
        F.lit(cfg.to_json()).alias("config"),
        F.array(*[F.lit(v) for v in spec.values]).alias("inputs"),
        F.array(*[F.lit(t) for t in spec.targets]).alias("targets"),
        "params",
        "updater",
        "scaler",
        "history",
    )


# --- one network per series ----------------------------------------------------


def _fit_group(cfg: ForecastConfig, net: cell.Net, group: list, partition: int):
    """Train some series side by side. `group` is sorted by falling number of
    mini-batches, so that those still at work are always the first ones."""
    counts = np.array([field(first, "n_train") for first, _, _ in group])
    xs, ys = stack([x for _, x, _ in group]), stack([y for _, _, y in group])
    theta = np.repeat(net.initial(cfg.seed)[None], len(group), 0)
    memory = np.zeros_like(theta)
    losses = np.zeros((len(group), cfg.epochs))
    millis = []
    for epoch in range(cfg.epochs):
        started = time.monotonic()
        for k in range(counts[0]):
            live, at = int((counts > k).sum()), k * cfg.batch
            x = cell.cut_examples(xs[:live], cfg.window, at, cfg.batch)
            y = ys[:live, at + cfg.window : at + cfg.window + cfg.batch]
            losses[:live, epoch] += cell.fit_batch(
                cfg, net, theta[:live], memory[:live], x, y, (epoch << 32) + k
            )
        millis.append(int(1000 * (time.monotonic() - started)))
    losses /= counts[:, None]
    for g in range(len(group)):
        yield theta[g], memory[g], [
            {
                "epoch": e,
                "round": 0,
                "partition": partition,
                "n_windows": int(counts[g]) * cfg.batch,
                "loss": float(losses[g, e]),
                "fit_ms": millis[e],
            }
            for e in range(cfg.epochs)
        ]


def _fit_series(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    partition = context.partitionId() if context else 0
    size = max(1, _WORK // (cfg.window * cfg.batch * 4 * cfg.hidden))
    for pack in packs(whole_series(batches)):
        params, memories, histories, firsts = [], [], [], []
        for group in alike(pack, lambda item: field(item[0], "n_train"), size):
            for (first, _, _), (theta, memory, history) in zip(group, _fit_group(cfg, net, group, partition)):
                firsts.append(first)
                params.append(theta)
                memories.append(memory)
                histories.append(history)
        yield pa.RecordBatch.from_arrays(
            [
                *key_columns(firsts, keys),
                pa.array(params, pa.list_(pa.float64())),
                pa.array(memories, pa.list_(pa.float64())),
                pa.concat_arrays([f.column("scaler") for f in firsts]).cast(schema.field("scaler").type),
                pa.array(histories, schema.field("history").type),
            ],
            schema=schema,
        )


def _train_short(rows: DataFrame, spec: SeriesSpec, cfg: ForecastConfig) -> DataFrame:
    head = row_in_plan() == 0
    feed = in_series_order(rows.where(in_training(cfg)), spec).select(
        *spec.keys, head.alias("head"), "n_train", "xs", "ys", first_row_of(head, F.col("scaler")).alias("scaler")
    )
    schema = _with_fields(
        _key_schema(rows, spec),
        f"params array<double>, updater array<double>, scaler {SCALER}, history {HISTORY}",
    )
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    work = functools.partial(_fit_series, cfg, net, spec.keys, _arrow(schema))
    return feed.mapInArrow(work, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def train_per_series(
    df: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    on_error: str = "raise",
    model_id: str | None = None,
) -> DataFrame:
    """One model per series: (model_id, keys, config, inputs, targets, params,
    updater, scaler, history).

    Lazy, but for cutting series above `cfg.long_rows` into pieces. Every series is
    trained by the same rule, and so with the same result, on either side of it."""
    lanes, tasks, _ = prepare(df, spec, cfg, on_error)
    models = []
    if lanes.short is not None:
        models.append(_train_short(lanes.short, spec, cfg))
    if lanes.long is not None:
        models.append(_train_long(lanes.long, spec, cfg, tasks))
    return _describe(functools.reduce(DataFrame.unionByName, models), spec, cfg, model_id)


def training_stats(models: DataFrame, run_id: str) -> DataFrame:
    """(run_id, keys, epoch, round, partition, n_windows, loss, fit_ms) of saved
    or trained models."""
    keys = models.columns[1 : models.columns.index("config")]
    return models.select(F.lit(run_id).alias("run_id"), *keys, F.explode("history").alias("h")).select(
        "run_id", *keys, "h.*"
    )


# --- long series, piece by piece ---------------------------------------------------


def field_array(row: pa.RecordBatch, name: str) -> np.ndarray:
    return row.column(name).flatten().to_numpy(zero_copy_only=False)


def _mini_batches(cfg: ForecastConfig, net: cell.Net, row: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of each mini-batch of a piece."""
    xs = field_array(row, "xs").reshape(1, -1, net.inputs)
    ys = field_array(row, "ys").reshape(1, -1, net.outputs)
    for k in range((xs.shape[1] - cfg.window) // cfg.batch):
        first = k * cfg.batch
        yield cell.cut_examples(xs, cfg.window, first, cfg.batch), ys[:, first + cfg.window : first + cfg.window + cfg.batch]


def _piece_batches(cfg: ForecastConfig) -> int:
    return max(1, PIECE_EXAMPLES // cfg.batch)


def _training_pieces(rows: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, tasks: int) -> DataFrame:
    count = F.col("n_train") * cfg.batch
    return pieces(rows, spec, _piece_batches(cfg) * cfg.batch, cfg.window, in_training(cfg), count, tasks)


def _stored(rows: DataFrame, by: str, order: list, many: int, path: str) -> list[int]:
    """Write `rows` in one sorted folder for each number `by`; returns the numbers."""
    laid = rows.repartition(many, by).sortWithinPartitions(by, *order)
    # Small row groups: a reader holds one at a time.
    laid.write.option("parquet.block.size", 8 << 20).partitionBy(by).parquet(path)
    found = rows.sparkSession.read.parquet(path).select(by).distinct()  # at most `many`
    return sorted(r[0] for r in found.collect())


class _Fitting:
    """The state of training the series of one folder: where it stands and, for each
    series, its parameters. Kept in the shared folder under a name that tells where."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name = folder, name
        self.epoch = self.done = 0
        self.series: dict[tuple, dict] = {}
        found = [n for n in files.names(folder) if n.startswith(f"{name}.")]
        self.last = max(found, default=None)
        if self.last:
            self.epoch, self.done, self.series = pickle.loads(files.get(folder, self.last))

    def store(self) -> None:
        now = f"{self.name}.{self.epoch:06d}-{self.done:012d}"
        files.put(self.folder, now, pickle.dumps((self.epoch, self.done, self.series)))
        if self.last and self.last != now:
            files.drop(self.folder, self.last)
        self.last = now


def _fit_folder(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], base: str, per: int, number: int, partition: int
) -> list[tuple[pa.RecordBatch, dict]]:
    """(first piece's keys and scaler, state) of each series of a folder, trained in
    order of pieces, of `per` mini-batches, for all epochs. Holds a few pieces and the
    parameters."""
    state = _Fitting(f"{base}/state", f"bin-{number}")
    columns = [*keys, "piece", "scaler", "xs", "ys"]
    since = 0
    while state.epoch < cfg.epochs or not state.series:
        for at, row in enumerate(files.table_rows(f"{base}/pieces/bin={number}", columns)):
            if at < state.done:
                continue
            name = tuple(field(row, k) for k in keys)
            own = state.series.get(name)
            if own is None:
                theta = net.initial(cfg.seed)[None]
                own = {"first": row.select([*keys, "scaler"]).take([0]), "theta": theta, "memory": np.zeros_like(theta), "history": []}
                state.series[name] = own
            if state.epoch < cfg.epochs:
                if len(own["history"]) == state.epoch:
                    own["history"].append({"epoch": state.epoch, "round": 0, "partition": partition, "n_windows": 0, "loss": 0.0, "fit_ms": 0})
                log, started = own["history"][-1], time.monotonic()
                first = field(row, "piece") * per
                for k, (x, y) in enumerate(_mini_batches(cfg, net, row), first):
                    log["loss"] += float(cell.fit_batch(cfg, net, own["theta"], own["memory"], x, y, (state.epoch << 32) + k)[0])
                    log["n_windows"] += cfg.batch
                    since += 1
                log["fit_ms"] += int(1000 * (time.monotonic() - started))
            state.done = at + 1
            if since >= STORE_BATCHES:
                state.store()
                since = 0
        for own in state.series.values():
            if own["history"]:
                own["history"][-1]["loss"] /= max(1, own["history"][-1]["n_windows"] // cfg.batch)
        state.epoch, state.done = state.epoch + 1, 0
        state.store()
    return [(own["first"], own) for own in state.series.values()]


def _fit_folders(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, base: str, per: int, numbers: list[int],
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    for batch in batches:
        for i in batch.column(0).to_pylist():
            found = _fit_folder(cfg, net, keys, base, per, numbers[i], context.partitionId() if context else 0)
            firsts = [first for first, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *key_columns(firsts, keys),
                    pa.array([own["theta"][0] for _, own in found], pa.list_(pa.float64())),
                    pa.array([own["memory"][0] for _, own in found], pa.list_(pa.float64())),
                    pa.concat_arrays([f.column("scaler") for f in firsts]).cast(schema.field("scaler").type),
                    pa.array([own["history"] for _, own in found], schema.field("history").type),
                ],
                schema=schema,
            )


def _train_long(rows: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, tasks: int) -> DataFrame:
    """Series that are too long to be held: a folder of pieces for few of them, and a
    task for a folder."""
    spark, keys = rows.sparkSession, list(spec.keys)
    base, many = new_path(spark, "training"), min(MAX_TASKS, 4 * tasks)
    cut = _training_pieces(rows, spec, cfg, tasks)
    number = F.pmod(F.xxhash64(*keys), F.lit(many)).cast("int") if keys else F.lit(0)
    numbers = _stored(cut.withColumn("bin", number).select("bin", *keys, "piece", "scaler", "xs", "ys"), "bin", [*keys, "piece"], many, f"{base}/pieces")
    schema = _with_fields(
        _key_schema(rows, spec), f"params array<double>, updater array<double>, scaler {SCALER}, history {HISTORY}"
    )
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    work = functools.partial(_fit_folders, cfg, net, spec.keys, _arrow(schema), base, _piece_batches(cfg), numbers)
    return spark.range(0, len(numbers), 1, max(1, len(numbers))).mapInArrow(work, schema)


# --- one network by parameter averaging ------------------------------------------


# Bits after the point of sums of parameters. Every double from 2^-8 on is exact.
_POINT = 60


def _exact(values: np.ndarray, weight: int) -> list[int] | None:
    """The values times a whole weight, in units of 2^-60; None if one is no number."""
    scaled = values * float(1 << _POINT)
    if not np.isfinite(scaled).all():
        return None
    return [weight * round(v) for v in scaled.tolist()]


def _summed(parts: list[list[int] | None]) -> list[int] | None:
    return None if any(p is None for p in parts) else [sum(p) for p in zip(*parts)]


def _mean(total: list[int] | None, weight: int, size: int) -> np.ndarray:
    """Of exact sums; the division rounds once."""
    if total is None:
        return np.full(size, np.nan)
    return np.array([v / (weight << _POINT) for v in total])


class _Shard:
    """Mini-batches of a shard in order, some at a time."""

    def __init__(self, cfg: ForecastConfig, net: cell.Net, folder: str):
        self.cfg, self.net = cfg, net
        self.stream = (b for row in files.table_rows(folder, ["xs", "ys"], 1) for b in _mini_batches(cfg, net, row))

    def fit(self, start: tuple[np.ndarray, np.ndarray], ticks: range) -> tuple[np.ndarray, np.ndarray, float]:
        """Parameters and updater after the next mini-batches, and their losses."""
        theta, memory, loss = start[0][None].copy(), start[1][None].copy(), 0.0
        for tick in ticks:
            x, y = next(self.stream)
            loss += float(cell.fit_batch(self.cfg, self.net, theta, memory, x, y, tick)[0])
        return theta[0], memory[0], loss


def _stretch(count: int, number: int, rounds: int, each: int | None) -> range:
    """Mini-batches of a shard of `count` in one round: `each`, or a share of all."""
    if each:
        return range(min(count, number * each), min(count, (number + 1) * each))
    return range(count * number // rounds, count * (number + 1) // rounds)


def _fit_shards(
    cfg: ForecastConfig, net: cell.Net, base: str, counts: dict[int, int], rounds: int, each: int | None, tasks: int,
    schema: pa.Schema, batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """A barrier task, or the only one: trains every `tasks`-th shard. The first task
    stores the state after each epoch, returns the model in the end, and all go on from
    the newest state after a loss."""
    context = BarrierTaskContext.get() if tasks > 1 else TaskContext.get()
    me = context.partitionId()
    for _ in batches:
        pass
    state = f"{base}/state"
    own = [s for i, s in enumerate(sorted(counts)) if i % tasks == me]
    newest = max(files.names(state), default="") if me == 0 else ""
    newest = _exchanged(context, tasks, [newest])[0][0]
    epoch, theta, memory, history = 0, net.initial(cfg.seed), np.zeros(net.size), []
    if newest:
        epoch, theta, memory, history = pickle.loads(files.get(state, newest))
    while epoch < cfg.epochs:
        shards = {s: _Shard(cfg, net, f"{base}/pieces/shard={s}") for s in own}
        logs, losses, started = [], 0, time.monotonic()
        for number in range(rounds):
            parts = []
            for s in own:
                at = _stretch(counts[s], number, rounds, each)
                if not at:
                    continue
                begun = time.monotonic()
                ticks = range(((epoch * (max(counts) + 1) + s) << 32) + at.start, ((epoch * (max(counts) + 1) + s) << 32) + at.stop)
                fitted = shards[s].fit((theta, memory), ticks)
                parts.append((len(at), _exact(fitted[0], len(at)), _exact(fitted[1], len(at))))
                losses += round(fitted[2] * float(1 << _POINT)) if math.isfinite(fitted[2]) else 0
                logs.append((epoch, number, s, len(at) * cfg.batch, fitted[2] / len(at), int(1000 * (time.monotonic() - begun))))
            told = [sum(p[0] for p in parts), *(_summed([p[i] for p in parts]) for i in (1, 2))]
            heard = [h for h in _exchanged(context, tasks, told) if h[0]]
            weight = sum(h[0] for h in heard)
            if weight:
                theta = _mean(_summed([h[1] for h in heard]), weight, net.size)
                memory = _mean(_summed([h[2] for h in heard]), weight, net.size)
        _put_log(f"{base}/stats", f"{epoch:06d}-{me:06d}.parquet", logs)
        spent = int(1000 * (time.monotonic() - started))
        heard = _exchanged(context, tasks, [losses, spent])
        n = sum(counts.values())
        history = [*history, {
            "epoch": epoch, "round": 0, "partition": -1, "n_windows": n * cfg.batch,
            "loss": sum(h[0] for h in heard) / (max(1, n) << _POINT), "fit_ms": sum(h[1] for h in heard),
        }]
        epoch += 1
        if me == 0:
            files.put(state, f"{epoch:06d}", pickle.dumps((epoch, theta, memory, history)))
    if me == 0:
        yield pa.RecordBatch.from_arrays([pa.array([theta.tolist()]), pa.array([memory.tolist()]), pa.array([history], schema.field("history").type)], schema=schema)


def _exchanged(context: BarrierTaskContext, tasks: int, told: list) -> list[list]:
    """What each task says."""
    if tasks == 1:
        return [told]
    return [json.loads(m) for m in context.allGather(json.dumps(told))]


def _put_log(folder: str, name: str, logs: list[tuple]) -> None:
    columns = list(zip(*logs)) if logs else [()] * 6
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64())
    table = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in STATS.split(", ")])
    out = pa.BufferOutputStream()
    pq.write_table(table, out)
    files.put(folder, name, out.getvalue().to_pybytes())


def train_pooled(
    df: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    rounds_per_epoch: int | None = None,
    on_error: str = "raise",
    model_id: str | None = None,
    tasks: int | None = None,
) -> Trained:
    """One network for all series, each scaled by its own range.

    Pieces of series are dealt to `cfg.shards` shards by a hash. In a round each shard
    trains `cfg.averaging_frequency` mini-batches, or its share of `rounds_per_epoch`
    rounds; averages are weighted by mini-batches. The result depends on rows and
    configuration only. `tasks` (by default one for `TASK_SHARDS` shards, at most as
    many as run at once) must fit into the cluster together: several form a barrier
    stage, which Spark refuses with dynamic allocation. Runs at once; `models` has one row and
    `stats` one per epoch, round and shard."""
    spark = df.sparkSession
    lanes, spread, total = prepare(df, spec, cfg, on_error)
    shards = cfg.shards or max(LEAST_SHARDS, -(-total // SHARD_ROWS))
    base, place = new_path(spark, "training"), [*spec.keys, "piece"]
    cut = _training_pieces(lanes.union(), spec, cfg, spread)
    cut = cut.withColumns({
        "shard": F.pmod(F.xxhash64(*place), F.lit(shards)).cast("int"), "turn": F.xxhash64(F.lit("turn"), *place),
        "n_batches": div((F.size("xs") / len(spec.values)).cast("bigint") - cfg.window, cfg.batch),
    })
    _stored(cut.select("shard", "turn", *place, "n_batches", "scaler", "xs", "ys"), "shard", ["turn", *place], shards, f"{base}/pieces")
    sums = spark.read.parquet(f"{base}/pieces").groupBy("shard").agg(F.sum("n_batches")).collect()  # a row a shard
    counts = {r[0]: r[1] for r in sums}
    each = None if rounds_per_epoch else cfg.averaging_frequency
    rounds = rounds_per_epoch or max((-(-n // each) for n in counts.values()), default=0)
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    schema = T.StructType.fromDDL(f"params array<double>, updater array<double>, history {HISTORY}")
    useful = min(spark.sparkContext.defaultParallelism, -(-len(counts) // TASK_SHARDS))
    tasks = max(1, min(tasks or useful, len(counts)))
    work = functools.partial(_fit_shards, cfg, net, base, counts, rounds, each, tasks, _arrow(schema))
    fitted = spark.range(0, tasks, 1, tasks).mapInArrow(work, schema, barrier=tasks > 1)
    model = settled(fitted, f"{base}/model").withColumn("scaler", F.lit(None).cast(SCALER))
    stats = spark.read.schema(STATS).parquet(f"{base}/stats") if cfg.epochs else spark.createDataFrame([], STATS)
    bare = SeriesSpec(order=spec.order, values=spec.values, targets=spec.targets)
    ranges = spark.read.parquet(f"{base}/pieces").where("piece = 0").select(*spec.keys, F.col("scaler").cast(SCALER).alias("scaler"))
    return Trained(_describe(model.select("params", "updater", "scaler", "history"), bare, cfg, model_id), stats, ranges)
