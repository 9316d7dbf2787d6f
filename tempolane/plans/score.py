"""Applying trained networks: reported heads, all examples, check and forecast.

The network is stateful when it reports: its hidden state runs from mini-batch
to mini-batch, through the training part first. Only the first example of each
mini-batch is reported and examples do not mix, so the state is carried through
these heads alone.

A short series is one chain in one task. A long one is cut into pieces that are
worked on at once: each piece starts from a guess of its state, then every piece
whose guess differs from the end of the piece before is run again. The state
mostly forgets quickly, so that few such passes leave no difference. After
`GUESSES` of them the series that are still open are relayed: their pieces come
in order, one task hands the state from piece to piece, and runs those anew that
had started from another one. The number of jobs is fixed, and the result is the
sequential one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tempolane.config import ForecastConfig, SeriesSpec
from tempolane.functions import cell
from tempolane.functions.columns import div
from tempolane.functions.stream import alike, field, key_columns, nested, packs, stack, whole_series
from tempolane.operators.heads import slice_steps
from tempolane.operators.position import Lanes
from tempolane.operators.scaling import unpack_scalers
from tempolane.plans.prepare import first_row_of, in_series_order, pieces, prepare, row_in_plan
from tempolane.sources.shared import new_path, settled

HEADS = "batch bigint, i bigint, is_last boolean, yhat array<array<double>>"
SCORES = "i bigint, yhat array<array<double>>"
CHAIN = "piece bigint, h_in array<double>, h_out array<double>"
# Mini-batches per piece of a long chain, and examples per stateless piece.
PIECE_BATCHES = 64
PIECE_EXAMPLES = 2_048
# Short series that go through the network together.
SIDE_BY_SIDE = 2_048
# Passes over all pieces at once before what is open is relayed.
GUESSES = 3
# Largest difference between a piece's start and the end of the one before.
TOLERANCE = 1e-12


def _schema(df: DataFrame, spec: SeriesSpec, ddl: str) -> T.StructType:
    return T.StructType([*[df.schema[k] for k in spec.keys], *T.StructType.fromDDL(ddl).fields])


def _model_parameters(models: DataFrame, spec: SeriesSpec, cfg: ForecastConfig) -> DataFrame | list[float]:
    """(keys, params), or the parameters themselves if one model serves all
    series. Fails if the models were made for other inputs or another network."""
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    fits = (
        (F.size("params") == net.size)
        & (F.col("inputs") == F.array(*[F.lit(v) for v in spec.values]))
        & (F.col("targets") == F.array(*[F.lit(t) for t in spec.targets]))
    )
    named = [c for c in ("inputs", "targets", "config") if c in models.columns]
    if "config" in named:  # weights made elsewhere come without one
        fits &= F.get_json_object("config", "$.activation") == cfg.activation
    told = F.concat(F.lit(f"the model does not fit {net.inputs} inputs, {net.hidden} hidden nodes, "
                          f"{net.outputs} targets and {cfg.activation}: "), F.to_json(F.struct(*named)))
    checked = models.withColumn("params", F.when(fits, F.col("params")).otherwise(F.raise_error(told)))
    own = [k for k in spec.keys if k in models.columns]
    if own:
        return checked.select(*own, "params")
    rows = checked.select("params").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one model for all series, found {'none' if not rows else 'several'}")
    return list(rows[0]["params"])


def _stored_scalers(models: DataFrame, spec: SeriesSpec, ranges: DataFrame | None) -> DataFrame:
    if ranges is None and not all(k in models.columns for k in spec.keys):
        raise ValueError("a model for all series needs the ranges that were stored with it, or refit_scaler=True")
    return unpack_scalers(models if ranges is None else ranges, spec)


def _joins(lanes: Lanes, parameters, spec: SeriesSpec, size: int):
    """Two ways to add `params`: by a join on the layout the rows of a lane
    already have, or, where the long series' are small, by a broadcast."""
    keys = list(spec.keys)
    if isinstance(parameters, list):
        same = lambda rows: rows.withColumn("params", F.lit(parameters))
        return same, same

    def plain(rows: DataFrame) -> DataFrame:
        return rows.join(parameters, keys, "left")

    def named(rows: DataFrame) -> DataFrame:
        return rows.join(lanes.sent(parameters.join(lanes.names, keys, "left_semi"), size), keys, "left")

    return plain, named


def _theta(first: pa.RecordBatch, keys: tuple[str, ...]) -> list[float]:
    params = field(first, "params")
    if params is None:
        raise ValueError(f"no model for series {[field(first, k) for k in keys]}")
    return params


def _restore(y: np.ndarray, scaler: dict) -> np.ndarray:
    low, high = np.array(scaler["l_min"]), np.array(scaler["l_max"])
    return y * (high - low) + low


# --- chains of heads -------------------------------------------------------------


def _chain_series(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, warm: bool,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    def runs_of(item) -> int:
        return (field(item[0], "n_train") if warm else 0) + field(item[0], "n_test")

    for pack in packs(whole_series(batches)):
        for group in alike(pack, runs_of, SIDE_BY_SIDE):
            yield _chain_group(cfg, net, keys, schema, warm, group, np.array([runs_of(g) for g in group]))


def _chain_group(cfg, net, keys, schema, warm, group: list, runs: np.ndarray) -> pa.RecordBatch:
    """Chains of some series side by side, the longest first."""
    stride = min(cfg.batch, cfg.window)  # rows between heads in the feed
    firsts = [f for f, _, _ in group]
    theta = np.array([_theta(f, keys) for f in firsts])
    xs = stack([x for _, x, _ in group])
    told = [{c: field(f, c) for c in ("lost", "n_train", "n_test", "scaler")} for f in firsts]
    state = cell.zero_state(len(group), 1, net.hidden)
    found = []
    for k in range(runs[0]):
        live = int((runs > k).sum())
        x = cell.cut_examples(xs[:live], cfg.window, k * stride, 1)
        hs, state = cell.forward(net, theta[:live], x, (state[0][:live], state[1][:live]))
        y = cell.outputs(net, theta[:live], hs)[: cfg.steps + 1, :, 0]
        for g in range(live):
            test = k - told[g]["n_train"] if warm else k
            if test >= 0:
                found.append((g, test, y[:, g]))
    return _head_rows(cfg, schema, key_columns(firsts, keys), told, found)


def _head_rows(cfg, schema: pa.Schema, names: list[pa.Array], told: list[dict], found: list) -> pa.RecordBatch:
    """Rows of `score_heads` from (series, number of the test head, outputs)."""
    rows = pa.array([g for g, _, _ in found], pa.int64())
    yhat = [_restore(y, told[g]["scaler"]) for g, _, y in found]
    i = [told[g]["lost"] + (told[g]["n_train"] + test) * cfg.batch for g, test, _ in found]
    return pa.RecordBatch.from_arrays(
        [*[c.take(rows) for c in names], pa.array([t for _, t, _ in found], pa.int64()), pa.array(i, pa.int64()),
         pa.array([t == told[g]["n_test"] - 1 for g, t, _ in found], pa.bool_()),
         nested(np.array(yhat)).cast(schema.field("yhat").type)],
        schema=schema,
    )


def _heads_short(rows: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, warm: bool) -> DataFrame:
    at = row_in_plan()
    start = F.lit(0).cast("bigint") if warm else F.col("n_train") * cfg.batch
    last = (F.col("n_train") + F.col("n_test") - 1) * cfg.batch
    # Rows between two heads are not read at all.
    used = (at >= start) & (at < last + cfg.window)
    if cfg.batch > cfg.window:
        used &= at % cfg.batch < cfg.window
    head = at == start
    feed = in_series_order(rows.where(used), spec).select(
        *spec.keys, head.alias("head"), "lost", "n_train", "n_test", "xs", "ys",
        first_row_of(head, F.col("scaler")).alias("scaler"),
        first_row_of(head, F.col("params")).alias("params"),
    )
    schema = _schema(rows, spec, HEADS)
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    work = functools.partial(_chain_series, cfg, net, spec.keys, to_arrow_schema(schema), warm)
    return feed.mapInArrow(work, schema)


def _run_piece(cfg: ForecastConfig, net: cell.Net, row: pa.RecordBatch, state, start: int):
    """Heads start.. of one piece from the packed state (h, c): yields their
    outputs, then returns the packed state."""
    xs = row.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(1, -1, net.inputs)
    theta = np.array([field(row, "params")])
    h, c = state[: net.hidden].reshape(1, 1, -1), state[net.hidden :].reshape(1, 1, -1)
    for k in range(start, (xs.shape[1] - cfg.window) // cfg.batch + 1):
        hs, (h, c) = cell.forward(net, theta, cell.cut_examples(xs, cfg.window, k * cfg.batch, 1), (h, c))
        yield k, cell.outputs(net, theta, hs)[: cfg.steps + 1, 0, 0]
    return np.concatenate((h.reshape(-1), c.reshape(-1)))


def _through(run) -> np.ndarray:
    """The state after all heads of a piece."""
    while True:
        try:
            next(run)
        except StopIteration as done:
            return done.value


def _piece_start(row: pa.RecordBatch, warm: bool, size: int) -> int:
    """First head of a piece that is run at all."""
    return 0 if warm else max(0, field(row, "n_train") - field(row, "piece") * size)


def _chain_pieces(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, warm: bool, size: int,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = []
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            _theta(row, keys)
            ends.append(_through(_run_piece(cfg, net, row, np.array(field(row, "h_in")), _piece_start(row, warm, size))))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in keys], batch.column("piece"), batch.column("h_in").cast(schema.field("h_in").type),
             pa.array(ends, pa.list_(pa.float64()))],
            schema=schema,
        )


def _stale(states: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces that did not start where the one before ended, with that state."""
    place = [*keys, "piece"]
    before = states.select(*keys, (F.col("piece") + 1).alias("piece"), F.col("h_out").alias("h_new"))
    gap = F.array_max(F.zip_with("h_in", "h_new", lambda a, b: F.abs(a - b)))
    return states.join(before, place).where(gap > TOLERANCE)


def _relay_pieces(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, warm: bool, size: int,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """Pieces in order, with what they started from and ended with: the state goes
    from one to the next, and a piece is run where it started from another."""
    name, state = None, None
    for batch in batches:
        starts, ends = [], []
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            here, guess = [field(row, k) for k in keys], np.array(field(row, "h_in"))
            if here != name or state is None:
                name, state = here, guess
            if np.abs(state - guess).max() <= TOLERANCE:
                end = np.array(field(row, "h_out"))
                state = guess
            else:
                end = _through(_run_piece(cfg, net, row, state, _piece_start(row, warm, size)))
            starts.append(state)
            ends.append(end)
            state = end
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in keys], batch.column("piece"), pa.array(starts, pa.list_(pa.float64())), pa.array(ends, pa.list_(pa.float64()))],
            schema=schema,
        )


def _report_pieces(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, warm: bool, size: int,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told, found = [], []
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            told.append({c: field(row, c) for c in ("lost", "n_train", "n_test", "scaler")})
            before = field(row, "piece") * size - told[at]["n_train"]
            for k, y in _run_piece(cfg, net, row, np.array(field(row, "h_in")), _piece_start(row, warm, size)):
                if before + k >= 0:
                    found.append((at, before + k, y))
        if found:
            yield _head_rows(cfg, schema, [batch.column(k) for k in keys], told, found)


def _heads_long(
    rows: DataFrame, attach, spec: SeriesSpec, cfg: ForecastConfig, warm: bool, size: int, tasks: int
) -> DataFrame:
    spark, keys = rows.sparkSession, list(spec.keys)
    place = [*keys, "piece"]
    heads = F.col("n_train") + F.col("n_test")
    used = row_in_plan() < (heads - 1) * cfg.batch + cfg.window
    if not warm:
        used &= row_in_plan() >= div(F.col("n_train"), size) * size * cfg.batch
    cut = pieces(
        rows, spec, size * cfg.batch, cfg.window - cfg.batch if cfg.window > cfg.batch else 0, used,
        heads * cfg.batch, tasks,
    )
    if not warm:
        cut = cut.where((F.col("piece") + 1) * size > F.col("n_train"))
    base = new_path(spark, "chain")
    cut = settled(attach(cut).drop("ys"), f"{base}/pieces")
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    chain_schema = _schema(rows, spec, CHAIN)
    work = functools.partial(_chain_pieces, cfg, net, spec.keys, to_arrow_schema(chain_schema), warm, size)
    zeros = F.lit([0.0] * (2 * net.hidden))
    states = settled(cut.withColumn("h_in", zeros).mapInArrow(work, chain_schema), f"{base}/pass=0")
    for number in range(1, GUESSES + 1):
        stale = _stale(states, keys).select(*place, F.col("h_new").alias("h_in"))
        if stale.isEmpty():
            break
        again = cut.join(stale, place).select(*cut.columns, "h_in").mapInArrow(work, chain_schema)
        kept = states.join(stale.select(*place), place, "left_anti")
        states = settled(kept.unionByName(again), f"{base}/pass={number}")
    else:
        # Of each series that is still open, the pieces from the first stale one on.
        since = F.min(F.when(F.col("h_new").isNotNull(), F.col("piece"))).over(Window.partitionBy(*keys))
        late = states.join(_stale(states, keys).select(*place, "h_new"), place, "left").withColumn("since", since)
        late = late.where(F.col("piece") >= F.col("since") - 1).select(*place, "h_in", "h_out")
        feed = cut.join(late, place).select(*cut.columns, "h_in", "h_out")
        laid = feed.repartition(tasks, *keys) if keys else feed.repartition(1)
        relay = functools.partial(_relay_pieces, cfg, net, spec.keys, to_arrow_schema(chain_schema), warm, size)
        relayed = settled(laid.sortWithinPartitions(*place).mapInArrow(relay, chain_schema), f"{base}/relay")
        states = states.join(relayed.select(*place), place, "left_anti").unionByName(relayed)
    schema = _schema(rows, spec, HEADS)
    report = functools.partial(_report_pieces, cfg, net, spec.keys, to_arrow_schema(schema), warm, size)
    tested = cut.where((F.col("piece") + 1) * size > F.col("n_train"))
    return tested.join(states.select(*place, "h_in"), place).mapInArrow(report, schema)


def score_heads(
    df: DataFrame,
    models: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    warm: bool = True,
    on_error: str = "raise",
    refit_scaler: bool = True,
    piece_batches: int = PIECE_BATCHES,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """(keys, batch, i, is_last, yhat) of each test head; `yhat` holds steps
    0..F, one value per target, in the units of the data.

    `models` has one row per series, or one row in all. `warm` carries the state
    through the training part first. `refit_scaler=False` scales by the ranges
    stored with the models instead of those of the current training part; those of
    a model for all series are `ranges` (keys, scaler)."""
    parameters = _model_parameters(models, spec, cfg)
    scalers = None if refit_scaler else _stored_scalers(models, spec, ranges)
    lanes, tasks, _ = prepare(df, spec, cfg, on_error, scalers)

    def pieced(attach):
        return lambda rows: _heads_long(rows, attach, spec, cfg, warm, piece_batches, tasks)

    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    plain, named = _joins(lanes, parameters, spec, net.size)
    return lanes.map(lambda rows: _heads_short(plain(rows), spec, cfg, warm), pieced(named)).union()


# --- all examples, without state --------------------------------------------------


def _score_pieces(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, tested: bool, last_only: bool, size: int,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            theta = np.array([_theta(row, keys)])
            xs = row.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(1, -1, net.inputs)
            before = field(row, "piece") * size
            skip = max(0, field(row, "n_train") * cfg.batch - before) if tested else 0
            count = xs.shape[1] - cfg.window + 1 - skip
            hs, _ = cell.forward(net, theta, cell.cut_examples(xs, cfg.window, skip, count))
            y = cell.outputs(net, theta, hs[-1:] if last_only else hs)[:, 0].transpose(1, 0, 2)
            first = field(row, "lost") + before + skip
            same = pa.array(np.zeros(count, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [*[row.column(k).take(same) for k in keys], pa.array(np.arange(first, first + count)),
                 nested(_restore(y, field(row, "scaler"))).cast(schema.field("yhat").type)],
                schema=schema,
            )


def score_windows(
    df: DataFrame,
    models: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    split: str = "test",
    last_only: bool = False,
    on_error: str = "raise",
    refit_scaler: bool = True,
    piece_examples: int = PIECE_EXAMPLES,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """(keys, i, yhat) of every example of a split, each from a fresh state, one
    list per step (or only the last step), one value per target."""
    parameters = _model_parameters(models, spec, cfg)
    scalers = None if refit_scaler else _stored_scalers(models, spec, ranges)
    train = F.col("n_train") * cfg.batch
    every = (F.col("n_train") + F.col("n_test")) * cfg.batch
    if split not in ("train", "test", "all"):
        raise ValueError(f"split must be 'train', 'test' or 'all', got {split!r}")
    tested, count = split == "test", train if split == "train" else every
    first_piece = div(train, piece_examples) if tested else F.lit(0)
    used = (row_in_plan() < count + cfg.window - 1) & (row_in_plan() >= first_piece * piece_examples)

    lanes, tasks, _ = prepare(df, spec, cfg, on_error, scalers)

    def cut(rows: DataFrame, spread: int | None) -> DataFrame:
        parts = pieces(rows, spec, piece_examples, cfg.window - 1, used, count, spread)
        return parts.where(F.col("piece") >= first_piece)

    lanes = lanes.map(lambda rows: cut(rows, None), lambda rows: cut(rows, tasks))
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    schema = _schema(df, spec, SCORES)
    work = functools.partial(_score_pieces, cfg, net, spec.keys, to_arrow_schema(schema), tested, last_only, piece_examples)
    plain, named = _joins(lanes, parameters, spec, net.size)
    return lanes.map(plain, named).map(lambda rows: rows.mapInArrow(work, schema)).union()


# --- results ----------------------------------------------------------------------


def check_fit(
    df: DataFrame, models: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, warm: bool = True, **options
) -> DataFrame:
    """(keys, batch, i, step, pos, targets): fitted values on the test part."""
    return slice_steps(score_heads(df, models, spec, cfg, warm, **options), spec, cfg, "check")


def forecast(
    df: DataFrame, models: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, warm: bool = True, **options
) -> DataFrame:
    """(keys, i, step, pos, targets): `cfg.steps` rows per series, from the head
    of the newest test mini-batch. They lie inside the known data."""
    return slice_steps(score_heads(df, models, spec, cfg, warm, **options), spec, cfg, "forecast")


def _recur_series(
    cfg: ForecastConfig, net: cell.Net, keys: tuple[str, ...], schema: pa.Schema, steps: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Last windows (keys, n, xs, scaler, params) of many series at once: each step
    goes through a window from a fresh state, and what it ends with becomes the next
    row. The windows are a ring, of which the oldest row is written over."""
    for batch in batches:
        for start in range(0, batch.num_rows, SIDE_BY_SIDE):
            rows = batch.slice(start, SIDE_BY_SIDE)
            told = [{c: field(rows.slice(at, 1), c) for c in ("n", "scaler")} for at in range(rows.num_rows)]
            theta = np.array([_theta(rows.slice(at, 1), keys) for at in range(rows.num_rows)])
            ring = rows.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, cfg.window, net.inputs).copy()
            low, high, f_low, f_high = (np.array([t["scaler"][c] for t in told]) for c in ("l_min", "l_max", "f_min", "f_max"))
            width = np.where(f_high == f_low, np.inf, f_high - f_low)  # a constant column is 0
            found = np.empty((rows.num_rows, steps, net.outputs))
            for step in range(steps):
                order = (np.arange(cfg.window) + step) % cfg.window
                hs, _ = cell.forward(net, theta, np.ascontiguousarray(ring[:, order].transpose(1, 0, 2)[:, :, None]))
                y = cell.outputs(net, theta, hs[-1:])[0, :, 0] * (high - low) + low
                found[:, step] = y
                ring[:, step % cfg.window] = (y - f_low) / width
            same = pa.array(np.repeat(np.arange(rows.num_rows), steps))
            first = np.array([t["n"] for t in told])
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(k).take(same) for k in keys],
                    pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), rows.num_rows)),
                    pa.array((first[:, None] + np.arange(steps)).reshape(-1)),
                    *[pa.array(found[:, :, k].reshape(-1)) for k in range(net.outputs)],
                ],
                schema=schema,
            )


def recursive_forecast(
    df: DataFrame,
    models: DataFrame,
    spec: SeriesSpec,
    cfg: ForecastConfig,
    steps: int | None = None,
    on_error: str = "raise",
    refit_scaler: bool = True,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """(keys, step, pos, targets): `steps` rows (default `cfg.steps`) after the last
    one of each series, any number of them. A prediction is the next row's input, so
    all inputs must be targets. Only the last `window` rows of a series are read
    into tasks."""
    if spec.targets != spec.values:
        raise ValueError("a forecast that feeds itself must predict every input")
    steps = cfg.steps if steps is None else steps
    parameters = _model_parameters(models, spec, cfg)
    scalers = None if refit_scaler else _stored_scalers(models, spec, ranges)
    lanes, _, _ = prepare(df, spec, cfg, on_error, scalers)
    first = (F.col("n_train") + F.col("n_test")) * cfg.batch
    net = cell.net_for(cfg, len(spec.values), len(spec.targets))
    plain, named = _joins(lanes, parameters, spec, net.size)

    def ends(attach):
        def work(rows: DataFrame) -> DataFrame:
            last = rows.where(row_in_plan() >= first).groupBy(*spec.keys)  # `window` rows a series
            found = last.agg(
                (F.max("pos") + 1).alias("n"), F.first("scaler").alias("scaler"),
                F.sort_array(F.collect_list(F.struct("pos", "xs"))).alias("rows"),
            )
            return attach(found.select(*spec.keys, "n", "scaler", F.flatten("rows.xs").alias("xs")))
        return work

    names = ", ".join(["step int", "pos bigint", *[f"`{t}` double" for t in spec.targets]])
    schema = _schema(df, spec, names)
    work = functools.partial(_recur_series, cfg, net, spec.keys, to_arrow_schema(schema), steps)
    return lanes.map(ends(plain), ends(named)).map(lambda rows: rows.mapInArrow(work, schema)).union()


def aligned_fit(
    df: DataFrame, models: DataFrame, spec: SeriesSpec, cfg: ForecastConfig, **options
) -> DataFrame:
    """(keys, i, pos, targets): the prediction that training optimizes, at the
    last step of every test example and thus for row i + window."""
    scored = score_windows(df, models, spec, cfg, last_only=True, **options)
    row = F.get("yhat", F.lit(0))
    return scored.select(
        *spec.keys, "i", (F.col("i") + cfg.window).alias("pos"),
        *[F.get(row, F.lit(at)).alias(t) for at, t in enumerate(spec.targets)],
    )
