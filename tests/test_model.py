import dataclasses
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempolane import ForecastConfig, SeriesSpec
from tempolane.functions import cell
from tempolane.operators import position
from tempolane.operators.plan import SeriesError
from tempolane.plans import score, train
from tempolane.plans.job import forecast_job
from tempolane.sources import series, store
from tests.series_data import SPEC, frame, plan, scaled, spark_frame

LENGTHS = {"x": 90, "y": 141, "z": 260, "w": 133}
CFG = ForecastConfig(window=8, batch=8, steps=5, epochs=3, learning_rate=0.05, hidden=4)


def values_of(name, lengths=LENGTHS):
    return frame(lengths).query("name == @name").sort_values("at")[["a", "b"]].to_numpy()


def alone(values, cfg):
    """Train one series by itself, example by example from the definition."""
    (x, _, _), (y, _, _) = scaled(values, cfg)
    lost, n_train, _ = plan(len(values), cfg)
    net = cell.net_for(cfg, 2, 2)
    theta = net.initial(cfg.seed)[None].copy()
    memory, losses = np.zeros_like(theta), []
    for epoch in range(cfg.epochs):
        total = 0.0
        for k in range(n_train):
            starts = [lost + k * cfg.batch + b for b in range(cfg.batch)]
            xs = np.stack([x[i : i + cfg.window] for i in starts], 1)[:, None]
            ys = np.stack([y[i + cfg.window] for i in starts])[None]
            total += cell.fit_batch(cfg, net, theta, memory, xs, ys, (epoch << 32) + k)[0]
        losses.append(total / n_train)
    return theta[0], memory[0], losses


@pytest.fixture(scope="module")
def df(spark):
    return spark_frame(spark, LENGTHS).cache()


@pytest.fixture(scope="module")
def models(spark, df):
    return train.train_per_series(df, SPEC, CFG).cache()


@pytest.mark.parametrize(
    "change", [{}, {"updater": "RMSPROP"}, {"activation": "SOFTSIGN", "dropout": 0.8},
               {"updater": "ADAGRAD", "regularization": True, "l1": 1e-3, "l2": 1e-3},
               {"truncated_bptt": True, "bptt_length": 3}]
)
def test_each_series_trains_as_if_alone(spark, df, change):
    cfg = dataclasses.replace(CFG, **change)
    got = train.train_per_series(df, SPEC, cfg).collect()
    assert len(got) == len(LENGTHS)
    for r in got:
        theta, memory, losses = alone(values_of(r.name), cfg)
        np.testing.assert_allclose(r.params, theta, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(r.updater, memory, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose([h.loss for h in r.history], losses, rtol=1e-9)
        (_, low, high), (_, l_low, l_high) = scaled(values_of(r.name), cfg)
        assert (r.scaler.f_min, r.scaler.l_max) == (low.tolist(), l_high.tolist())
        assert (r.inputs, r.targets) == (["a", "b"], ["a", "b"])


def test_training_does_not_depend_on_the_layout(spark, df, models, monkeypatch):
    monkeypatch.setattr(position, "TASK_ROWS", 48)
    assert position.measure(df, SPEC).tasks(spark) == 13
    other = {r.name: r.params for r in train.train_per_series(df.repartition(3), SPEC, CFG).collect()}
    assert other == {r.name: r.params for r in models.collect()}


def test_loss_falls(models):
    for r in models.collect():
        assert r.history[-1].loss < r.history[0].loss


def test_fewer_targets(spark, df):
    spec = SeriesSpec(keys="name", order="at", values=("a", "b"), targets="b")
    found = train.train_per_series(df, spec, CFG).checkpoint()
    net = cell.net_for(CFG, 2, 1)
    assert {len(r.params) for r in found.collect()} == {net.size}
    ahead = score.forecast(df, found, spec, CFG)
    assert ahead.columns == ["name", "i", "step", "pos", "b"] and ahead.count() == 4 * CFG.steps


def test_failing_series_raise_or_are_left_out(spark):
    df = spark_frame(spark, {"x": 90, "tiny": 20, "none": 3})
    with pytest.raises(SeriesError, match="too few"):
        train.train_per_series(df, SPEC, CFG)
    assert [r.name for r in train.train_per_series(df, SPEC, CFG, on_error="skip").collect()] == ["x"]


# --- averaging --------------------------------------------------------------------


def test_one_shard_averages_to_plain_training(spark):
    data = spark_frame(spark, {"x": 90})
    cfg = dataclasses.replace(CFG, averaging_frequency=2, shards=1)
    for rounds in (None, 1, 3):
        model = train.train_pooled(data, SPEC, cfg, rounds).models.first()
        theta, memory, losses = alone(values_of("x", {"x": 90}), cfg)
        np.testing.assert_allclose(model.params, theta, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(model.updater, memory, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose([h.loss for h in model.history], losses, rtol=1e-9)


def pooled_alone(spark, cfg, each, rounds=None):
    """Averaging in a plain loop, from the definition: shards of pieces of `each` mini-batches."""
    net = cell.net_for(cfg, 2, 2)
    shards = {}
    for name, n in LENGTHS.items():
        (x, _, _), (y, _, _) = scaled(values_of(name), cfg)
        lost, n_train, _ = plan(n, cfg)
        for piece in range(-(-n_train // each)):
            shards.setdefault(None, []).append((name, piece, x, y, lost, n_train))
    places = spark.createDataFrame([p[:2] for p in shards[None]], "name string, piece bigint")
    told = places.select("name", "piece", F.pmod(F.xxhash64("name", "piece"), F.lit(cfg.shards)).alias("s"), F.xxhash64(F.lit("turn"), "name", "piece").alias("t"))
    where = {(r.name, r.piece): (r.s, r.t) for r in told.collect()}
    lists = {}
    for name, piece, x, y, lost, n_train in sorted(shards[None], key=lambda p: where[p[:2]]):
        for k in range(piece * each, min(n_train, piece * each + each)):
            starts = [lost + k * cfg.batch + b for b in range(cfg.batch)]
            xs = np.stack([x[i : i + cfg.window] for i in starts], 1)[:, None]
            lists.setdefault(where[name, piece][0], []).append((xs, np.stack([y[i + cfg.window] for i in starts])[None]))
    theta, memory = net.initial(cfg.seed), np.zeros(net.size)
    most = rounds or max(-(-len(v) // cfg.averaging_frequency) for v in lists.values())
    for epoch in range(cfg.epochs):
        for r in range(most):
            ends = []
            for s, batches in sorted(lists.items()):
                f, n = cfg.averaging_frequency, len(batches)
                part = batches[n * r // most : n * (r + 1) // most] if rounds else batches[r * f : r * f + f]
                own, mem = theta[None].copy(), memory[None].copy()
                for xs, ys in part:
                    cell.fit_batch(cfg, net, own, mem, xs, ys, 0)
                ends.append((len(part), own[0], mem[0]))
            total = sum(e[0] for e in ends)
            theta, memory = (sum(e[0] * e[i] for e in ends) / total for i in (1, 2))
    return theta, memory


@pytest.mark.parametrize("change,rounds", [({}, None), ({"updater": "RMSPROP", "averaging_frequency": 2}, None), ({"shards": 7, "updater": "ADAGRAD"}, 2)])
def test_averages_equal_a_plain_loop(spark, df, monkeypatch, change, rounds):
    monkeypatch.setattr(train, "PIECE_EXAMPLES", 24)
    cfg = dataclasses.replace(CFG, **{"shards": 3, **change})
    got = train.train_pooled(df, SPEC, cfg, rounds)
    model = got.models.first()
    theta, memory = pooled_alone(spark, cfg, 3, rounds)
    np.testing.assert_allclose(model.params, theta, rtol=1e-9, atol=1e-11)
    np.testing.assert_allclose(model.updater, memory, rtol=1e-9, atol=1e-11)
    # The log of the shards is that of the model.
    sums = got.stats.groupBy("epoch").agg((F.sum(F.col("loss") * F.col("n_windows")) / F.sum("n_windows")).alias("loss")).orderBy("epoch").collect()
    np.testing.assert_allclose([r.loss for r in sums], [h.loss for h in model.history], rtol=1e-9)


def test_pooled_numbers_do_not_depend_on_tasks_and_lanes(spark, df, monkeypatch):
    monkeypatch.setattr(train, "PIECE_EXAMPLES", 24)
    cfg = dataclasses.replace(CFG, shards=13, dropout=0.7, epochs=2)
    found = [train.train_pooled(df, SPEC, cfg, tasks=t).models.first() for t in (1, 2, 4, 8)]
    found += [train.train_pooled(df.repartition(3), SPEC, dataclasses.replace(cfg, long_rows=n)).models.first() for n in (50, 135)]
    assert all((r.params, r.updater) == (found[0].params, found[0].updater) for r in found)
    assert all([h.loss for h in r.history] == [h.loss for h in found[0].history] for r in found)


def test_exact_sums():
    values = np.array([1.0, -3.5, 2.0**-8 / 3, 0.1, 1e12])
    parts = [train._exact(values * w, 1) for w in (1, 2, 4)]
    assert train._mean(train._summed(parts), 7, 5).tolist() == values.tolist()
    assert train._mean(train._summed([parts[0], train._exact(np.array([np.nan, 0, 0, 0, 0]), 1)]), 2, 5).shape == (5,)
    assert np.isnan(train._mean(None, 2, 5)).all() and train._summed([]) == []


def jobs_of(spark, work):
    sc, name = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(name, "counted")
    try:
        work()
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_of_training_do_not_grow_with_rows_and_epochs(spark, df, monkeypatch):
    monkeypatch.setattr(train, "PIECE_EXAMPLES", 24)
    more = spark_frame(spark, {k: 3 * n for k, n in LENGTHS.items()}).cache()
    more.count(), df.count()
    pooled = lambda d, epochs: jobs_of(spark, lambda: train.train_pooled(d, SPEC, dataclasses.replace(CFG, epochs=epochs, shards=3)))
    assert pooled(df, 1) == pooled(df, 4) == pooled(more, 2)
    long = lambda d, epochs: jobs_of(spark, lambda: train.train_per_series(d, SPEC, dataclasses.replace(CFG, epochs=epochs, long_rows=50)).collect())
    assert long(df, 1) == long(df, 4) == long(more, 2)


def test_pooled_training_reads_every_example_once_per_epoch(spark, df):
    got = train.train_pooled(df, SPEC, dataclasses.replace(CFG, averaging_frequency=2))
    want = sum(plan(n, CFG)[1] * CFG.batch for n in LENGTHS.values())
    per_epoch = got.stats.groupBy("epoch").agg(F.sum("n_windows"), F.sum(F.col("loss") * F.col("n_windows"))).orderBy("epoch").collect()
    assert [r[1] for r in per_epoch] == [want] * CFG.epochs
    assert per_epoch[-1][2] < per_epoch[0][2]
    ahead = score.forecast(df, got.models, SPEC, CFG)
    assert ahead.count() == len(LENGTHS) * CFG.steps


def test_long_series_train_like_short_ones(spark, df, monkeypatch):
    monkeypatch.setattr(train, "PIECE_EXAMPLES", 24)
    for change in ({}, {"dropout": 0.8, "updater": "RMSPROP"}):
        cfg = dataclasses.replace(CFG, **change)
        short = {r.name: r for r in train.train_per_series(df, SPEC, cfg).collect()}
        for long_rows in (50, 135):
            got = {r.name: r for r in train.train_per_series(df, SPEC, dataclasses.replace(cfg, long_rows=long_rows)).collect()}
            assert got.keys() == short.keys()
            for name, r in got.items():
                assert (r.params, r.updater, r.scaler) == (short[name].params, short[name].updater, short[name].scaler)
                assert [h.loss for h in r.history] == pytest.approx([h.loss for h in short[name].history], rel=1e-12)
                assert [h.n_windows for h in r.history] == [h.n_windows for h in short[name].history]


def test_long_series_without_keys_and_without_epochs(spark, monkeypatch):
    monkeypatch.setattr(train, "PIECE_EXAMPLES", 24)
    data = spark_frame(spark, {"x": 150}).drop("name")
    spec = SeriesSpec(order="at", values=("a", "b"))
    for epochs in (0, 2):
        one, two = (train.train_per_series(data, spec, dataclasses.replace(CFG, epochs=epochs, long_rows=n)).first() for n in (10_000, 40))
        assert (one.params, one.updater) == (two.params, two.updater) and len(two.history) == epochs


def test_interrupted_training_goes_on(spark, df, monkeypatch, tmp_path):
    monkeypatch.setattr(train, "PIECE_EXAMPLES", 24)
    monkeypatch.setattr(train, "STORE_BATCHES", 5)
    net = cell.net_for(CFG, 2, 2)
    lanes, tasks, _ = train.prepare(df, SPEC, CFG)
    cut = train._training_pieces(lanes.union(), SPEC, CFG, tasks).withColumn("bin", F.lit(0))
    paths = [str(tmp_path / n) for n in ("whole", "broken")]
    for path in paths:
        train._stored(cut.select("bin", "name", "piece", "scaler", "xs", "ys"), "bin", ["name", "piece"], 1, f"{path}/pieces")
    whole = train._fit_folder(CFG, net, ("name",), paths[0], 3, 0, 0)
    steps, real = [], cell.fit_batch

    def failing(*args):
        steps.append(args[-1])
        if len(steps) % 17 == 0:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(cell, "fit_batch", failing)
    attempts, broken = 0, None
    while broken is None:
        attempts += 1
        try:
            broken = train._fit_folder(CFG, net, ("name",), paths[1], 3, 0, 0)
        except OSError:
            pass
    batches = CFG.epochs * sum(plan(n, CFG)[1] for n in LENGTHS.values())
    # Each attempt repeats what came after the last stored state, and no more.
    assert attempts > 5 and batches < len(steps) < batches + attempts * 12
    for (_, a), (_, b) in zip(whole, broken):
        assert a["theta"].tolist() == b["theta"].tolist() and a["memory"].tolist() == b["memory"].tolist()
        assert [h["loss"] for h in a["history"]] == [h["loss"] for h in b["history"]]


# --- scoring ----------------------------------------------------------------------


def full_batch_heads(values, params, cfg, warm):
    """Outputs of slot 0 with whole mini-batches pushed through the network."""
    (x, _, _), (_, low, high) = scaled(values, cfg)
    lost, n_train, n_test = plan(len(values), cfg)
    net = cell.net_for(cfg, 2, 2)
    theta = np.array([params])
    state, out = None, []
    for k in range(0 if warm else n_train, n_train + n_test):
        starts = [lost + k * cfg.batch + b for b in range(cfg.batch)]
        xs = np.stack([x[i : i + cfg.window] for i in starts], 1)[:, None]
        hs, state = cell.forward(net, theta, xs, state)
        if k >= n_train:
            y = cell.outputs(net, theta, hs)[: cfg.steps + 1, 0, 0]
            out.append(y * (high - low) + low)
    return out


@pytest.mark.parametrize("warm", [True, False])
@pytest.mark.parametrize("batch,window", [(8, 8), (4, 10), (12, 7)])
def test_heads_equal_slot_zero_of_whole_batches(spark, df, warm, batch, window):
    cfg = dataclasses.replace(CFG, batch=batch, window=window, epochs=1)
    trained = train.train_per_series(df, SPEC, cfg, on_error="skip").checkpoint()
    params = {r.name: r.params for r in trained.collect()}
    lanes = [cfg, dataclasses.replace(cfg, long_rows=135)]
    for c in lanes:
        got = score.score_heads(df, trained, SPEC, c, warm, on_error="skip", piece_batches=3).collect()
        for name in params:
            want = full_batch_heads(values_of(name), params[name], cfg, warm)
            mine = sorted((r for r in got if r.name == name), key=lambda r: r.batch)
            lost, n_train, n_test = plan(LENGTHS[name], cfg)
            assert [r.batch for r in mine] == list(range(n_test))
            assert [r.i for r in mine] == [lost + (n_train + k) * batch for k in range(n_test)]
            assert [r.is_last for r in mine] == [False] * (n_test - 1) + [True]
            for r, y in zip(mine, want):
                np.testing.assert_allclose(r.yhat, y, rtol=1e-9, atol=1e-9)


def test_long_series_without_broadcasts(spark, df, models, monkeypatch):
    cfg = dataclasses.replace(CFG, long_rows=100)
    want = {(r.name, r.batch): r.yhat for r in score.score_heads(df, models, SPEC, CFG).collect()}
    plain = {(r.name, r.i): r.yhat for r in score.score_windows(df, models, SPEC, CFG).collect()}
    monkeypatch.setattr(position, "SENT_BYTES", 0)
    got = {(r.name, r.batch): r.yhat for r in score.score_heads(df, models, SPEC, cfg, piece_batches=4).collect()}
    assert got.keys() == want.keys()
    for key in want:
        np.testing.assert_allclose(got[key], want[key], rtol=1e-9, atol=1e-9)
    stateless = {(r.name, r.i): r.yhat for r in score.score_windows(df, models, SPEC, cfg, piece_examples=11).collect()}
    assert stateless == plain
    trained = {r.name: r.params for r in train.train_per_series(df, SPEC, cfg).collect()}
    for r in models.collect():
        assert trained[r.name] == r.params


@pytest.mark.parametrize("warm", [True, False])
def test_states_that_are_not_forgotten_are_relayed(spark, df, models, warm):
    """Forget gates near 1: a guess never wears off."""
    net = cell.net_for(CFG, 2, 2)

    def open_gates(params):
        theta = np.array([params])
        net.parts(theta)["b"][:, :, net.hidden : 2 * net.hidden] = 9.0
        return theta[0].tolist()

    rows = [(r.name, open_gates(r.params), r.inputs, r.targets) for r in models.collect()]
    lasting = spark.createDataFrame(rows, "name string, params array<double>, inputs array<string>, targets array<string>")
    cfg = dataclasses.replace(CFG, long_rows=50)
    score_long = lambda d, m, spec: score.score_heads(d, m, spec, cfg, warm, piece_batches=1)
    want = {(r.name, r.batch): r.yhat for r in score.score_heads(df, lasting, SPEC, CFG, warm).collect()}
    found = []
    jobs = jobs_of(spark, lambda: found.extend(score_long(df, lasting, SPEC).collect()))
    for r in found:
        np.testing.assert_allclose(r.yhat, want[r.name, r.batch], rtol=1e-9, atol=1e-9)
    assert len(found) == len(want)
    more = spark_frame(spark, {k: 3 * n for k, n in LENGTHS.items()}).cache()
    assert jobs_of(spark, lambda: score_long(more, lasting, SPEC).collect()) <= jobs + 1
    # A single series without keys.
    one, spec = df.where("name = 'z'").drop("name"), SeriesSpec(order="at", values=("a", "b"))
    alone_ = score_long(one, lasting.where("name = 'z'").drop("name"), spec).collect()
    for r in alone_:
        np.testing.assert_allclose(r.yhat, want["z", r.batch], rtol=1e-9, atol=1e-9)


def test_unkeyed_series_long_and_short(spark):
    data = spark_frame(spark, {"x": 260}).drop("name")
    spec = SeriesSpec(order="at", values=("a", "b"))
    trained = train.train_per_series(data, spec, CFG).checkpoint()
    short = score.check_fit(data, trained, spec, CFG).orderBy("batch", "step").collect()
    long_cfg = dataclasses.replace(CFG, long_rows=50)
    long = score.check_fit(data, trained, spec, long_cfg, piece_batches=2).orderBy("batch", "step").collect()
    assert len(short) == len(long) == (plan(260, CFG)[2] - 1) * 6 + 1
    for a, b in zip(short, long):
        assert a[:4] == b[:4]
        np.testing.assert_allclose(a[4:], b[4:], rtol=1e-9, atol=1e-9)
    again = train.train_per_series(data, spec, dataclasses.replace(long_cfg, epochs=1)).collect()
    assert len(again) == 1 and len(again[0].params) == cell.net_for(CFG, 2, 2).size


@pytest.mark.parametrize("split", ["train", "test", "all"])
def test_stateless_scores(spark, df, models, split):
    params = {r.name: r.params for r in models.collect()}
    net = cell.net_for(CFG, 2, 2)
    got = score.score_windows(df, models, SPEC, CFG, split, piece_examples=20).collect()
    for name, n in LENGTHS.items():
        (x, _, _), (_, low, high) = scaled(values_of(name), CFG)
        lost, n_train, n_test = plan(n, CFG)
        first, last = {"train": (0, n_train), "test": (n_train, n_train + n_test), "all": (0, n_train + n_test)}[split]
        mine = {r.i: r.yhat for r in got if r.name == name}
        assert sorted(mine) == list(range(lost + first * 8, lost + last * 8))
        for i in list(mine)[::7]:
            hs, _ = cell.forward(net, np.array([params[name]]), x[i : i + 8, None, None])
            y = cell.outputs(net, np.array([params[name]]), hs)[:, 0, 0] * (high - low) + low
            np.testing.assert_allclose(mine[i], y, rtol=1e-9)
    if split == "test":
        ends = {(r.name, r.i): (r.pos, r.a, r.b) for r in score.aligned_fit(df, models, SPEC, CFG).collect()}
        assert ends == {(r.name, r.i): (r.i + 8, *r.yhat[-1]) for r in got}


def test_models_that_do_not_fit_are_refused(spark, df, models):
    with pytest.raises(Exception, match="does not fit"):
        score.forecast(df, models, SPEC, dataclasses.replace(CFG, hidden=6)).collect()
    with pytest.raises(Exception, match="does not fit"):
        swapped = SeriesSpec(keys="name", order="at", values=("b", "a"))
        score.forecast(df, models, swapped, CFG).collect()
    with pytest.raises(Exception, match="no model for series"):
        score.forecast(df, models.where("name <> 'y'"), SPEC, CFG).collect()
    with pytest.raises(ValueError, match="several"):
        score.forecast(df, models.drop("name"), SPEC, CFG)


# --- files ------------------------------------------------------------------------


def test_saved_models_score_alike(spark, df, models, tmp_path):
    store.save_model(models, f"{tmp_path}/m")
    saved = store.load_model(spark, f"{tmp_path}/m")
    assert saved.where("updater is not null").count() == 0
    assert store.model_config(saved) == CFG
    for options in ({}, {"refit_scaler": False}):
        want = score.forecast(df, models, SPEC, CFG).orderBy("name", "step").collect()
        assert score.forecast(df, saved, SPEC, CFG, **options).orderBy("name", "step").collect() == want
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.save_model(models, f"{tmp_path}/m")
    store.save_model(models, f"{tmp_path}/u", save_updater=True)
    assert store.load_model(spark, f"{tmp_path}/u").where("updater is not null").count() == len(LENGTHS)
    # On other data, a refit changes the ranges and the stored ones do not.
    twice = df.withColumns({"a": F.col("a") * 2, "b": F.col("b") * 2})
    refit = score.forecast(twice, saved, SPEC, CFG).orderBy("name", "step").collect()
    kept = score.forecast(twice, saved, SPEC, CFG, refit_scaler=False).orderBy("name", "step").collect()
    np.testing.assert_allclose([r.a for r in refit], [2 * r.a for r in want], rtol=1e-9)
    assert max(abs(p.a - q.a) for p, q in zip(refit, kept)) > 1e-3
    long = dataclasses.replace(CFG, long_rows=135)
    far = score.forecast(twice, saved, SPEC, long, refit_scaler=False).orderBy("name", "step").collect()
    np.testing.assert_allclose([r.a for r in far], [r.a for r in kept], rtol=1e-9)


def write_csv(path, values, header="a,b"):
    path.write_text("\n".join([header, *(f"{p},{q}" for p, q in values)]))


def test_csv_keeps_line_order_over_splits_and_files(spark, tmp_path):
    v = values_of("z")
    (tmp_path / "one").mkdir()
    (tmp_path / "parts").mkdir()
    write_csv(tmp_path / "one" / "s.csv", v)
    for k in range(4):
        write_csv(tmp_path / "parts" / f"part-{k}.csv", v[k * 65 : (k + 1) * 65])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for folder in ("one", "parts"):
            found = series.read_series(spark, str(tmp_path / folder))
            assert found.rdd.getNumPartitions() > 4
            spec = series.series_spec(found)
            got = position.with_position(found, spec).orderBy("pos").collect()
            np.testing.assert_array_equal([(r.a, r.b) for r in got], v)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    each = series.read_series(spark, str(tmp_path / "parts"), one_per_file=True)
    got = position.with_position(each, series.series_spec(each))
    assert got.groupBy("_series").count().count() == 4
    assert [r.a for r in got.where("pos = 0").orderBy("_series").collect()] == v[::65, 0].tolist()


def test_lines_that_are_no_numbers_are_set_aside(spark, tmp_path):
    lines = {
        "a.csv": ["v,w", "1,2", "x,3", "4", "5,6,7", " 7 ,8e1", "9,", "NaN,1e999", "10,11"],
        "b.csv": ["v,w", "-.5,+12.", "1.5d,0x1", '"13","14"'],
    }
    for name, rows in lines.items():
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    found = series.read_series_leniently(spark, str(tmp_path))
    placed = position.with_position(found.rows, series.series_spec(found.rows)).orderBy("pos").collect()
    assert [(r.v, r.w) for r in placed] == [(1, 2), (7, 80), (10, 11), (-0.5, 12), (13, 14)]
    rejects = found.rejects.orderBy("_series", "_line", "_row").collect()
    got = sorted((r._series.rsplit("/", 1)[1], r.field, r.text) for r in rejects if r.field)
    assert got == [("a.csv", "v", "NaN"), ("a.csv", "v", "x"), ("a.csv", "w", ""), ("a.csv", "w", "1e999"), ("b.csv", "v", "1.5d"), ("b.csv", "w", "0x1")]
    assert [(r._series.rsplit("/", 1)[1], r.text) for r in rejects if not r.field] == [("a.csv", "4"), ("a.csv", "5,6,7")]
    order = [r.text for r in rejects if r._series.endswith("a.csv")]
    assert [order.index(t) for t in ("x", "4", "5,6,7", "", "NaN")] == sorted(order.index(t) for t in ("x", "4", "5,6,7", "", "NaN"))
    each = series.read_series_leniently(spark, str(tmp_path), one_per_file=True)
    assert {r._series.rsplit("/", 1)[1]: r["count"] for r in each.rows.groupBy("_series").count().collect()} == {"a.csv": 3, "b.csv": 2}


@pytest.mark.parametrize("long_rows", [10_000, 100])
def test_recursive_forecast_equals_a_loop(spark, models, long_rows):
    cfg, steps = dataclasses.replace(CFG, long_rows=long_rows), 2 * CFG.window + 3
    data = spark_frame(spark, LENGTHS).withColumn("b", F.when(F.col("name") == "x", F.lit(3.0)).otherwise(F.col("b")))
    got = {}
    for r in score.recursive_forecast(data, models, SPEC, cfg, steps).collect():
        got.setdefault(r.name, {})[r.step] = (r.pos, r.a, r.b)
    net = cell.net_for(CFG, 2, 2)
    for m in models.collect():
        values = values_of(m.name).copy()
        if m.name == "x":
            values[:, 1] = 3.0
        (x, f_low, f_high), (_, low, high) = scaled(values, CFG)
        rows = list(np.nan_to_num(x[-CFG.window:]))
        for step in range(1, steps + 1):
            hs, _ = cell.forward(net, np.array([m.params]), np.array(rows[-CFG.window:])[:, None, None])
            y = cell.outputs(net, np.array([m.params]), hs[-1:])[0, 0, 0] * (high - low) + low
            assert got[m.name][step][0] == len(values) + step - 1
            np.testing.assert_allclose(got[m.name][step][1:], y, rtol=1e-9, atol=1e-9)
            width = np.where(f_high == f_low, np.inf, f_high - f_low)
            rows.append((y - f_low) / width)
    with pytest.raises(ValueError, match="every input"):
        score.recursive_forecast(data, models, SeriesSpec(keys="name", order="at", values=("a", "b"), targets="a"), cfg)


def test_pooled_models_keep_the_ranges_of_their_series(spark, df, tmp_path):
    cfg = dataclasses.replace(CFG, epochs=1)
    out = str(tmp_path / "out")
    forecast_job(df, SPEC, cfg, out, model_name="m", pooled=True, run_id="1")
    more = df.withColumn("a", F.col("a") * 10)
    with pytest.raises(ValueError, match="ranges"):
        score.score_heads(more, store.load_model(spark, f"{out}/m"), SPEC, cfg, refit_scaler=False)
    done = forecast_job(more, SPEC, None, out, model_path=f"{out}/m", refit_scaler=False, run_id="2")
    each = store.load_ranges(spark, f"{out}/m")
    own = train.train_per_series(df, SPEC, dataclasses.replace(cfg, epochs=0))
    assert {r.name: r.scaler for r in each.collect()} == {r.name: r.scaler for r in own.collect()}
    params = store.load_model(spark, f"{out}/m").first().params
    alike = own.withColumn("params", F.lit(params))
    want = score.check_fit(more, alike, SPEC, cfg, refit_scaler=False).orderBy("name", "batch", "step").collect()
    for a, b in zip(done.check.orderBy("name", "batch", "step").collect(), want):
        np.testing.assert_allclose(a[5:], b[5:], rtol=1e-9)


def test_bad_csv_stops_the_job(spark, tmp_path):
    write_csv(tmp_path / "text.csv", [(1.0, 2.0), ("x", 3.0)])
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        series.read_series(spark, str(tmp_path / "text.csv")).collect()
    (tmp_path / "two").mkdir()
    write_csv(tmp_path / "two" / "1.csv", [(1.0, 2.0)])
    write_csv(tmp_path / "two" / "2.csv", [(1.0, 2.0)], header="b,a")
    with pytest.raises(Exception, match="header|FAILED_READ"):
        series.read_series(spark, str(tmp_path / "two")).collect()


def test_job_from_csv_to_files(spark, tmp_path):
    write_csv(tmp_path / "in.csv", values_of("z"))
    data = series.read_series(spark, str(tmp_path / "in.csv"))
    spec, out = series.series_spec(data, targets="b"), f"{tmp_path}/out"
    done = forecast_job(data, spec, CFG, out, model_name="first", run_id="11", fmt="csv")
    n_test = plan(260, CFG)[2]
    check = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/check")
    assert check.count() == (n_test - 1) * 6 + 1 and set(check.columns) == {"batch", "i", "step", "pos", "b", "run_id"}
    ahead = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/forecast").orderBy("step").collect()
    np.testing.assert_allclose([r.b for r in ahead], [r.b for r in done.forecast.orderBy("step").collect()])
    assert spark.read.parquet(f"{out}/stats").groupBy("run_id").count().first()[1] == CFG.epochs
    again = forecast_job(data, spec, CFG, out, model_path=f"{out}/first", model_name="", run_id="12", fmt="csv")
    assert again.forecast.orderBy("step").collect() == done.forecast.orderBy("step").collect()
    assert spark.read.option("header", True).csv(f"{out}/forecast").count() == 2 * CFG.steps
    assert spark.read.parquet(f"{out}/stats").select("run_id").distinct().count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        forecast_job(data, spec, CFG, out, model_name="first")
    pooled = forecast_job(data, spec, CFG, out, pooled=True, run_id="13")
    assert pooled.forecast.count() == CFG.steps


def test_training_stats(spark, models):
    stats = train.training_stats(models, "r")
    assert stats.columns == ["run_id", "name", "epoch", "round", "partition", "n_windows", "loss", "fit_ms"]
    assert stats.count() == len(LENGTHS) * CFG.epochs
