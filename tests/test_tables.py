import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempolane import ForecastConfig, SeriesSpec
from tempolane.operators import heads, overlay, plan, position, scaling, select, trend, windows
from tempolane.sources import series
from tests.series_data import SPEC, frame, plan as plan_of, scaled, spark_frame

LENGTHS = {"x": 90, "y": 97, "z": 400}
CFG = ForecastConfig(window=8, batch=8, steps=5)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_long_and_short_positions_agree(spark):
    df = spark_frame(spark, LENGTHS)
    short = position.with_position(df, SPEC)
    long = position.with_position(df, SPEC, long_rows=20)
    assert rows_of(short, "name", "pos") == rows_of(long, "name", "pos")
    want = frame(LENGTHS).sort_values(["name", "at"])
    got = short.orderBy("name", "pos").toPandas()
    assert (got["a"].to_numpy() == want["a"].to_numpy()).all()


@pytest.mark.parametrize(
    "order",
    [
        "cast(at AS int)",
        "cast(at AS decimal(20,3))",
        "date_add(date '2020-01-01', cast(at AS int))",
        "timestamp_seconds(at * 100000)",
        "cast(timestamp_seconds(at * 100000) AS timestamp_ntz)",
        "format_string('%06d', at)",
    ],
)
def test_every_kind_of_order_column(spark, order):
    df = spark_frame(spark, {"x": 300}).withColumn("at", F.expr(order))
    got = position.with_position(df, SPEC, long_rows=20).orderBy("pos").toPandas()
    want = frame({"x": 300}).sort_values("at")
    assert (got["a"].to_numpy() == want["a"].to_numpy()).all()
    assert got["pos"].tolist() == list(range(300))


def test_rows_of_one_moment_do_not_upset_the_ranges(spark):
    # Nine tenths of the rows share their first order value.
    df = spark_frame(spark, {"x": 500}).withColumn("hot", F.when(F.col("at") < 1_360, 0).otherwise(F.col("at")))
    spec = SeriesSpec(keys="name", order=("hot", "at"), values=("a", "b"))
    got = position.with_position(df, spec, long_rows=50).orderBy("pos").toPandas()
    assert (got["a"].to_numpy() == frame({"x": 500}).sort_values("at")["a"].to_numpy()).all()


def test_no_long_group_reaches_one_task(spark):
    df = spark_frame(spark, {"hot": 2_000, **{f"s{k}": 10 for k in range(20)}})
    lanes = position.position_lanes(df, SPEC, 100)
    text = lanes.long._jdf.queryExecution().toString()
    assert "_tl_range" in text and "BroadcastHashJoin" in text
    assert lanes.names.count() == 1
    sizes = largest_ranges(df.where("name = 'hot'"), SPEC, 20)
    assert len(sizes) >= 18 and max(sizes) < 200


def largest_ranges(df, spec, ranges):
    laid = position._ranged(df.select(*dict.fromkeys((*spec.keys, *spec.order, *spec.values))), spec, ranges)
    return sorted(r[0] for r in laid.groupBy("_tl_range").agg(F.count(F.lit(1))).select("count(1)").collect())


@pytest.mark.parametrize("kind", ["iso text", "hot first column", "many series"])
def test_ranges_are_even_and_positions_exact(spark, kind):
    """Each in ranges of about the same size, whatever the order column holds."""
    if kind == "many series":  # each barely long, so that most lie within a range
        df, spec = spark.range(60_000).selectExpr("id % 6000 AS name", "xxhash64(id) AS at", "id * 1.0D AS a"), SeriesSpec("at", "a", "name")
    else:
        df = spark.range(20_000).selectExpr("'x' AS name", "xxhash64(id) AS h", "id * 1.0D AS a")
        tail = F.lpad(F.pmod("h", F.lit(10**9)).cast("string"), 9, "0")
        df = df.withColumn("text", F.concat(F.lit("2024-01-01T00:00:00."), tail, F.col("a").cast("string")))
        hot = F.when(F.pmod("h", F.lit(10)) > 0, 7).otherwise(F.pmod("h", F.lit(1000)))
        df = df.withColumn("hot", hot)
        spec = SeriesSpec("text" if kind == "iso text" else ("hot", "h", "a"), "a", "name")
    sizes = largest_ranges(df, spec, 16)
    assert len(sizes) == 16 and sizes[-1] < 2 * sum(sizes) / 16
    short, long = (position.with_position(df, spec, long_rows=n) for n in (10**9, 9))
    assert long.exceptAll(short).count() == 0 == short.exceptAll(long).count()


def test_tables_of_long_series_are_sent_by_their_size(spark, monkeypatch):
    df = spark_frame(spark, {f"s{k:02d}": 40 + k for k in range(12)} | {"hot": 600, "tiny": 5})
    want = rows_of(position.with_position(df, SPEC), "name", "pos")
    assert rows_of(position.with_position(df, SPEC, 20), "name", "pos") == want
    monkeypatch.setattr(position, "SENT_BYTES", 0)
    lanes = position.position_lanes(df, SPEC, 20)
    assert "ResolvedHint" not in lanes.long._jdf.queryExecution().logical().toString()
    assert lanes.names.count() == 13 and rows_of(lanes.union(), "name", "pos") == want


def test_null_keys_and_values_are_refused(spark):
    df = spark_frame(spark, {"x": 60})
    with pytest.raises(ValueError, match="null in the key"):
        position.with_position(df.withColumn("name", F.lit(None).cast("string")), SPEC)
    hole = df.withColumn("a", F.when(F.col("at") > 10, F.col("a")))
    assert [r.error for r in plan.validate(hole, SPEC, CFG).collect()] == ["missing values"]
    with pytest.raises(Exception, match="missing value in column a"):
        position.with_position(hole, SPEC).collect()


def test_ties_are_found(spark):
    df = spark_frame(spark, {"x": 10}).withColumn("at", F.col("at") - F.col("at") % 2)
    assert position.order_ties(df, SPEC).count() == 0
    assert position.order_ties(df.withColumn("at", F.lit(1)), SPEC).first()["n_rows"] == 10


def test_plan_laws(spark):
    lengths = {f"s{n}": n for n in range(1, 120, 7)}
    df = spark_frame(spark, lengths)
    for cfg in (CFG, ForecastConfig(window=30, batch=4, test_ratio=0.35)):
        for r in plan.split_plan(df, SPEC, cfg).collect():
            assert r.total_size == max(r.n - cfg.window, 0)
            assert 0 <= r.lost < cfg.batch
            assert r.lost + r.train_size + r.test_size == r.total_size
            if r.n > cfg.window:
                assert (r.lost, r.n_train, r.n_test) == plan_of(r.n, cfg)


def test_errors_come_in_order(spark):
    df = spark_frame(spark, {"x": 100})
    few = ForecastConfig(window=8, batch=40, steps=9)
    assert "too few" in plan.validate(df, SPEC, few).first()["error"]
    far = ForecastConfig(window=8, batch=4, steps=8)
    assert "steps" in plan.validate(df, SPEC, far).first()["error"]
    big = ForecastConfig(window=8, batch=47, steps=3, test_ratio=1.0)
    assert "too few" in plan.validate(df, SPEC, big).first()["error"]
    with pytest.raises(plan.SeriesError):
        plan.require_valid(df, SPEC, few)
    assert plan.validate(df, SPEC, CFG).count() == 0


@pytest.mark.parametrize("block", [8, 13, 64])
def test_long_windows_equal_short_ones(spark, block):
    df = spark_frame(spark, LENGTHS)
    short = windows.split_windows(df, SPEC, CFG)
    long = windows.split_windows(
        df, SPEC, ForecastConfig(window=8, batch=8, steps=5, long_rows=60), block=block
    )
    assert short.count() == long.count()
    assert short.exceptAll(long).isEmpty() and long.exceptAll(short).isEmpty()


def test_windows_hold_the_right_rows(spark):
    df = spark_frame(spark, {"x": 100})
    v = frame({"x": 100}).sort_values("at")[["a", "b"]].to_numpy()
    spec = SeriesSpec(keys="name", order="at", values=("a", "b"), targets="b")
    found = windows.split_windows(df, spec, CFG).orderBy("i").collect()
    lost, n_train, n_test = plan_of(100, CFG)
    assert [r.i for r in found] == list(range(lost, 92))
    for r in found:
        np.testing.assert_array_equal([tuple(x) for x in r.x], v[r.i : r.i + 8])
        assert r.y.b == v[r.i + 8, 1] and len(r.y) == 1
        at = r.i - lost
        assert (r.batch, r.slot, r.split) == (at // 8, at % 8, "train" if at < n_train * 8 else "test")
    head = heads.pick_batch_head(windows.split_windows(df, spec, CFG))
    assert [r.i for r in head.orderBy("i").collect()] == [lost + (n_train + k) * 8 for k in range(n_test)]


def test_scaling_matches_examples(spark):
    df = spark_frame(spark, LENGTHS)
    for cfg in (CFG, ForecastConfig(window=8, batch=8, steps=5, long_rows=95)):
        got = {(r.name, r.role, r.variable): (r.min, r.max) for r in scaling.fit_minmax(df, SPEC, cfg).collect()}
        assert len(got) == 12
        for name in LENGTHS:
            v = frame(LENGTHS).query("name == @name").sort_values("at")[["a", "b"]].to_numpy()
            for role, (_, low, high) in zip(("feature", "label"), scaled(v, cfg)):
                for k, variable in enumerate("ab"):
                    assert got[name, role, variable] == (low[k], high[k])


def test_constant_column_scales_to_zero(spark):
    df = spark_frame(spark, {"x": 100}).withColumn("a", F.lit(4.0))
    found = scaling.unscale_rows(scaling.scale_rows(df, SPEC, CFG)).where("variable = 'a'")
    assert found.agg(F.min("scaled"), F.max("scaled"), F.min("restored")).first() == (0.0, 0.0, 4.0)


@pytest.mark.parametrize("period", [1, 7])
def test_trend_and_season_are_taken_out_and_put_back(spark, period):
    lengths = {"x": 90, "y": 141, "flat": 95}
    df = spark_frame(spark, lengths).withColumn("b", F.when(F.col("name") == "flat", 2.0).otherwise(F.col("b")))
    found = {n: trend.remove_trend(df, SPEC, dataclasses.replace(CFG, long_rows=n), period) for n in (10_000, 30)}
    rows = {n: f.rows.orderBy("name", "row").toPandas() for n, f in found.items()}
    np.testing.assert_allclose(rows[30][["a", "b"]], rows[10_000][["a", "b"]], atol=1e-9)
    for n, f in found.items():
        back = trend.restore_trend(f.rows.withColumnRenamed("row", "pos"), f).orderBy("name", "pos").toPandas()
        want = df.orderBy("name", "at").toPandas()
        np.testing.assert_allclose(back[["a", "b"]], want[["a", "b"]], atol=1e-9)
    for name, n in lengths.items():
        lost, n_train, _ = plan_of(n, CFG)
        used = np.arange(lost, lost + n_train * CFG.batch + CFG.window)
        values = df.where(F.col("name") == name).orderBy("at").toPandas()[["a", "b"]].to_numpy()
        own = rows[10_000].query("name == @name").sort_values("row")[["a", "b"]].to_numpy()
        for v in range(2):
            line = np.polyfit(used, values[used, v], 1)
            left = values[:, v] - np.polyval(line, np.arange(n))
            if period > 1:
                left -= np.array([left[used[used % period == k]].mean() for k in range(period)])[np.arange(n) % period]
            np.testing.assert_allclose(own[:, v], left, atol=1e-7)
    with pytest.raises(ValueError, match="period"):
        trend.fit_trend(df, SPEC, CFG, 0)


def test_row_count_law(spark):
    # Counts known for 1461 rows under the default settings and 25 steps.
    df = spark_frame(spark, {"x": 1461})
    cfg = ForecastConfig(steps=25)
    found = heads.persistence_heads(df, SPEC, cfg)
    assert heads.slice_steps(found, SPEC, cfg, "check").count() == 183
    assert heads.slice_steps(found, SPEC, cfg, "forecast").count() == 25


def test_overlay_in_both_alignments(spark):
    df = spark_frame(spark, {"x": 90, "y": 95})
    found = heads.persistence_heads(df, SPEC, CFG)
    check = heads.slice_steps(found, SPEC, CFG, "check")
    forecast = heads.slice_steps(found, SPEC, CFG, "forecast")
    true = overlay.overlay(df, check, forecast, SPEC, CFG).toPandas()
    assert true["actual"].notna().all() and len(true) == 2 * 185
    tail = overlay.overlay(df, check, forecast, SPEC, CFG, align="tail").toPandas()
    for name, n in (("x", 90), ("y", 95)):
        mine = tail[(tail["name"] == name) & (tail["target"] == "a")].sort_values("pos")
        assert mine["pos"].tolist() == list(range(n + CFG.steps))
        drawn = mine[mine["check"].notna()]["pos"].tolist()
        assert drawn == list(range(n - len(drawn), n))
        assert mine[mine["forecast"].notna()]["pos"].tolist() == list(range(n, n + CFG.steps))


def test_mean_squared_error(spark):
    df = spark.createDataFrame([("p", 1.0, 3.0), ("p", 2.0, 2.0), ("q", 0.0, 0.5)], "k string, y double, z double")
    got = dict(overlay.mean_squared_error(df, F.col("y"), F.col("z"), ["k"]).collect())
    assert got == {"p": 2.0, "q": 0.25}


def test_target_names():
    columns = ["Close", "High", "Low"]
    assert select.resolve_targets(columns, None) == tuple(columns)
    assert select.resolve_targets(columns, "") == tuple(columns)
    assert select.resolve_targets(columns, "Low,Close") == ("Low", "Close")
    assert select.resolve_targets(columns, "low,Close", ignore_unknown=True) == ("Close",)
    for wrong in ("low", "Low, Close"):
        with pytest.raises(ValueError):
            select.resolve_targets(columns, wrong)
    with pytest.raises(ValueError):
        select.resolve_targets(columns, "low", ignore_unknown=True)


def test_configuration():
    cfg = ForecastConfig.from_options(
        {"nEpochs": "7", "testRatio": "0.1", "updater": "ADAM", "activation": "softsign", "truncatedBPTT": "TRUE", "l1": ""},
        steps=4,
    )
    assert (cfg.epochs, cfg.test_ratio, cfg.updater, cfg.activation) == (7, 0.1, "NESTEROVS", "TANH")
    assert cfg.truncated_bptt is True and cfg.l1 == 0.0 and cfg.steps == 4
    assert ForecastConfig.from_json(cfg.to_json()) == cfg
    for wrong in ({"window": 0}, {"test_ratio": 1.5}, {"epochs": -1}):
        with pytest.raises(ValueError):
            ForecastConfig(**wrong)
    with pytest.raises(ValueError):
        ForecastConfig.from_options({"miniBatch": "4"})
    with pytest.raises(ValueError, match="reserved"):
        SeriesSpec(order="at", values="n")
    with pytest.raises(ValueError, match="targets"):
        SeriesSpec(order="at", values="a", targets="b")


def test_many_small_csv_parts_keep_their_order(spark, tmp_path):
    import random

    draw = random.Random(3)
    folder = tmp_path / "many"
    folder.mkdir()
    value = 0
    for part in range(60):
        n = draw.randint(1, 90)
        rows = "\n".join(str(value + i) for i in range(n))
        (folder / f"part-{part:03d}.csv").write_text(f"a\n{rows}\n")
        value += n
    found = series.read_series(spark, str(folder))
    spec = series.series_spec(found)
    assert position.order_ties(found, spec).count() == 0
    placed = position.with_position(found, spec).select("pos", "a").collect()
    assert len(placed) == value and all(r["pos"] == r["a"] for r in placed)


def test_series_that_fail_the_plan_are_not_dropped_in_silence(spark):
    df = spark.createDataFrame([("k", t, float(t)) for t in range(12)], "key string, t long, a double")
    spec = SeriesSpec(keys="key", order="t", values="a")
    cfg = ForecastConfig(window=8, batch=8, test_ratio=0.2, steps=5)
    with pytest.raises(Exception, match="too few test batches"):
        scaling.fit_minmax(df, spec, cfg).collect()
    assert scaling.fit_minmax(df, spec, cfg, on_error="skip").count() == 0
