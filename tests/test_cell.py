import numpy as np
import pytest

from tempolane.config import ForecastConfig
from tempolane.functions import cell


def slow_forward(net, theta, x, h, c):
    """One network, one example, number by number."""
    w = {k: v[0] for k, v in net.parts(theta[None]).items()}
    n = net.hidden
    act = np.tanh if net.activation == "TANH" else (lambda v: v / (1 + abs(v)))
    sig = lambda v: 1 / (1 + np.exp(-v))
    ys = []
    for row in x:
        new_h, new_c = np.zeros(n), np.zeros(n)
        for j in range(n):
            def pre(gate):
                col = gate * n + j
                return (
                    sum(row[v] * w["W"][v, col] for v in range(net.inputs))
                    + sum(h[k] * w["U"][k, col] for k in range(n))
                    + w["b"][0, col]
                )
            i = sig(pre(0) + w["p"][0, j] * c[j])
            f = sig(pre(1) + w["p"][1, j] * c[j])
            g = act(pre(2))
            new_c[j] = f * c[j] + i * g
            o = sig(pre(3) + w["p"][2, j] * new_c[j])
            new_h[j] = o * act(new_c[j])
        h, c = new_h, new_c
        ys.append([sum(h[k] * w["Wy"][k, m] for k in range(n)) + w["by"][0, m] for m in range(net.outputs)])
    return np.array(ys), h, c


@pytest.mark.parametrize("kind", ["TANH", "SOFTSIGN"])
def test_forward_matches_slow_loop(kind):
    rng = np.random.default_rng(1)
    net = cell.Net(3, 4, 2, kind)
    theta = rng.normal(size=(2, net.size))
    x = rng.normal(size=(6, 2, 5, 3))
    state = rng.normal(size=(2, 5, 4)), rng.normal(size=(2, 5, 4))
    hs, (h, c) = cell.forward(net, theta, x, state)
    y = cell.outputs(net, theta, hs)
    for g in range(2):
        for b in range(5):
            ys, h1, c1 = slow_forward(net, theta[g], x[:, g, b], state[0][g, b], state[1][g, b])
            np.testing.assert_allclose(y[:, g, b], ys, rtol=1e-10)
            np.testing.assert_allclose(h[g, b], h1, rtol=1e-10)
            np.testing.assert_allclose(c[g, b], c1, rtol=1e-10)


@pytest.mark.parametrize("kind", ["TANH", "SOFTSIGN"])
def test_gradient_matches_finite_differences(kind):
    rng = np.random.default_rng(2)
    net = cell.Net(2, 3, 2, kind)
    theta = rng.normal(size=(2, net.size)) * 0.5
    x, y = rng.normal(size=(5, 2, 4, 2)), rng.normal(size=(2, 4, 2))
    masks = (rng.random((5, 1, 4, 2)) < 0.7) / 0.7, (rng.random((1, 4, 3)) < 0.7) / 0.7
    _, grad, _ = cell.loss_gradient(net, theta, x, y, masks=masks)
    eps = 1e-6
    for k in range(net.size):
        up, down = theta.copy(), theta.copy()
        up[:, k] += eps
        down[:, k] -= eps
        slope = (
            cell.loss_gradient(net, up, x, y, masks=masks)[0] - cell.loss_gradient(net, down, x, y, masks=masks)[0]
        ) / (2 * eps)
        np.testing.assert_allclose(grad[:, k], slope, rtol=1e-5, atol=1e-8)


def test_parameter_count():
    v, h, k = 3, 5, 2
    assert cell.Net(v, h, k, "TANH").size == 4 * h * (v + h) + 3 * h + 4 * h + (h + 1) * k


def test_updaters_match_hand_written_steps():
    g1, g2, rate = np.array([[0.5, -2.0]]), np.array([[-0.25, 1.0]]), 0.1
    for name in ("NESTEROVS", "RMSPROP", "ADAGRAD"):
        cfg = ForecastConfig(updater=name, learning_rate=rate)
        theta, memory = np.array([[1.0, 2.0]]), np.zeros((1, 2))
        want, m = [1.0, 2.0], [0.0, 0.0]
        for g in (g1, g2):
            cell.step(cfg, theta, memory, g)
            for k in range(2):
                d = g[0, k]
                if name == "NESTEROVS":
                    new = 0.9 * m[k] - rate * d
                    want[k] += -0.9 * m[k] + 1.9 * new
                    m[k] = new
                elif name == "RMSPROP":
                    m[k] = 0.95 * m[k] + 0.05 * d * d
                    want[k] -= rate * d / (m[k] ** 0.5 + 1e-8)
                else:
                    m[k] += d * d
                    want[k] -= rate * d / (m[k] ** 0.5 + 1e-6)
        np.testing.assert_allclose(theta[0], want, rtol=1e-12)


def test_networks_do_not_influence_each_other():
    rng = np.random.default_rng(3)
    cfg = ForecastConfig(window=6, batch=4, learning_rate=0.05, dropout=0.8)
    net = cell.net_for(cfg, 2, 1)
    x, y = rng.normal(size=(6, 7, 4, 2)), rng.normal(size=(7, 4, 1))
    together = np.repeat(net.initial(1)[None], 7, 0)
    memory = np.zeros_like(together)
    for tick in range(3):
        cell.fit_batch(cfg, net, together, memory, x, y, tick)
    for g in range(7):
        alone = net.initial(1)[None].copy()
        m = np.zeros_like(alone)
        for tick in range(3):
            cell.fit_batch(cfg, net, alone, m, np.ascontiguousarray(x[:, g : g + 1]), y[g : g + 1], tick)
        assert (alone[0] == together[g]).all()


def test_truncation_longer_than_the_example_changes_nothing():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(6, 1, 4, 2)), rng.normal(size=(1, 4, 1))
    results = []
    for cfg in (ForecastConfig(), ForecastConfig(truncated_bptt=True, bptt_length=30)):
        net = cell.net_for(cfg, 2, 1)
        theta = net.initial(1)[None].copy()
        cell.fit_batch(cfg, net, theta, np.zeros_like(theta), x, y, 0)
        results.append(theta)
    assert (results[0] == results[1]).all()


def test_truncated_gradient_stops_at_the_last_stretch():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(7, 1, 4, 2)), rng.normal(size=(1, 4, 1))
    cfg = ForecastConfig(truncated_bptt=True, bptt_length=3)
    net = cell.net_for(cfg, 2, 1)
    theta = net.initial(1)[None].copy()
    got = theta.copy()
    cell.fit_batch(cfg, net, got, np.zeros_like(got), x, y, 0)
    _, state = cell.forward(net, theta, x[:6])
    _, grad, _ = cell.loss_gradient(net, theta, x[6:], y, state)
    cell.step(cfg, theta, np.zeros_like(theta), grad)  # momentum is still zero before the last stretch
    np.testing.assert_allclose(got, theta, rtol=1e-13)


def test_penalty_acts_only_when_switched_on():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(4, 1, 4, 2)), rng.normal(size=(1, 4, 1))
    ends = []
    for cfg in (ForecastConfig(), ForecastConfig(l1=0.1, l2=0.1), ForecastConfig(l1=0.1, l2=0.1, regularization=True)):
        net = cell.net_for(cfg, 2, 1)
        theta = net.initial(1)[None].copy()
        cell.fit_batch(cfg, net, theta, np.zeros_like(theta), x, y, 0)
        ends.append(theta)
    assert (ends[0] == ends[1]).all() and (ends[0] != ends[2]).any()


def test_cut_examples():
    rows = np.arange(20.0).reshape(1, 10, 2)
    got = cell.cut_examples(rows, 4, 2, 3)
    assert got.shape == (4, 1, 3, 2)
    for b in range(3):
        assert (got[:, 0, b] == rows[0, 2 + b : 6 + b]).all()
