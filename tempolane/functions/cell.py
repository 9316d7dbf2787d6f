"""The recurrent network, as pure functions of numpy arrays; runs inside tasks.

One layer of LSTM cells with peepholes and a linear output. With state c', h':

    i = s(Wi x + Ui h' + pi*c' + bi)      f = s(Wf x + Uf h' + pf*c' + bf)
    g = act(Wg x + Ug h' + bg)            c = f*c' + i*g
    o = s(Wo x + Uo h' + po*c + bo)       h = o*act(c)       y = Wy h + by

Every function works on G independent networks at once, one per series: the
leading axis of `theta` [G, size] and the second of `x` [T, G, B, V]. A network's
numbers do not depend on which others share the call.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from tempolane.config import ForecastConfig


class Net(NamedTuple):
    inputs: int
    hidden: int
    outputs: int
    activation: str

    @property
    def shapes(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {
            "W": (self.inputs, 4 * h),
            "U": (h, 4 * h),
            "p": (3, h),
            "b": (1, 4 * h),
            "Wy": (h, self.outputs),
            "by": (1, self.outputs),
        }

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes.values())

    def parts(self, theta: np.ndarray) -> dict[str, np.ndarray]:
        """Views of the weights in `theta` [G, size]."""
        out, at = {}, 0
        for name, shape in self.shapes.items():
            width = int(np.prod(shape))
            out[name] = theta[:, at : at + width].reshape(len(theta), *shape)
            at += width
        return out

    def initial(self, seed: int) -> np.ndarray:
        """Normal with variance 2 / (inputs + outputs) of each weight matrix;
        the forget gate starts open. The same for every series."""
        rng = np.random.default_rng(seed)
        theta = np.zeros((1, self.size))
        parts, h = self.parts(theta), self.hidden
        for name in ("W", "U", "Wy"):
            _, rows, cols = parts[name].shape
            fan = rows + (h if name != "Wy" else cols)
            parts[name][...] = rng.normal(0.0, np.sqrt(2.0 / fan), parts[name].shape)
        parts["b"][:, :, h : 2 * h] = 1.0
        return theta[0]


def net_for(cfg: ForecastConfig, inputs: int, outputs: int) -> Net:
    return Net(inputs, cfg.hidden, outputs, cfg.activation)


def _sigmoid(z):
    return 0.5 * (np.tanh(0.5 * z) + 1.0)


def _act(z, kind):
    return np.tanh(z) if kind == "TANH" else z / (1.0 + np.abs(z))


def _act_slope(a, kind):
    """Derivative, from the value of the activation."""
    return 1.0 - a * a if kind == "TANH" else (1.0 - np.abs(a)) ** 2


def zero_state(groups: int, examples: int, hidden: int):
    return np.zeros((groups, examples, hidden)), np.zeros((groups, examples, hidden))


def forward(net: Net, theta, x, state=None, trace: dict | None = None):
    """Hidden values [T, G, B, h] of all steps and the state (h, c) after them.
    `trace` receives what `backward` needs."""
    w, h_n = net.parts(theta), net.hidden
    steps, groups, examples, _ = x.shape
    h, c = state if state is not None else zero_state(groups, examples, h_n)
    zx = np.matmul(x, w["W"]) + w["b"]
    pi, pf, po = (w["p"][:, None, k] for k in range(3))
    hs = np.empty((steps, groups, examples, h_n))
    if trace is not None:
        trace.update(h0=h, c0=c, x=x, hs=hs, gates=[], cs=[])
    for t in range(steps):
        z = zx[t] + np.matmul(h, w["U"])
        i = _sigmoid(z[..., :h_n] + pi * c)
        f = _sigmoid(z[..., h_n : 2 * h_n] + pf * c)
        g = _act(z[..., 2 * h_n : 3 * h_n], net.activation)
        c = f * c + i * g
        o = _sigmoid(z[..., 3 * h_n :] + po * c)
        a = _act(c, net.activation)
        h = o * a
        hs[t] = h
        if trace is not None:
            trace["gates"].append((i, f, g, o, a))
            trace["cs"].append(c)
    return hs, (h, c)


def outputs(net: Net, theta, hs):
    w = net.parts(theta)
    return np.matmul(hs, w["Wy"]) + w["by"]


def backward(net: Net, theta, trace: dict, dh):
    """Gradient [G, size] of the recurrent weights, given the derivative `dh`
    [G, B, h] by the last hidden value. Output weights stay zero."""
    w, h_n, kind = net.parts(theta), net.hidden, net.activation
    hs, cs, x = trace["hs"], trace["cs"], trace["x"]
    steps, groups, examples, _ = hs.shape
    grad = np.zeros_like(theta)
    out = net.parts(grad)
    pi, pf, po = (w["p"][:, None, k] for k in range(3))
    u_back = w["U"].transpose(0, 2, 1)
    dz = np.empty((steps, groups, examples, 4 * h_n))
    dc = np.zeros((groups, examples, h_n))
    for t in reversed(range(steps)):
        i, f, g, o, a = trace["gates"][t]
        c_before = cs[t - 1] if t else trace["c0"]
        zo = dh * a * o * (1.0 - o)
        dc = dc + dh * o * _act_slope(a, kind) + zo * po
        zi = dc * g * i * (1.0 - i)
        zf = dc * c_before * f * (1.0 - f)
        zg = dc * i * _act_slope(g, kind)
        out["p"][:, 0] += (zi * c_before).sum(1)
        out["p"][:, 1] += (zf * c_before).sum(1)
        out["p"][:, 2] += (zo * cs[t]).sum(1)
        dz[t] = np.concatenate((zi, zf, zg, zo), axis=-1)
        dc = dc * f + zi * pi + zf * pf
        dh = np.matmul(dz[t], u_back)

    def flat(values):  # [T, G, B, k] as [G, T*B, k]
        return values.transpose(1, 0, 2, 3).reshape(groups, steps * examples, values.shape[-1])

    dz_flat = flat(dz)
    h_before = np.concatenate((trace["h0"][None], hs[:-1]))
    out["W"][...] = np.matmul(flat(x).transpose(0, 2, 1), dz_flat)
    out["U"][...] = np.matmul(flat(h_before).transpose(0, 2, 1), dz_flat)
    out["b"][...] = dz_flat.sum(1, keepdims=True)
    return grad


def loss_gradient(net: Net, theta, x, y, state=None, masks=(None, None)):
    """Mean squared error [G] at the last step against `y` [G, B, K], its
    gradient [G, size], and the state after the example."""
    in_mask, out_mask = masks
    trace: dict = {}
    hs, after = forward(net, theta, x if in_mask is None else x * in_mask, state, trace)
    top = hs[-1] if out_mask is None else hs[-1] * out_mask
    error = outputs(net, theta, top) - y
    loss = (error * error).mean(axis=(1, 2))
    dy = 2.0 * error / (error.shape[1] * error.shape[2])
    dh = np.matmul(dy, net.parts(theta)["Wy"].transpose(0, 2, 1))
    grad = backward(net, theta, trace, dh if out_mask is None else dh * out_mask)
    out = net.parts(grad)
    out["Wy"][...] = np.matmul(top.transpose(0, 2, 1), dy)
    out["by"][...] = dy.sum(1, keepdims=True)
    return loss, grad, after


def penalty_gradient(net: Net, theta, cfg: ForecastConfig):
    """Gradient of l1 and l2, on all weights but the biases."""
    grad = cfg.l2 * theta + cfg.l1 * np.sign(theta)
    parts = net.parts(grad)
    parts["b"][...] = 0.0
    parts["by"][...] = 0.0
    return grad


def step(cfg: ForecastConfig, theta, memory, grad) -> None:
    """One update, in place. `memory` is the velocity or the gradient history."""
    rate = cfg.learning_rate
    if cfg.updater == "RMSPROP":
        memory *= cfg.rms_decay
        memory += (1.0 - cfg.rms_decay) * grad * grad
        theta -= rate * grad / (np.sqrt(memory) + cfg.rms_epsilon)
    elif cfg.updater == "ADAGRAD":
        memory += grad * grad
        theta -= rate * grad / (np.sqrt(memory) + cfg.adagrad_epsilon)
    else:  # Nesterov momentum, looking ahead along the new velocity
        before = memory.copy()
        memory *= cfg.momentum
        memory -= rate * grad
        theta += (1.0 + cfg.momentum) * memory - cfg.momentum * before


def _dropout_masks(cfg: ForecastConfig, net: Net, steps: int, examples: int, tick: int):
    """Inverted dropout of the inputs of both layers. Depends on the seed and
    the mini-batch number only, so a retried task draws the same."""
    if not 0.0 < cfg.dropout < 1.0:
        return None, None
    rng = np.random.default_rng((cfg.seed, tick))
    keep = cfg.dropout
    return (
        (rng.random((steps, 1, examples, net.inputs)) < keep) / keep,
        (rng.random((1, examples, net.hidden)) < keep) / keep,
    )


def fit_batch(cfg: ForecastConfig, net: Net, theta, memory, x, y, tick: int):
    """Train on one mini-batch, in place; returns the loss [G] before the step.

    With truncated back-propagation, each stretch of the example makes a step of
    its own; only the last one carries a label and thus an error."""
    steps, groups, examples, _ = x.shape
    length = min(cfg.bptt_length, steps) if cfg.truncated_bptt else steps
    in_mask, out_mask = _dropout_masks(cfg, net, steps, examples, tick)
    state, loss = None, None
    for start in range(0, steps, length):
        stretch = x[start : start + length]
        mask = None if in_mask is None else in_mask[start : start + length]
        if start + length >= steps:
            loss, grad, _ = loss_gradient(net, theta, stretch, y, state, (mask, out_mask))
        else:
            _, state = forward(net, theta, stretch if mask is None else stretch * mask, state)
            grad = np.zeros_like(theta)
        if cfg.regularization:
            grad += penalty_gradient(net, theta, cfg)
        step(cfg, theta, memory, grad)
    return loss


def cut_examples(rows: np.ndarray, window: int, first: int, count: int) -> np.ndarray:
    """Examples first..first+count-1 of `rows` [G, N, V] as [T, G, count, V]."""
    view = np.lib.stride_tricks.sliding_window_view(rows[:, first : first + count + window - 1], window, axis=1)
    return np.ascontiguousarray(view.transpose(3, 0, 1, 2))
