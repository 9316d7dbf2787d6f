"""Small made-up series for tests."""

import numpy as np
import pandas as pd

from tempolane import SeriesSpec

SPEC = SeriesSpec(keys="name", order="at", values=("a", "b"))
SCHEMA = "name string, at bigint, a double, b double"


def frame(lengths, seed=0):
    """One series per (name, length): two noisy waves, rows in random order."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, n in lengths.items():
        t = np.arange(n)
        parts.append(
            pd.DataFrame(
                {
                    "name": name,
                    "at": t * 3 + 7,
                    "a": np.sin(t / 5) * 10 + rng.normal(size=n),
                    "b": np.cos(t / 9) * 3 + rng.normal(size=n) * 0.1,
                }
            )
        )
    return pd.concat(parts).sample(frac=1, random_state=seed)


def spark_frame(spark, lengths, seed=0):
    return spark.createDataFrame(frame(lengths, seed), SCHEMA)


def plan(n, cfg):
    """(lost, train batches, test batches), by the definition."""
    total = n - cfg.window
    batches = total // cfg.batch
    n_test = int(batches * cfg.test_ratio)
    return total - batches * cfg.batch, batches - n_test, n_test


def scaled(values, cfg):
    """Scaled inputs and labels of one series, by building every example."""
    lost, n_train, _ = plan(len(values), cfg)
    starts = range(lost, lost + n_train * cfg.batch)
    seen = np.concatenate([values[i : i + cfg.window] for i in starts])
    labels = np.array([values[i + cfg.window] for i in starts])
    out = []
    for part in (seen, labels):
        low, high = part.min(0), part.max(0)
        out.append(((values - low) / (high - low), low, high))
    return out
