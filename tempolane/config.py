"""What a run needs to know: which columns form a series, and how to model it."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# Defaults and option names users already have in their settings.
OPTION_NAMES = {
    "nEpochs": "epochs",
    "timeSeriesSize": "window",
    "miniBatchSize": "batch",
    "testRatio": "test_ratio",
    "learningRate": "learning_rate",
    "hiddenNodes": "hidden",
    "updater": "updater",
    "momentum": "momentum",
    "rmsDecay": "rms_decay",
    "activation": "activation",
    "regularization": "regularization",
    "l1": "l1",
    "l2": "l2",
    "dropOut": "dropout",
    "truncatedBPTT": "truncated_bptt",
    "tBPTTLength": "bptt_length",
    "saveUpdater": "save_updater",
    "forecastSteps": "steps",
}
UPDATERS = ("NESTEROVS", "RMSPROP", "ADAGRAD")
ACTIVATIONS = ("TANH", "SOFTSIGN")

# Columns this library adds to the user's rows.
RESERVED = (
    "pos", "n", "i", "step", "split", "batch", "slot", "x", "y", "target",
    "value", "run_id", "params", "updater", "scaler", "history",
)


@dataclass(frozen=True)
class ForecastConfig:
    window: int = 30  # T: rows per example
    batch: int = 32  # B: examples per mini-batch
    test_ratio: float = 0.2  # r: share of mini-batches kept for testing
    steps: int = 3  # F: rows to forecast, below `window`
    epochs: int = 50
    learning_rate: float = 0.001
    hidden: int = 5
    updater: str = "NESTEROVS"
    momentum: float = 0.9
    rms_decay: float = 0.95
    rms_epsilon: float = 1e-8
    adagrad_epsilon: float = 1e-6
    activation: str = "TANH"
    regularization: bool = False  # l1 and l2 act only when this is on
    l1: float = 0.0
    l2: float = 0.0
    dropout: float = 0.0  # probability of KEEPING an input; 0 turns it off
    truncated_bptt: bool = False
    bptt_length: int = 30
    save_updater: bool = False
    seed: int = 8347480
    averaging_frequency: int = 5  # mini-batches between two parameter averages
    shards: int = 0  # parts that train one network for all series; 0: by the number of rows
    long_rows: int = 200_000  # a longer series is read in pieces; results do not depend on it

    def __post_init__(self):
        # An unknown name selects the default instead of failing.
        if self.updater not in UPDATERS:
            object.__setattr__(self, "updater", UPDATERS[0])
        if self.activation not in ACTIVATIONS:
            object.__setattr__(self, "activation", ACTIVATIONS[0])
        for name in ("window", "batch", "hidden", "averaging_frequency", "long_rows", "bptt_length"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1, got {getattr(self, name)}")
        if self.epochs < 0 or self.steps < 0 or self.shards < 0:
            raise ValueError("epochs, steps and shards must not be negative")
        if not 0.0 <= self.test_ratio <= 1.0:
            raise ValueError(f"test_ratio must lie in [0, 1], got {self.test_ratio}")
        if not 0.0 <= self.dropout <= 1.0:
            raise ValueError(f"dropout must lie in [0, 1], got {self.dropout}")

    @classmethod
    def from_options(cls, options: Mapping[str, str], **overrides) -> ForecastConfig:
        """Build from string options; missing or empty ones keep their default."""
        kinds = {f.name: type(f.default) for f in dataclasses.fields(cls)}
        chosen = {}
        for name, text in options.items():
            if name not in OPTION_NAMES:
                raise ValueError(f"unknown option {name!r}; known: {sorted(OPTION_NAMES)}")
            text = str(text).strip()
            if not text:
                continue
            field = OPTION_NAMES[name]
            kind = kinds[field]
            chosen[field] = text.lower() == "true" if kind is bool else kind(text)
        return cls(**{**chosen, **overrides})

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> ForecastConfig:
        return cls(**json.loads(text))


def _names(value) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)


@dataclass(frozen=True)
class SeriesSpec:
    """`keys` name a series, `order` sorts it oldest first, `values` are its
    variables. All variables are inputs; `targets` (default: all) are predicted."""

    order: tuple[str, ...] | str
    values: tuple[str, ...] | str
    keys: tuple[str, ...] | str = ()
    targets: tuple[str, ...] | str = ()

    def __post_init__(self):
        for field in ("order", "values", "keys", "targets"):
            object.__setattr__(self, field, _names(getattr(self, field)))
        if not self.order or not self.values:
            raise ValueError("a series needs at least one order and one value column")
        if not self.targets:
            object.__setattr__(self, "targets", self.values)
        unknown = [t for t in self.targets if t not in self.values]
        if unknown:
            raise ValueError(f"targets {unknown} are not among the value columns {list(self.values)}")
        clash = [c for c in (*self.keys, *self.values) if c in RESERVED or c.startswith("_tl_")]
        if clash:
            raise ValueError(f"column names {clash} are reserved; rename them first")

    def check(self, schema: T.StructType) -> None:
        """Fail early on columns that are missing or not numeric."""
        for name in (*self.keys, *self.order, *self.values):
            if name not in schema.fieldNames():
                raise ValueError(f"column {name!r} not found in {schema.fieldNames()}")
        for name in self.values:
            if not isinstance(schema[name].dataType, T.NumericType):
                raise ValueError(f"value column {name!r} is {schema[name].dataType.simpleString()}, not numeric")
