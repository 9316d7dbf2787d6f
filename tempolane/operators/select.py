"""Choosing which variables are predicted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tempolane.config import SeriesSpec


def split_list(text: str | None) -> list[str]:
    """`"a,b"` as a list. Nothing is trimmed: names may hold blanks. Nothing or
    an empty text is an empty list, which selects every variable."""
    return text.split(",") if text else []


def resolve_targets(
    columns: Sequence[str], targets: str | Sequence[str] | None, ignore_unknown: bool = False
) -> tuple[str, ...]:
    """Exact, case-sensitive match of target names, in the order asked for.

    `ignore_unknown` drops names without a match, but at least one must remain."""
    wanted = split_list(targets) if isinstance(targets, str) or targets is None else list(targets)
    if not wanted:
        return tuple(columns)
    found = tuple(t for t in wanted if t in columns)
    unknown = [t for t in wanted if t not in columns]
    if not found or (unknown and not ignore_unknown):
        raise ValueError(f"no column matches {unknown}; columns are {list(columns)}")
    return found


def select_targets(
    df: DataFrame, spec: SeriesSpec, targets: str | Sequence[str] | None = None, ignore_unknown: bool = False
) -> DataFrame:
    """Keys, order and the predicted columns; headers are the resolved names."""
    chosen = resolve_targets(spec.values, targets, ignore_unknown)
    return df.select(*dict.fromkeys((*spec.keys, *spec.order, *chosen)))


def select_features(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Keys, order and every variable: all are inputs, also if few are predicted."""
    return df.select(*dict.fromkeys((*spec.keys, *spec.order, *spec.values)))
