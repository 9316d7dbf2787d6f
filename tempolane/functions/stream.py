"""Cutting a task's sorted Arrow batches into whole series."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Series are worked on together until they hold this many rows.
PACK_ROWS = 500_000
PACK_SERIES = 1_024


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long DOUBLE lists as a 2-D array."""
    if len(column) == 0:
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole_series(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(first row, xs [N, V], ys [N, K]) of each series. Rows arrive sorted by
    series and position; `head` marks the first of a series."""
    first, xs, ys = None, [], []
    for batch in batches:
        heads = np.flatnonzero(batch.column("head").to_numpy(zero_copy_only=False))
        x, y = matrix(batch.column("xs")), matrix(batch.column("ys"))
        start = 0
        for at in [*heads, batch.num_rows]:
            if at > start:
                if first is None:
                    raise RuntimeError("rows are not in series order")
                xs.append(x[start:at])
                ys.append(y[start:at])
            if at < batch.num_rows:
                if first is not None:
                    yield first, np.concatenate(xs), np.concatenate(ys)
                first, xs, ys = batch.slice(at, 1), [], []
            start = at
    if first is not None:
        yield first, np.concatenate(xs), np.concatenate(ys)


def packs(series: Iterable, size: int = PACK_ROWS) -> Iterator[list]:
    """Lists of series with a bounded number of rows in all."""
    pack, rows = [], 0
    for item in series:
        pack.append(item)
        rows += len(item[1])
        if rows >= size or len(pack) >= PACK_SERIES:
            yield pack
            pack, rows = [], 0
    if pack:
        yield pack


def alike(pack: list, length, size: int) -> Iterator[list]:
    """Groups of at most `size` series, longest first, none more than twice as
    long as another in its group, which bounds the filling in `stack`."""
    group: list = []
    for item in sorted(pack, key=lambda item: -length(item)):
        if group and (len(group) >= size or 2 * length(item) < length(group[0])):
            yield group
            group = []
        group.append(item)
    if group:
        yield group


def stack(arrays: list[np.ndarray]) -> np.ndarray:
    """[G, N, V], shorter ones filled up with zeros that no example reads."""
    out = np.zeros((len(arrays), max(len(a) for a in arrays), arrays[0].shape[1]))
    for at, a in enumerate(arrays):
        out[at, : len(a)] = a
    return out


def field(first: pa.RecordBatch, name: str):
    return first.column(name)[0].as_py()


def key_columns(firsts: list[pa.RecordBatch], keys: tuple[str, ...]) -> list[pa.Array]:
    return [pa.concat_arrays([f.column(k) for f in firsts]) for k in keys]


def nested(values: np.ndarray) -> pa.Array:
    """A [N, S, K] array as N lists of S lists of K doubles."""
    n, s, k = values.shape
    cells = pa.array(np.ascontiguousarray(values).reshape(-1))
    rows = pa.ListArray.from_arrays(pa.array(np.arange(0, n * s * k + 1, max(k, 1), dtype=np.int32)), cells)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * s + 1, max(s, 1), dtype=np.int32)), rows)
