"""Counting quotient filters over packed n-grams of word numbers.

An n-gram is packed into limbs of at most 64 bits, whole words each, and permuted by an
invertible mix. The first bits of the mixed value are the quotient, which names a slot
by its place; what is left, the remainder, is stored in full, so nothing is lost and the
n-gram can be had back. A filter is sorted: occupied slots and ends of runs are bits,
then the remainders in whole bytes, then counters of one byte, with large ones behind.
Sorted filters of different shards merge like lists.
"""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(_MIX[0])
    x = (x ^ (x >> U(27))) * U(_MIX[1])
    return x ^ (x >> U(31))


class Packing:
    """Packs n-grams of `k` numbers of `bits` bits, and permutes what is packed."""

    def __init__(self, k: int, bits: int):
        self.k, self.bits = k, bits
        per = max(1, 64 // bits)
        self.groups = [range(at, min(at + per, k)) for at in range(0, k, per)]
        self.widths = [bits * len(g) for g in self.groups]
        self.masks = [U((1 << w) - 1) for w in self.widths]

    def pack(self, ids: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The n-grams that start at places `at` of the numbers `ids`."""
        limbs = []
        for group in self.groups:
            x = np.zeros(len(at), dtype=U)
            for j in group:
                x = (x << U(self.bits)) | ids[at + j].astype(U)
            limbs.append(x)
        return limbs

    def unpack(self, limbs: list[np.ndarray]) -> np.ndarray:
        """[n, k] numbers."""
        columns = []
        for x, group in zip(limbs, self.groups):
            last = len(group) - 1
            columns += [(x >> U(self.bits * (last - i))) & U((1 << self.bits) - 1) for i in range(last + 1)]
        return np.stack(columns, axis=1).astype(np.int64)

    def _others(self, limbs: list[np.ndarray], i: int, turn: int) -> np.ndarray:
        x = np.full(len(limbs[0]), (_MIX[3] * (turn * 8 + i + 1)) & ((1 << 64) - 1), dtype=U)
        for j, limb in enumerate(limbs):
            if j != i:
                x = _spread(x + limb * U(_MIX[2]))
        return x

    def _steps(self):
        for turn in range(2):
            for i in reversed(range(len(self.widths))):
                yield turn, i

    def permute(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = list(limbs)
        for turn, i in self._steps():
            w, mask = self.widths[i], self.masks[i]
            x = limbs[i]
            if len(limbs) > 1:
                x = (x + self._others(limbs, i, turn)) & mask
            for m in _MIX[:2]:
                x = (x * U(m)) & mask
                x = x ^ (x >> U((w + 1) // 2))
            limbs[i] = x
        return limbs

    def restore(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        limbs = list(limbs)
        for turn, i in reversed(list(self._steps())):
            w, mask = self.widths[i], self.masks[i]
            x = limbs[i]
            for m in reversed(_MIX[:2]):
                x = x ^ (x >> U((w + 1) // 2))
                x = (x * U(pow(m, -1, 1 << w))) & mask
            limbs[i] = x
            if len(limbs) > 1:
                limbs[i] = (x - self._others(limbs, i, turn)) & mask
        return limbs


def merged(limbs: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted, each value once with the sum of its counts. The list `limbs` gets the
    sorted arrays one after the other, so that what was there can go."""
    if not len(counts):
        return limbs, counts
    # Sorted parts stand one behind the other: a stable sort merges them.
    order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
    for i in range(len(limbs)):
        limbs[i] = limbs[i][order]
    counts = counts[order]
    del order
    new = np.zeros(len(counts), dtype=bool)
    new[0] = True
    for x in limbs:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return [x[first] for x in limbs], np.add.reduceat(counts, first)


class QuotientFilter:
    """Counters of sorted permuted values that share their first `prefix` bits."""

    def __init__(self, widths: list[int], prefix: int, limbs: list[np.ndarray], counts: np.ndarray):
        self.widths, self.prefix, self.counts = widths, prefix, counts
        n = len(counts)
        self.q = max(0, min(widths[0] - prefix, max(1, n).bit_length()))
        rest = widths[0] - prefix
        inside = limbs[0] & U((1 << rest) - 1) if n else limbs[0]
        self.block = int(limbs[0][0] >> U(rest)) if n and prefix else 0
        r = rest - self.q
        slots = (inside >> U(r)).astype(np.int64) if r < 64 else np.zeros(n, dtype=np.int64)
        self.starts = np.zeros((1 << self.q) + 1, dtype=np.int64)
        np.cumsum(np.bincount(slots, minlength=1 << self.q), out=self.starts[1:])
        self.rests = [inside & U((1 << r) - 1), *limbs[1:]]

    def __len__(self) -> int:
        return len(self.counts)

    @property
    def limbs(self) -> list[np.ndarray]:
        rest = self.widths[0] - self.prefix
        slots = np.repeat(np.arange(1 << self.q, dtype=np.int64), np.diff(self.starts)).astype(U)
        first = self.rests[0] | (slots << U(rest - self.q) if rest - self.q < 64 else slots)
        if self.prefix:
            first |= U(self.block << rest)
        return [first, *self.rests[1:]]

    def look_up(self, limbs: list[np.ndarray]) -> np.ndarray:
        """Counts of permuted values, 0 where there is none: all step through the
        runs of their slots at once."""
        found = np.zeros(len(limbs[0]), dtype=np.int64)
        if not len(self) or not len(found):
            return found
        rest = self.widths[0] - self.prefix
        r = rest - self.q
        inside = limbs[0] & U((1 << rest) - 1)
        slot = (inside >> U(r)).astype(np.int64) if r < 64 else np.zeros(len(found), dtype=np.int64)
        asked = [inside & U((1 << r) - 1), *limbs[1:]]
        at, stop = self.starts[slot], self.starts[slot + 1]
        open_ = np.arange(len(found))
        if self.prefix:
            open_ = open_[(limbs[0] >> U(rest)) == U(self.block)]
        open_ = open_[at[open_] < stop[open_]]
        while len(open_):
            here = at[open_]
            same = np.ones(len(open_), dtype=bool)
            for own, x in zip(self.rests, asked):
                same &= own[here] == x[open_]
            found[open_[same]] = self.counts[here[same]]
            at[open_] += 1
            open_ = open_[~same & (at[open_] < stop[open_])]
        return found

    def to_bytes(self) -> bytes:
        n = len(self)
        runs = np.diff(self.starts)
        ends = np.zeros(n, dtype=bool)
        ends[self.starts[1:][runs > 0] - 1] = True
        parts = [struct.pack("<QBQ", n, self.q, self.block), np.packbits(runs > 0).tobytes(), np.packbits(ends).tobytes()]
        for x, w in zip(self.rests, self._stored()):
            parts.append(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(n, 8)[:, :w]).tobytes())
        small = np.minimum(self.counts, 255).astype(np.uint8)
        parts += [small.tobytes(), self.counts[small == 255].astype("<i8").tobytes()]
        return b"".join(parts)

    def _stored(self) -> list[int]:
        """Bytes of a remainder, limb by limb."""
        return [(w + 7) // 8 for w in (self.widths[0] - self.prefix - self.q, *self.widths[1:])]

    @classmethod
    def from_bytes(cls, data: bytes, widths: list[int], prefix: int) -> QuotientFilter:
        own = cls.__new__(cls)
        n, own.q, own.block = struct.unpack_from("<QBQ", data)
        own.widths, own.prefix = widths, prefix
        at = struct.calcsize("<QBQ")

        def take(size: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, dtype=np.uint8, count=size, offset=at)
            at += size
            return part

        slots = 1 << own.q
        occupied = np.flatnonzero(np.unpackbits(take((slots + 7) // 8), count=slots))
        ends = np.flatnonzero(np.unpackbits(take((n + 7) // 8), count=n)) + 1
        runs = np.zeros(slots, dtype=np.int64)
        runs[occupied] = np.diff(ends, prepend=0)
        own.starts = np.append(0, np.cumsum(runs))
        own.rests = []
        for w in own._stored():
            x = np.zeros((n, 8), dtype=np.uint8)
            x[:, :w] = take(n * w).reshape(n, w)
            own.rests.append(x.view("<u8").reshape(n).astype(U))
        own.counts = take(n).astype(np.int64)
        large = np.flatnonzero(own.counts == 255)
        own.counts[large] = np.frombuffer(take(8 * len(large)).tobytes(), dtype="<i8")
        return own


def blocks(packing: Packing, prefix: int, limbs: list[np.ndarray], counts: np.ndarray):
    """(block, filter) of sorted permuted values, by their first `prefix` bits."""
    block = (limbs[0] >> U(packing.widths[0] - prefix)).astype(np.int64) if prefix else np.zeros(len(counts), dtype=np.int64)
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(counts)]):
        yield int(block[a]), QuotientFilter(packing.widths, prefix, [x[a:b] for x in limbs], counts[a:b])
