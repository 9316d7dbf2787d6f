"""A shard of token ids as a wavelet matrix: bit-planes with ranks, one file.

Plane b holds bit b of every id, highest first; below a plane the ids with 0 come
before those with 1. Access, counting and occurrences follow the planes with rank
and select, reading the compressed blocks that they need and no others.
"""

from __future__ import annotations

import functools
import json
import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
BLOCK = 1 << 15  # bytes of a plane that are compressed together: 262,144 bits
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def dump(tokens: np.ndarray, doc_ids: np.ndarray, doc_null: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file's bytes: magic, length of the header, header (JSON), blocks."""
    tokens = np.asarray(tokens)
    bits = max(1, int(tokens.max(initial=0)).bit_length())
    x = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
    body, at, planes = [], 0, []

    def put(data: bytes) -> int:
        nonlocal at
        packed = _pack(data)
        body.append(packed)
        at += len(packed)
        return len(packed)

    for b in range(bits - 1, -1, -1):
        zeros, start, sizes, ones, low, high = 0, at, [], [], [], []
        for i in range(0, len(x), BLOCK * 8):  # blocks that stay in a processor's cache
            part = x[i : i + BLOCK * 8]
            one = (part & x.dtype.type(1 << b)) != 0
            sizes.append(put(np.packbits(one).tobytes()))
            high.append(part.take(np.flatnonzero(one)))
            low.append(part.take(np.flatnonzero(~one)))
            ones.append(len(high[-1]))
            zeros += len(low[-1])
        planes.append({"bit": b, "zeros": zeros, "start": start, "sizes": sizes, "ones": ones})
        x = np.concatenate([*low, *high]) if low else x
    docs = {"start": at, "sizes": [put(doc_ids.astype("<i8").tobytes()), put(np.packbits(doc_null).tobytes()), put(lengths.astype("<i8").tobytes())]}
    header = json.dumps({"n": len(tokens), "docs": len(lengths), "bits": bits, "planes": planes, "index": docs}).encode()
    return b"".join([MAGIC, struct.pack("<Q", len(header)), header, *body])


class WaveletFile:
    """`read(start, size)` gives bytes of the file; blocks are read when needed."""

    def __init__(self, read):
        self._read = read
        head = read(0, 12)
        if head[:4] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack("<Q", head[4:])[0]
        self.head = json.loads(read(12, size))
        self.body = 12 + size
        self.n, self.bits = self.head["n"], self.head["bits"]
        for p in self.head["planes"]:
            p["at"] = np.cumsum([0, *p["sizes"]])
            p["before"] = np.cumsum([0, *p["ones"]])
        self._block = functools.lru_cache(maxsize=256)(self._load)

    def _load(self, plane: int, block: int) -> np.ndarray:
        p = self.head["planes"][plane]
        data = self._read(self.body + p["start"] + int(p["at"][block]), p["sizes"][block])
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)

    def _plane(self, plane: int) -> np.ndarray:
        """All bits of a plane."""
        p = self.head["planes"][plane]
        data = self._read(self.body + p["start"], int(p["at"][-1]))
        unpack = zstandard.ZstdDecompressor()
        parts = [unpack.decompress(data[a:b]) for a, b in zip(p["at"][:-1], p["at"][1:])]
        return np.unpackbits(np.frombuffer(b"".join(parts), dtype=np.uint8), count=self.n)

    def _rank(self, plane: int, i: int) -> tuple[int, int]:
        """(ones before place i, bit at i); past the end the bit is 0."""
        block, within = divmod(i, BLOCK * 8)
        before = int(self.head["planes"][plane]["before"][min(block, len(self.head["planes"][plane]["ones"]))])
        if i >= self.n and within == 0:
            return before, 0
        data = self._block(plane, block)
        byte, bit = divmod(within, 8)
        ones = int(POPCOUNT[data[:byte]].sum(dtype=np.int64))
        here = int(data[byte]) if byte < len(data) else 0
        return before + ones + bin(here >> (8 - bit)).count("1"), here >> (7 - bit) & 1

    def _select(self, plane: int, k: int, bit: int) -> int:
        """Place of the k-th (from 0) `bit` of a plane."""
        before = self.head["planes"][plane]["before"]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK * 8, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        found = np.unpackbits(self._block(plane, block)) == bit
        return block * BLOCK * 8 + int(np.flatnonzero(found)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The token at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            ones, bit = self._rank(plane, i)
            value = value << 1 | bit
            i = self.head["planes"][plane]["zeros"] + ones if bit else i - ones
        return value

    def _range(self, token: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        a, b = 0, self.n
        for plane, p in enumerate(self.head["planes"]):
            ones_a, ones_b = self._rank(plane, a)[0], self._rank(plane, b)[0]
            if token >> p["bit"] & 1:
                a, b = p["zeros"] + ones_a, p["zeros"] + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def count(self, token: int) -> int:
        a, b = self._range(token)
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        a, b = self._range(token)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for plane in range(self.bits - 1, -1, -1):
            p = self.head["planes"][plane]
            bit = token >> p["bit"] & 1
            i = self._select(plane, i - p["zeros"] if bit else i, bit)
        return i

    def tokens(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        x = np.zeros(self.n, dtype=kind)
        for plane in range(self.bits - 1, -1, -1):
            p = self.head["planes"][plane]
            all_ones, value = self._plane(plane).view(bool), kind(1 << p["bit"])
            order, low, high = np.empty(self.n, dtype=kind), 0, p["zeros"]
            for i in range(0, self.n, BLOCK * 8):
                one, part = all_ones[i : i + BLOCK * 8], order[i : i + BLOCK * 8]
                at = np.flatnonzero(one)
                part[at] = x[high : high + len(at)] | value
                high += len(at)
                at = np.flatnonzero(~one)
                part[at] = x[low : low + len(at)]
                low += len(at)
            x = order
        return x

    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document ids, which of them are null, number of tokens)."""
        entry, n = self.head["index"], self.head["docs"]
        at = np.cumsum([0, *entry["sizes"]]) + self.body + entry["start"]
        ids, null, lengths = (
            np.frombuffer(zstandard.ZstdDecompressor().decompress(self._read(int(a), int(b - a))), dtype=t)
            for a, b, t in zip(at[:-1], at[1:], ("<i8", np.uint8, "<i8"))
        )
        return ids, np.unpackbits(null, count=n).astype(bool), lengths
