"""SentencePiece encoding and decoding of whole texts.

Encoding merges in rounds over flat arrays: the symbols of all different words of
a batch lie in one array, each round finds the best pair of every word and merges
its occurrences from the left, all words at once, until no pair is left. Texts
share most words, so each word of a batch is merged once, and its ids are
gathered for every place where it stands.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tempolane.llm.text import free_name

MARK = "\u2581"  # stands for a space in the vocabulary
NONE = np.iinfo(np.int64).max
BATCH_BYTES = 4 << 20
# Bytes of words kept with their ids between batches of a worker, at most and for pieces, and from when on a word is merged alone.
KEPT_BYTES = 128 << 20
KEPT_PIECES = 64 << 20
LONG_WORD = 512


class Pieces:
    """The vocabulary of a BPE model, as tables for array lookups."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        p, n = self.processor, self.processor.vocab_size()
        names = [p.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        self.eos, self.unk = p.eos_id(), p.unk_id()
        self.ids = {names[i]: i for i in plain}
        # Rank: higher scores first; equal scores share a rank.
        scores = {i: p.get_score(i) for i in plain}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {i: order[s] for i, s in scores.items()}
        shared = np.bincount(list(self.rank.values()))
        self.bytes = [next((i for i in range(n) if p.is_byte(i) and names[i] == f"<0x{b:02X}>"), self.unk) for b in range(256)]
        # Symbols below n are pieces, n + code point is a character without a piece.
        self.base = n
        pairs = []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, i))
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.made = np.array([i for _, i in pairs], dtype=np.int64)
        self.ranks = np.array([self.rank[i] for _, i in pairs], dtype=np.int64)
        self.tied = shared > 1
        self.pair = {k: i for k, i in pairs}
        bits = 20
        # A hash of the pairs keeps most lookups of pairs that don't exist off the binary search.
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(44)).astype(np.int64)

    def _symbol(self, piece: str) -> int | None:
        if piece in self.ids:
            return self.ids[piece]
        return self.base + ord(piece) if len(piece) == 1 else None

    @functools.cached_property
    def letters(self) -> np.ndarray:
        """Symbol of each code point."""
        table = np.arange(0x110000, dtype=np.int64) + self.base
        for piece, i in self.ids.items():
            if len(piece) == 1:
                table[ord(piece)] = i
        table[ord(" ")] = table[ord(MARK)]
        return table

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging; rank NONE where there is no such piece."""
        key = left << 32 | right
        rank, made = np.full(len(key), NONE), np.zeros(len(key), dtype=np.int64)
        maybe = np.flatnonzero(self.seen[self._slot(key)])
        at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == key[maybe]
        rank[maybe[hit]], made[maybe[hit]] = self.ranks[at[hit]], self.made[at[hit]]
        return rank, made

    def merge_alone(self, symbols: list[int]) -> list[int]:
        """The same for one word with a heap: best score first, then leftmost."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def add(i: int) -> None:
            j = after[i]
            if j < n and (made := self.pair.get(symbols[i] << 32 | symbols[j])) is not None:
                heapq.heappush(heap, (self.rank[made], i, symbols[i], symbols[j], made))

        for i in range(n - 1):
            add(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = made, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                add(before[i])
            add(i)
        return [s for s in symbols if s >= 0]

    def merge_words(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the words that begin at `starts` of the flat array.

        Returns the merged symbols and the number of them in each word.
        """
        n_words = len(starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        word = np.repeat(np.arange(n_words), lengths)
        done_at, done_symbols = [], []
        alone = lengths > LONG_WORD
        original, original_starts = symbols, starts
        active, sym = word, symbols
        if alone.any():
            keep = ~alone[active]
            active, sym = active[keep], sym[keep]
        rank, made = self._pairs(sym, active)
        while len(sym):
            first = np.flatnonzero(np.append(True, active[1:] != active[:-1]))
            best = np.minimum.reduceat(rank, first)
            ids = active[first]
            finished = best == NONE
            if finished.any():
                out = np.repeat(finished, np.diff(np.append(first, len(sym))))
                done_at.append(active[out])
                done_symbols.append(sym[out])
                keep = ~out
                active, sym, rank, made = active[keep], sym[keep], rank[keep], made[keep]
                ids, best = ids[~finished], best[~finished]
                if not len(sym):
                    break
                first = np.flatnonzero(np.append(True, active[1:] != active[:-1]))
            # Among pieces of equal score the order of merges matters: such words are merged alone.
            odd = self.tied[best]
            spread = np.repeat(best, np.diff(np.append(first, len(sym))))
            here = rank == spread
            # Occurrences that overlap (aaa) go by turns from the left: those at even places of a run.
            at = np.flatnonzero(here)
            run = np.append(True, at[1:] != at[:-1] + 1)
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[place % 2 == 0]
            sym = sym.copy()
            sym[at] = made[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            sym, active, rank, made = sym[keep], active[keep], rank[keep], made[keep]
            new = moved[at]
            beside = np.zeros(len(sym), dtype=bool)
            beside[new] = True
            beside[np.maximum(new - 1, 0)] = True
            touched = np.flatnonzero(beside)
            self._renew(touched, sym, active, rank, made)
            # A merge must not have made a better pair than its own, or the words' other merges came too early.
            early = touched[rank[touched] < np.take(best, np.searchsorted(ids, active[touched]))]
            if odd.any() or len(early):
                again = np.union1d(ids[odd], active[early])
                alone[again] = True
                keep = ~alone[active]
                sym, active, rank, made = sym[keep], active[keep], rank[keep], made[keep]
                if len(sym):  # a dropped word must not leave a pair over the gap
                    last = np.flatnonzero(np.append(active[1:] != active[:-1], True))
                    rank[last] = NONE
        for w in np.flatnonzero(alone):
            merged = self.merge_alone(original[original_starts[w] : original_starts[w] + lengths[w]].tolist())
            done_at.append(np.full(len(merged), w))
            done_symbols.append(np.array(merged, dtype=np.int64))
        if not done_at:
            return np.zeros(0, dtype=np.int64), np.zeros(n_words, dtype=np.int64)
        at, sym = np.concatenate(done_at), np.concatenate(done_symbols)
        order = np.argsort(at, kind="stable")
        return sym[order], np.bincount(at, minlength=n_words)

    def _pairs(self, sym: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
        self._renew(np.arange(len(sym)), sym, active, rank, made)
        return rank, made

    def _renew(self, at, sym, active, rank, made) -> None:
        rank[at] = NONE
        at = at[at + 1 < len(sym)]
        at = at[active[at] == active[at + 1]]
        rank[at], made[at] = self.look_up(sym[at], sym[at + 1])

    def ids_of(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to ids: characters without a piece become their UTF-8 bytes."""
        rare = np.flatnonzero(symbols >= self.base)
        if not len(rare):
            return symbols, counts
        parts = [[self.bytes[b] for b in chr(s - self.base).encode("utf-8", "surrogatepass")] for s in symbols[rare].tolist()]
        sizes = np.ones(len(symbols), dtype=np.int64)
        sizes[rare] = [len(x) for x in parts]
        word = np.repeat(np.arange(len(counts)), counts)
        ids = np.repeat(symbols, sizes)
        ids[ids >= self.base] = [i for x in parts for i in x]
        return ids, np.bincount(word, weights=sizes, minlength=len(counts)).astype(np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbols, counts = self.ids_of(*self.merge_words(self.letters[points], np.cumsum(lengths) - lengths))
        return symbols.astype(np.int32), counts

    def encode(self, texts: list[str], kept: Kept | None = None) -> list[np.ndarray]:
        """Ids of each text, with the end id. A word runs from a space that
        follows none to the next such space: no piece reaches over that border."""
        kept = Kept() if kept is None else kept
        marked = pa.array([" " + t.replace(MARK, " ") if t else "" for t in texts], type=pa.large_string())
        words, sizes = _words(pc.split_pattern(marked, " "))
        coded = words.dictionary_encode()
        numbers = kept.numbers(coded.dictionary.to_pylist(), self)
        at = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        n = kept.counts[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = kept.ids[np.repeat(kept.starts[at] - (ends - n), n) + np.arange(total)]
        borders = np.append(0, ends)[np.append(0, np.cumsum(sizes))].tolist()
        end = np.array([self.eos], dtype=np.int32)
        return [np.append(ids[a:b], end) for a, b in zip(borders[:-1], borders[1:])]


class Kept:
    """Words met so far in a worker, with their ids in flat arrays that grow in strides.

    Cleared at `most` bytes, so that a text without spaces, whose words are long and
    met once, costs no more than others."""

    def __init__(self, most: int = KEPT_BYTES) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.size = self.used = 0
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.counts = np.zeros(1 << 14, dtype=np.int64)

    def numbers(self, words: list[str], vocabulary: Pieces) -> np.ndarray:
        known = self.number
        if self.size > self.most:  # what is needed again is found again
            self.clear()
            known = self.number
        new = [w for w in words if w not in known]
        if new:
            ids, counts = vocabulary.encode_words(new)
            first = len(known)
            known.update(zip(new, range(first, first + len(new))))
            self.starts = _put(self.starts, first, self.used + np.cumsum(counts) - counts)
            self.counts = _put(self.counts, first, counts)
            self.ids = _put(self.ids, self.used, ids)
            self.used += len(ids)
            # A word in its dictionary takes some 120 bytes and its characters.
            self.size += 120 * len(new) + 2 * sum(map(len, new)) + 4 * len(ids)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def _put(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """The array with values from a place on, twice as long if they don't fit."""
    end = at + len(values)
    if end > len(array):
        array = np.concatenate((array[:at], np.zeros(max(end, 2 * at) - at, dtype=array.dtype)))
    array[at:end] = values
    return array


def _words(parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words with their leading spaces, and the number of them in each text.

    Splitting at every space leaves empty parts where spaces stand together; a
    word takes all the spaces before it, and spaces at the end are a word.
    """
    flat = parts.flatten()
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    head = np.ones(len(flat), dtype=bool)
    head[1:] = text[1:] != text[:-1]
    empty = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    last = np.ones(len(flat), dtype=bool)
    last[:-1] = head[1:]
    # Part 0 stands before the dummy prefix and is empty; every other part had a space before it.
    gap = empty & ~head & ~last
    simple = ~head
    if not gap.any() and not (empty & ~head).any():
        words = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), flat.filter(pa.array(simple)), pa.scalar("", pa.large_string()))
        return words, np.bincount(text[simple], minlength=len(sizes))
    out, counts, run = [], np.zeros(len(sizes), dtype=np.int64), 0
    for part, t, first, final in zip(flat.to_pylist(), text.tolist(), head.tolist(), last.tolist()):
        run = 0 if first else run + 1
        if not first and (part or final):
            out.append(" " * run + part)
            counts[t] += 1
            run = 0
    return pa.array(out, type=pa.large_string()), counts


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@functools.lru_cache(maxsize=2)
def _kept(path: str) -> Kept:
    return Kept(KEPT_PIECES)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run`, after which a worker gives Arrow's unused memory back. It waits for its
    next task, while later stages of the JVM share the executor's memory with it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes; a long text is a range of its own."""
    sizes = np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, model: str, text: str = "text", decoded: bool = True) -> DataFrame:
    """`docs` without their text, with `ids` (array of int, the end id last) and
    `decoded`, the text that the library's decode gives for them.

    A null text counts as empty: the end id only. Texts of any length are encoded
    whole. Repeated rows are encoded each. Columns named ids or decoded are
    replaced; others are kept. An empty table stays empty.
    """
    kept = [c for c in docs.columns if c != text and c.lower() not in {"ids", "decoded"}]
    body = free_name(kept, "body")
    source = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].alias(body))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    schema = ", ".join([*fields, "ids array<int>", *["decoded string"] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = pieces(model), _kept(model)
        for whole in batches:
            column = whole.column(len(kept))
            for a, b in _slices(column, BATCH_BYTES):
                part = whole.slice(a, b - a)
                texts = [t or "" for t in part.column(len(kept)).to_pylist()]
                found = vocabulary.encode(texts, seen)
                offsets = np.cumsum([0, *[len(x) for x in found]]).astype(np.int32)
                columns = [part.column(i) for i in range(len(kept))]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found))))
                names = [*kept, "ids"]
                if decoded:
                    back = vocabulary.processor.decode([x.tolist() for x in found], num_threads=1)
                    columns.append(pa.array(back, type=pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(releasing(run), schema)


def digests(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): what `encode` gives, digested
    in the task so that ids needn't leave it."""
    source = docs.select(docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].alias("body"))
    schema = f"`{key}` {source.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = pieces(model), _kept(model)
        written = [str(i) for i in range(vocabulary.base)]
        for whole in batches:
            for a, b in _slices(whole.column(1), BATCH_BYTES):
                part = whole.slice(a, b - a)
                found = [x.tolist() for x in vocabulary.encode([t or "" for t in part.column(1).to_pylist()], seen)]
                back = vocabulary.processor.decode(found, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(x) for x in found], type=pa.int64()),
                        pa.array([hashlib.sha256(" ".join(map(written.__getitem__, x)).encode()).hexdigest() for x in found]),
                        pa.array([hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in back]),
                    ],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return source.mapInArrow(releasing(run), schema)
