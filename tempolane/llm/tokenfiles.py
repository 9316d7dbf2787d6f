"""Token ids of documents as binary shards, a wavelet matrix each."""

from __future__ import annotations

import array
import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolane.llm.files import MOST_TASKS, Committed, read_range
from tempolane.llm.sentencepieces import BATCH_BYTES, KEPT_BYTES, Kept, _slices
from tempolane.sources.shared import settled

SHARD_TOKENS = 4_000_000
END = 0


class Library:
    """The tokenizers library, each different stretch of text encoded once.

    A byte-level BPE never merges over the border before a space that a character
    other than white space follows, so texts are cut there. Texts that hold one
    of the added tokens' strings go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept, self.parts, self.size = Kept(), {}, 0
        # How a byte-level BPE cuts words, and writes bytes as characters.
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.space = self.shown[32]

    def _part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            # The model is the library's; words are cut here once, not by each call.
            word = part[part[:1] == " " :]
            plain = word.isascii() and word.isalnum()
            shown = (part if word is part else self.space + word) if plain else part.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.shown)
            # Bytes, which Python's collector has not to look through.
            ids = self.parts[part] = array.array("i", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
            self.size += 200 + 2 * len(part) + len(ids)
        return ids

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.size > KEPT_BYTES:
            self.parts.clear()
            self.size = 0
        cut, part = self.cut, self._part
        # Letters after a space, as most words are, are one part.
        found = [part(x) if x[:1] == " " and x[1:].isalpha() and x.isascii() else b"".join(map(part, cut(x))) for x in words]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        return np.frombuffer(b"".join(found), dtype=np.int32), counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each); the end id is part of both."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        plain = pa.array(["" if whole and i in set(whole) else t for i, t in enumerate(texts)] if whole else texts, type=pa.large_string())
        parts = pc.split_pattern(plain, " ")
        flat = parts.flatten()
        offsets = parts.offsets.to_numpy().astype(np.int64)
        head = np.zeros(len(flat), dtype=bool)
        head[offsets[:-1]] = True
        white = pc.utf8_is_space(pc.utf8_slice_codeunits(flat, 0, 1)).to_numpy(zero_copy_only=False)
        empty = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(head | ~(white | empty))
        if len(cut) < len(flat):
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.append(cut, len(flat))), flat), pa.scalar(" ", pa.large_string()))
        else:
            joined = flat
        lead = pc.if_else(pa.array(head[cut]), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
        coded = pc.binary_join_element_wise(lead, joined, pa.scalar("", pa.large_string())).dictionary_encode()
        numbers = self.kept.numbers(coded.dictionary.to_pylist(), self)
        at = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        # Words are lists of ids, the end one more; the lists of all words, one after the other.
        kept, words = self.kept, len(self.kept.number)
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.append(kept.starts[:words], (kept.used, kept.used + 1))), pa.array(np.append(kept.ids[: kept.used], np.int32(END)))
        )
        stops = np.searchsorted(cut, offsets[1:])
        at = np.insert(at, stops, words)
        result = lists.take(pa.array(at)).flatten().to_numpy()
        ends = np.cumsum(np.append(kept.counts[:words], 1)[at])[stops + np.arange(len(stops))]
        counts = np.diff(np.append(0, ends))
        if whole:
            pieces = np.split(result, ends[:-1])
            for i in whole:
                found = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                pieces[i] = np.array([*found, END], dtype=np.int32)
            result, counts = np.concatenate(pieces), np.array([len(x) for x in pieces])
        return result, counts


@functools.lru_cache(maxsize=2)
def library(path: str) -> Library:
    return Library(path)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, shard_tokens: int = SHARD_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents in ascending order of `key`; the manifest.

    Documents are range-partitioned (null keys first, repeated keys in order of
    their texts, so a repeated key can be split too) and encoded in their task,
    shard by shard: a task holds one shard. A shard is a file under a temporary
    name until it is whole. The manifest (shard, nth, part, docs, tokens, start)
    is written when all shards are, in `folder`/manifest, and names those that
    count. A null text counts as empty: the end id only. An empty table has no shard.
    """
    source = docs.select(docs[f"`{key}`"].cast("long").alias("key"), docs[f"`{text}`"].alias("body"))
    rows = source.repartitionByRange("key", F.xxhash64("body")).sortWithinPartitions("key", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tempolane.llm import wavelet

        words, part, nth = library(tokenizer), TaskContext.get().partitionId(), 0
        ids, keys, null, lengths, held = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal nth, held
            name = f"shard-{part:06d}-{nth:05d}.wm"
            sizes = np.concatenate(lengths)
            data = wavelet.dump(np.concatenate(ids), np.concatenate(keys), np.concatenate(null), sizes)
            with Committed(folder, name) as out:
                out.write(data)
            row = pa.RecordBatch.from_pylist([{"shard": name, "part": part, "nth": nth, "docs": len(sizes), "tokens": int(sizes.sum())}], schema)
            for x in (ids, keys, null, lengths):
                x.clear()
            nth, held = nth + 1, 0
            return row

        schema = pa.schema([("shard", pa.string()), ("part", pa.int64()), ("nth", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())])
        for whole in batches:
            for a, b in _slices(whole.column(1), BATCH_BYTES):
                some = whole.slice(a, b - a)
                found, sizes = words.encode([t or "" for t in some.column(1).to_pylist()])
                if held and held + len(found) > shard_tokens:
                    yield close()
                ids.append(found)
                lengths.append(sizes)
                null.append(pc.is_null(some.column(0)).to_numpy(zero_copy_only=False))
                keys.append(pc.fill_null(some.column(0), 0).to_numpy(zero_copy_only=False))
                held += len(found)
        if held:
            yield close()

    made = rows.mapInArrow(run, "shard string, part long, nth long, docs long, tokens long")
    # A row per shard: short enough for one window.
    made = settled(made, f"{folder}/made")
    before = F.sum("tokens").over(Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1))
    return settled(made.withColumn("start", F.coalesce(before, F.lit(0))).coalesce(1), f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the shards."""
    return _scan(spark, folder, manifest, False)


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """(key, start, n_tokens, ids) of every document, from the shards."""
    return _scan(spark, folder, manifest, True)


def _scan(spark: SparkSession, folder: str, manifest: DataFrame | None, with_ids: bool) -> DataFrame:
    listed = spark.read.parquet(f"{folder}/manifest") if manifest is None else manifest
    last = "ids array<int>" if with_ids else "ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tempolane.llm.wavelet import WaveletFile

        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = WaveletFile(lambda a, n, s=shard: read_range(folder, s, a, n))
                ids = found.tokens().astype("<u4")
                keys, null, lengths = found.index()
                ends = np.cumsum(lengths)
                cuts = list(zip((ends - lengths).tolist(), ends.tolist()))
                if with_ids:
                    column = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32)))
                else:
                    column = pa.array([zlib.crc32(ids[a:b]) for a, b in cuts], type=pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=null), pa.array(start + ends - lengths), pa.array(lengths), column],
                    ["key", "start", "n_tokens", last.split()[0]],
                )

    # A shard for a task, in order of their places, whatever the listing's size in bytes.
    tasks = min(MOST_TASKS, max(1, listed.count()))
    spread = listed.select("shard", "start").repartitionByRange(tasks, "start", "shard")
    return spread.mapInArrow(run, f"key long, start long, n_tokens long, {last}")
