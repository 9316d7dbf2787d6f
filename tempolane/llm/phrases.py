"""Collocations: phrases whose words stand together more often than their parts explain.

Words that are frequent enough get numbers, and texts become arrays of them, where 0
stands for the end of a piece or a rarer word. n-grams are counted level by level in
quotient filters: a task merges what it has counted and sends a filter a block of
quotients, a block's filters are merged in one task. The permuted n-grams fill blocks
evenly, however often a phrase stands, and the number of blocks grows with the words.
A longer n-gram is counted only where both shorter ones in it are frequent; tasks know
that from a filter of them, which is sent while it is short (`SENT_GRAMS`). Beyond that
all are counted, with the same results.

The arrays are cut at their breaks and stored as bytes: whole ones of some MB would pass
through the memory of an executor in many copies, as rows, columns and batches.

The dictionary is sent to tasks up to `SENT_WORDS` bytes. Beyond, each slice of texts
sends its different words with their places, joins the dictionary, and is put together
again.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolane.llm.quotient import Packing, QuotientFilter, blocks, merged
from tempolane.llm.sentencepieces import _slices, releasing
from tempolane.sources.shared import new_path, settled

# The ends of pieces.
ENDS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 5
LEAST = 100
TOP = 2000
SLICE_BYTES = 4 << 20
ROW_IDS = 1 << 12  # numbers from which a row of texts is cut at a break
GATHERED = 1 << 17  # numbers of rows that are counted together
HELD_WORDS = 400_000  # different words a task counts before it sends them
HELD_GRAMS = 1_500_000  # n-grams a task counts before it sends them
SENT_WORDS = 64 << 20
SENT_GRAMS = 4_000_000
BLOCK_WORDS = 2_000_000  # words of the corpus a block of quotients

_TABLE = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else 10 if b in ENDS else 32 if b == 9 else b for b in range(256))


def _words(text: bytes | None) -> list[bytes]:
    """The words of a text, with a line feed between pieces."""
    if not text:
        return []
    return [w for w in text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ") if w]


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def send():
        for lang, counter in held.items():
            counter.pop(b"\n", None)
            if counter:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())],
                    ["lang", "word", "f"],
                )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.setdefault(lang, Counter()).update(_words(text.as_py()))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from send()
    yield from send()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word in bytes, f) of all words."""
    counted = _source(docs).mapInArrow(releasing(_count_words), "lang string, word binary, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _numbered(words: DataFrame) -> DataFrame:
    """(id, lang, word, f): numbers from 1, in ranges that are counted first."""
    spark = words.sparkSession

    def places(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(at, at + n))], ["lang", "word", "f", "part", "at"]
            )
            at += n

    ranged = words.repartitionByRange("lang", "word").sortWithinPartitions("lang", "word")
    ranged = settled(ranged.mapInArrow(releasing(places), "lang string, word binary, f long, part int, at long"), new_path(spark, "places"))
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = ranged.join(F.broadcast(starts), F.col("part") == F.col("p"))
    return rows.select((F.col("start") + F.col("at") + 1).alias("id"), "lang", "word", "f")


PIECES = "width int, ids binary"


def _ids_sent(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to arrays of numbers, a row a slice, with the dictionary at hand."""
    known = sent.value
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for a, b in _slices(texts, SLICE_BYTES):
            ids: list[int] = []
            for lang, text in zip(langs[a:b], texts[a:b].to_pylist()):
                own = known.get(lang)
                if own and text:
                    get = own.get
                    ids += [get(w, 0) for w in _words(text)]
                    ids.append(0)
            yield _ids_batch(ids)


def _ids_batch(ids) -> pa.RecordBatch:
    """Rows (width, ids): the numbers of a slice as bytes, cut at breaks."""
    flat = np.asarray(ids, dtype=np.int64)
    # Of several breaks one is enough.
    flat = flat[np.append(True, (flat[1:] != 0) | (flat[:-1] != 0))[: len(flat)]]
    width = 4 if not len(flat) or flat.max() < 1 << 31 else 8
    breaks = np.flatnonzero(flat == 0) + 1
    cuts = [0]
    while len(flat) - cuts[-1] > ROW_IDS:
        i = np.searchsorted(breaks, cuts[-1] + ROW_IDS)
        if i == len(breaks) or breaks[i] == len(flat):
            break
        cuts.append(int(breaks[i]))
    stored = flat.astype(f"<i{width}")
    rows = [stored[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(flat)])]
    return pa.RecordBatch.from_arrays([pa.array([width] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["width", "ids"])


def _slice_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, size, lang, word, places): the different words of each slice."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1)
        for a, b in _slices(texts, SLICE_BYTES):
            places: dict[tuple[str, bytes], list[int]] = {}
            at = 0
            for lang, text in zip(langs[a:b], texts[a:b].to_pylist()):
                for w in _words(text):
                    if w != b"\n":
                        places.setdefault((lang, w), []).append(at)
                    at += 1
                at += 1
            n, name = len(places), (part << 32) + number
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.int64()), pa.array([at] * n, pa.int64()), pa.array([k[0] for k in places], pa.string()),
                 pa.array([k[1] for k in places], pa.binary()), pa.array(list(places.values()), pa.list_(pa.int32()))],
                ["slice", "size", "lang", "word", "places"],
            )


def _ids_joined(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """The same arrays by a join with the dictionary."""
    spark = docs.sparkSession
    rows = _source(docs).mapInArrow(releasing(_slice_words), "slice long, size long, lang string, word binary, places array<int>")
    rows = settled(rows, new_path(spark, "slices"))
    known = frequent.select("id", F.col("lang").alias("l"), F.col("word").alias("w"))
    met = rows.join(known, (F.col("lang") == F.col("l")) & (F.col("word") == F.col("w"))).select("slice", "size", "id", "places")

    def put(batches):
        at, flat = None, None
        for batch in batches:
            names, sizes, ids = (batch.column(i).to_pylist() for i in range(3))
            for i in range(batch.num_rows):
                if names[i] != at:
                    if at is not None:
                        yield _ids_batch(flat)
                    at, flat = names[i], np.zeros(sizes[i], dtype=np.int64)
                flat[batch.column(3)[i].values.to_numpy()] = ids[i]
        if at is not None:
            yield _ids_batch(flat)

    return met.repartition("slice").sortWithinPartitions("slice").mapInArrow(releasing(put), PIECES)


def _grams(ids: np.ndarray, k: int, shorter: tuple[Packing, QuotientFilter] | None) -> np.ndarray:
    """Places where n-grams of `k` begin whose words, and whose n-grams of one word
    less, are frequent."""
    if len(ids) < k:
        return np.zeros(0, dtype=np.int64)
    good = ids > 0
    fits = good[: len(ids) - k + 1].copy()
    for j in range(1, k):
        fits &= good[j : len(ids) - k + 1 + j]
    if shorter is None:
        return np.flatnonzero(fits)
    packing, known = shorter
    need = np.zeros(len(ids) - k + 2, dtype=bool)
    need[:-1] |= fits
    need[1:] |= fits
    at = np.flatnonzero(need)
    need[at] = known.look_up(packing.permute(packing.pack(ids, at))) > 0
    return np.flatnonzero(fits & need[:-1] & need[1:])


def _gathered(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The numbers of several rows each, with breaks between rows."""
    parts, size = [], 0
    for width, data in zip(batch.column(0).to_pylist(), batch.column(1)):
        parts += [np.frombuffer(data.as_buffer(), dtype=f"<i{width}"), np.zeros(1, dtype=np.int32)]
        size += len(parts[-2])
        if size >= GATHERED:
            yield np.concatenate(parts).astype(np.int64)
            parts, size = [], 0
    if parts:
        yield np.concatenate(parts).astype(np.int64)


def _whole(held: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Everything that is held as one; nothing is held then, so that parts and the
    whole don't stand in memory together."""
    limbs = [np.concatenate(x) for x in zip(*(h[0] for h in held))]
    counts = np.concatenate([h[1] for h in held])
    held.clear()
    return merged(limbs, counts)


def _count_grams(k: int, bits: int, prefix: int, sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, filter): what the slices of a task hold, merged."""
    packing = Packing(k, bits)
    shorter = None
    if sent is not None:
        before = Packing(k - 1, bits)
        shorter = before, QuotientFilter.from_bytes(sent.value, before.widths, 0)
    held: list[tuple[list[np.ndarray], np.ndarray]] = []

    def send():
        rows = list(blocks(packing, prefix, *_whole(held)))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([f.to_bytes() for _, f in rows], pa.binary())], ["block", "filter"])

    for batch in batches:
        for ids in _gathered(batch):
            # Stretches of a long text share what lies across their border.
            for a in range(0, len(ids), HELD_GRAMS // 2):
                part = ids[a : a + HELD_GRAMS // 2 + k - 1]
                at = _grams(part, k, shorter)
                if len(at):
                    limbs = packing.permute(packing.pack(part, at))
                    held.append(merged(limbs, np.ones(len(at), dtype=np.int64)))
                if sum(len(h[1]) for h in held) > HELD_GRAMS:
                    held.append(_whole(held))
                    if len(held[0][1]) > HELD_GRAMS // 2:
                        yield from send()
    if held:
        yield from send()


def _merge_blocks(k: int, bits: int, prefix: int, least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters in order of block to the n-grams that are frequent."""
    packing = Packing(k, bits)
    block, held, size = None, [], 0

    def done():
        limbs, counts = _whole(held)
        often = counts >= least
        ids = packing.unpack(packing.restore([x[often] for x in limbs]))
        cuts = np.arange(0, ids.size + 1, k, dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.reshape(-1))), pa.array(counts[often])], ["ids", "f"])

    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if name != block and held:
                yield done()
                size = 0
            block = name
            found = QuotientFilter.from_bytes(data.as_py(), packing.widths, prefix)
            held.append((found.limbs, found.counts))
            size += len(found)
            if size > HELD_GRAMS and len(held) > 1:
                held.append(_whole(held))
                size = len(held[0][1])
    if held:
        yield done()


def _filter_of(frequent: DataFrame, k: int, bits: int) -> bytes:
    """A filter of n-grams that are few enough to be sent to tasks."""
    packing = Packing(k, bits)
    table = frequent.select("ids").toArrow()
    ids = table.column(0).combine_chunks().flatten().to_numpy().reshape(-1, k)
    flat = np.ascontiguousarray(ids).reshape(-1)
    limbs = packing.permute(packing.pack(flat, np.arange(0, len(flat), k)))
    return QuotientFilter(packing.widths, 0, *merged(limbs, np.ones(len(ids), dtype=np.int64))).to_bytes()


def _level(pieces: DataFrame, k: int, bits: int, prefix: int, least: int, shorter: DataFrame | None, sent_grams: int) -> DataFrame:
    """(ids, f) of the frequent n-grams of `k` words."""
    spark = pieces.sparkSession
    sent = None
    if shorter is not None and shorter.count() <= sent_grams:
        sent = spark.sparkContext.broadcast(_filter_of(shorter, k - 1, bits))
    prefix = min(prefix, Packing(k, bits).widths[0])
    counted = pieces.mapInArrow(releasing(functools.partial(_count_grams, k, bits, prefix, sent)), "block int, filter binary")
    laid = counted.repartition("block").sortWithinPartitions("block")
    found = laid.mapInArrow(releasing(functools.partial(_merge_blocks, k, bits, prefix, least)), "ids array<long>, f long")
    return settled(found, new_path(spark, "grams"))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sent_words: int = SENT_WORDS, sent_grams: int = SENT_GRAMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grams, words, sizes): (ids, f) of all phrases of 1 to `longest` words with
    f >= least, (id, lang, word, f) of their words, and (lang, n) of all words."""
    spark = docs.sparkSession
    counts = settled(word_counts(docs), new_path(spark, "words"))
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = settled(_numbered(counts.filter(F.col("f") >= least)), new_path(spark, "dictionary"))
    shape = frequent.agg(F.max("id").alias("most"), F.sum(F.octet_length("word") + 100).alias("bytes")).first()
    bits = max(1, int(shape["most"] or 0).bit_length())
    total = counts.agg(F.sum("f")).first()[0] or 0
    prefix = max(4, (total // BLOCK_WORDS).bit_length())
    if (shape["bytes"] or 0) <= sent_words:
        known: dict[str, dict[bytes, int]] = {}
        for r in frequent.select("lang", "word", "id").toLocalIterator():
            known.setdefault(r["lang"], {})[bytes(r["word"])] = r["id"]
        pieces = _source(docs).mapInArrow(releasing(functools.partial(_ids_sent, spark.sparkContext.broadcast(known))), PIECES)
    else:
        pieces = _ids_joined(docs, frequent)
    pieces = settled(pieces, new_path(spark, "pieces"))
    levels = [frequent.select(F.array("id").alias("ids"), "f")]
    for k in range(2, longest + 1):
        levels.append(_level(pieces, k, bits, prefix, least, levels[-1] if k > 2 else None, sent_grams))
    return functools.reduce(DataFrame.union, levels), frequent, sizes


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, **limits) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` of each language.

    A null text has no words, a null language is `und`. Repeated rows count each
    time. Ties rank by the bytes of the phrase. Only `lang` and `text` are read; a
    table without frequent phrases gives an empty result.
    """
    grams, words, sizes = phrase_counts(docs, least, longest, **limits)
    spark: SparkSession = docs.sparkSession
    size = F.size("ids")
    cuts = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    rows = grams.filter(size > 1).select("ids", F.col("f").alias("a"), cuts)
    rows = rows.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("x"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("y"))
    rows = rows.join(grams.select(F.col("ids").alias("x"), F.col("f").alias("l")), "x").join(grams.select(F.col("ids").alias("y"), F.col("f").alias("r")), "y")
    first = words.select(F.col("id").alias("first"), "lang")
    rows = rows.join(first, F.get("ids", F.lit(0)) == F.col("first")).join(F.broadcast(sizes), "lang")  # a row a language
    big = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.call_function("div", (big("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(24,0)") * F.col("n").cast("decimal(14,0)"),
                            F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)"))
    rows = rows.withColumn("score", score).groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # Of longer phrases those that stand as often as a phrase in them take its place.
    size = F.size("ids")
    parts = F.expr("flatten(transform(sequence(2, size(ids) - 1), k -> transform(sequence(1, size(ids) - k + 1), i -> slice(ids, i, k))))")
    inside = grams.filter(size > 2).select(F.explode(parts).alias("part"), F.col("f").alias("g")).groupBy("part").agg(F.max("g").alias("g"))
    rows = rows.join(inside, F.col("ids") == F.col("part"), "left").filter("g IS NULL OR 100 * g < 100 * a")
    rows = settled(rows.select("lang", "ids", "a", "n", "cut"), new_path(spark, "candidates"))
    spelled = rows.select("ids", F.posexplode("ids").alias("at", "w")).join(words.select("id", "word"), F.col("w") == F.col("id"))
    spelled = spelled.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("s"))  # at most `longest` words
    phrase = F.array_join(F.transform("s", lambda s: s["word"].cast("string")), " ")
    rows = rows.join(spelled.select("ids", phrase.alias("phrase")), "ids")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
