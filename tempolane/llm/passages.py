"""Quality classifier by attention over passages (multiple-instance learning).

A document is a bag of passages of `WORDS` words. A passage's statistics and hashed
words are encoded to a short vector; gated attention weighs the passages of a document,
and the weighted sum is scored. Labels belong to documents only: which passages matter
is learned from them. Passages are found for many documents at once, over flat arrays.

Fitting uses at most `SAMPLE` labelled documents, those whose ids have the smallest
hashes, and of each at most `BAG` passages, evenly spaced; they are encoded where they
lie, and one task fits. Scoring reads all passages of all documents.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolane.llm.sentencepieces import _slices
from tempolane.sources.shared import new_path, settled

WORDS = 64  # the last passage of a document holds up to twice as many, less one
SAMPLE = 8_000  # labelled documents that are fitted on at most
BAG = 256  # passages of one of them
HASHED = 256
ENCODED, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 24, 128, 0.004, 1e-4
THRESHOLD = 0.3  # score from which a document counts as good
SLICE_BYTES = 4 << 20
STATISTICS = (
    "empty", "words", "word_bytes", "upper", "digits", "points", "marks", "symbols", "foreign", "capitals", "marked_ends",
    "different", "seen_before", "doubled", "lines", "long_words", "document",
)
WIDTH = len(STATISTICS) + HASHED

_rng = np.random.default_rng(11)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_BYTE = (_rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_LOW]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_POWERS = np.cumprod(np.append(np.uint64(1), np.full(255, _BASE)), dtype=np.uint64)


def _class_table() -> np.ndarray:
    """0 gap, 1 other letter, 2 upper, 3 digit, 4 point, 5 mark, 6 symbol, 7 beyond ASCII."""
    kind = np.full(256, 6, dtype=np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 1, 2, 3, 7
    kind[[ord(c) for c in ".,;:'\"()-"]] = 4
    kind[[ord(c) for c in "!?"]] = 5
    return kind


_KIND = _class_table()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """([passages, WIDTH], passages of each text); a text without words has one."""
    flat = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    kind = _KIND[flat]
    word = kind > 0
    starts = np.flatnonzero(word & np.append(True, ~word[:-1]))
    stops = np.flatnonzero(word & np.append(~word[1:], True)) + 1
    doc = np.searchsorted(ends, starts, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    bags = np.maximum(n_words // WORDS, 1)
    first_word, first_bag = np.cumsum(n_words) - n_words, np.cumsum(bags) - bags
    total = int(bags.sum())
    out = np.zeros((total, WIDTH), dtype=np.float32)
    bag_doc = np.repeat(np.arange(len(texts)), bags)
    out[:, 16] = np.log1p(n_words[bag_doc]) / 10
    if not len(starts):
        out[:, 0] = 1
        return out, bags
    place = np.arange(len(starts)) - first_word[doc]
    passage = first_bag[doc] + np.minimum(place // WORDS, bags[doc] - 1)
    sums = lambda x: np.bincount(passage, weights=x, minlength=total)
    within = lambda x: np.add.reduceat(x, starts, dtype=np.int64)
    n, size = np.bincount(passage, minlength=total), stops - starts
    some, bytes_ = np.maximum(n, 1), np.maximum(sums(size), 1)
    out[:, 0] = n == 0
    out[:, 1] = np.log1p(n) / 5
    out[:, 2] = sums(size) / some / 10
    for at, k in ((3, 2), (4, 3), (5, 4), (6, 5), (7, 6), (8, 7)):
        out[:, at] = sums(within(kind == k)) / bytes_
    out[:, 9] = sums(kind[starts] == 2) / some
    last = kind[stops - 1]
    out[:, 10] = sums((last == 5) | (last == 6)) / some
    # Words by a polynomial of their bytes; of what is beyond 256 bytes, the sum.
    offset = np.minimum(np.arange(len(flat)) - np.repeat(starts, np.diff(np.append(starts, len(flat)))), 255) if starts[0] == 0 else None
    if offset is None:
        offset = np.zeros(len(flat), dtype=np.int64)
        offset[starts[0]:] = np.minimum(np.arange(starts[0], len(flat)) - np.repeat(starts, np.diff(np.append(starts, len(flat)))), 255)
    parts = _BYTE[flat] * _POWERS[offset]
    parts[~word] = 0
    hashes = _mixed(np.add.reduceat(parts, starts) + size.astype(np.uint64) * _MIX)
    out[:, 11] = _firsts(passage, hashes, total) / some
    after = lambda k: np.append(hashes, np.zeros(k, dtype=np.uint64))[k:]
    three = _mixed(_mixed(hashes * _BASE + after(1)) * _BASE + after(2))
    whole = place + 3 <= n_words[doc]
    again = np.zeros(len(hashes), dtype=bool)
    again[whole] = _again(doc[whole], three[whole])
    out[:, 12] = sums(again) / some
    out[:, 13] = sums(np.append(False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]))) / some
    breaks = np.setdiff1d(np.flatnonzero(flat == 10), ends - 1, assume_unique=True)
    before = np.searchsorted(starts, breaks) - 1  # the word before a line's end, if its text has one
    own = (before >= 0) & (doc[before] == np.searchsorted(ends, breaks, side="right"))
    out[:, 14] = np.bincount(passage[before[own]], minlength=total) / some
    out[:, 15] = sums(size > 20) / some
    cells = np.bincount(passage * HASHED + (hashes >> np.uint64(56)).astype(np.int64), minlength=total * HASHED)
    out[:, len(STATISTICS):] = np.sqrt(cells.reshape(total, HASHED) / some[:, None])
    return out, bags


def _again(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a value stood before in its group; groups ascend."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    found = np.zeros(len(value), dtype=bool)
    found[order[1:]] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return found


def _firsts(group: np.ndarray, value: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount(group[~_again(group, value)], minlength=groups)


# --- the network ---------------------------------------------------------------------

SHAPES = {
    "W": (WIDTH, ENCODED), "b": (ENCODED,), "V": (ENCODED, ATTENTION), "U": (ENCODED, ATTENTION), "w": (ATTENTION,),
    "c": (ENCODED,), "d": (1,),
}


def initial(seed: int = 3) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    p = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) if k in "WVUwc" else np.zeros(s) for k, s in SHAPES.items()}
    # To begin with, a statistic counts as much as all hashed words together.
    p["W"][: len(STATISTICS)] *= 4
    return p


def forward(p: dict, x: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logits of bags of standardized passages; the rest is for `backward`."""
    starts = np.cumsum(bags) - bags
    e = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(e @ p["V"]), 0.5 + 0.5 * np.tanh(0.5 * (e @ p["U"]))
    raw = (t * s) @ p["w"]
    power = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), bags))
    weight = power / np.repeat(np.add.reduceat(power, starts), bags)
    z = np.add.reduceat(weight[:, None] * e, starts, axis=0)
    return z @ p["c"] + p["d"][0], (starts, e, t, s, weight, z)


def backward(p: dict, x: np.ndarray, bags: np.ndarray, kept: tuple, slope: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient, given the derivative by each logit."""
    starts, e, t, s, weight, z = kept
    dz = np.repeat(slope[:, None] * p["c"], bags, axis=0)
    by_weight = (dz * e).sum(1)
    raw = weight * (by_weight - np.repeat(np.add.reduceat(weight * by_weight, starts), bags))
    gate = raw[:, None] * p["w"]
    dt, ds = gate * s * (1 - t * t), gate * t * s * (1 - s)
    de = weight[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T
    pre = de * (1 - e * e)
    return {
        "W": x.T @ pre, "b": pre.sum(0), "V": e.T @ dt, "U": e.T @ ds, "w": (t * s).T @ raw, "c": z.T @ slope, "d": np.array([slope.sum()]),
    }


def fit(x: np.ndarray, bags: np.ndarray, labels: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """The network, with `mean` and `scale` of the inputs and the `shift` of its logits
    by which `THRESHOLD` parts the labels best. Labels of one kind give none: `d` alone."""
    p = initial(seed)
    n_dense = len(STATISTICS)
    p["mean"], p["scale"] = np.zeros(WIDTH), np.ones(WIDTH)
    if not len(labels) or labels.min() == labels.max():
        return {**{k: v * 0 for k, v in p.items()}, "shift": np.zeros(1)}
    p["mean"][:n_dense] = x[:, :n_dense].mean(0)
    p["scale"][:n_dense] = x[:, :n_dense].std(0) + 1e-3
    x = ((x - p["mean"]) / p["scale"]).astype(np.float32)
    share = labels.mean()
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    first = np.cumsum(bags) - bags
    moments = {k: [np.zeros(s), np.zeros(s)] for k, s in SHAPES.items()}
    draw, step = np.random.default_rng(seed), 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            own = bags[chosen]
            rows = np.repeat(first[chosen] - np.cumsum(own) + own, own) + np.arange(own.sum())
            part = x[rows]
            logit, kept = forward(p, part, own)
            slope = balance[chosen] * (0.5 + 0.5 * np.tanh(0.5 * logit) - labels[chosen]) / len(chosen)
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, g in backward(p, part, own, kept, slope).items():
                g = g + DECAY * p[k]
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[k] = p[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    logit, _ = forward(p, x, bags)
    p["shift"] = np.array([np.log(THRESHOLD / (1 - THRESHOLD)) - _best_cut(logit, labels, balance)])
    return p


def _best_cut(logit: np.ndarray, labels: np.ndarray, balance: np.ndarray) -> float:
    """The logit that parts the labels best, both kinds counting alike: the middle
    between the two values there."""
    order = np.argsort(logit, kind="stable")
    gain = np.cumsum(np.where(labels[order] == 1, -balance[order], balance[order]))
    at = int(np.argmax(gain))
    low = logit[order[at]]
    return float((low + logit[order[min(at + 1, len(order) - 1)]]) / 2)


def scores(p: dict, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
    if "shift" not in p or not len(bags):
        return np.zeros(len(bags))
    logit, _ = forward(p, (x - p["mean"]) / p["scale"], bags) if p["scale"].any() else (np.zeros(len(bags)), None)
    return 0.5 + 0.5 * np.tanh(0.5 * (logit + p["shift"][0]))


# --- in Spark ------------------------------------------------------------------------


def _packed(p: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **p)
    return out.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never fitted on; a null key is one of them."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _encode_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in _slices(batch.column(2), SLICE_BYTES):
            part = batch.slice(a, b - a)
            x, bags = passages([t or b"" for t in part.column(2).to_pylist()])
            rows, at = [], 0
            for n in bags.tolist():
                chosen = np.unique(np.linspace(0, n - 1, min(n, BAG)).astype(np.int64))
                rows.append(x[at + chosen].astype("<f2").tobytes())
                at += n
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rows, pa.binary())], ["place", "label", "bag"])


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labels, parts = [], []
    for batch in batches:
        labels += batch.column(1).to_pylist()
        parts += [np.frombuffer(v.as_py(), dtype="<f2").reshape(-1, WIDTH) for v in batch.column(2)]
    x = np.concatenate(parts).astype(np.float32) if parts else np.zeros((0, WIDTH), dtype=np.float32)
    found = fit(x, np.array([len(v) for v in parts], dtype=np.int64), np.array(labels, dtype=np.float64))
    yield pa.RecordBatch.from_arrays([pa.array([_packed(found)], pa.binary())], ["model"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text") -> dict[str, np.ndarray]:
    """Parameters fitted on labelled documents that aren't held out.

    Null ids and qualities are left out, of repeated labels the lowest counts, and of
    rows with one id the text with the smallest hash. Without labels of both kinds
    every document scores 0.5."""
    own = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out())
    own = own.groupBy("doc_id").agg(F.min("quality").alias("label")).withColumn("place", F.xxhash64("doc_id"))
    own = own.orderBy("place", "doc_id").limit(sample).withColumnRenamed("doc_id", "label_id")
    body = F.col(f"`{text}`").cast("binary").alias("body")
    rows = docs.select("doc_id", body).join(F.broadcast(own), F.col("doc_id") == F.col("label_id"))  # at most `sample` rows
    rows = rows.groupBy("place", "label", "doc_id").agg(F.min_by("body", F.xxhash64("body")).alias("body"))
    coded = rows.select("place", (F.col("label") == 1).cast("int").alias("label"), "body").mapInArrow(_encode_sample, "place long, label int, bag binary")
    coded = settled(coded, new_path(docs.sparkSession, "bags"))
    # The bags of the sample in one task: its size is bounded by `sample` and `BAG`.
    model = coded.repartition(1).sortWithinPartitions("place").mapInArrow(_fit_rows, "model binary").first()
    if model is None:  # Spark may leave out the task of an empty table
        return fit(np.zeros((0, WIDTH), dtype=np.float32), np.zeros(0, dtype=np.int64), np.zeros(0))
    return _unpacked(bytes(model["model"]))


def _score_rows(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p = {k: v.astype(np.float32) if k in SHAPES else v for k, v in _unpacked(sent.value).items()}
    for batch in batches:
        kept, texts = batch.columns[:-1], batch.column(batch.num_columns - 1)
        found = []
        for a, b in _slices(texts, SLICE_BYTES):
            x, bags = passages([t or b"" for t in texts[a:b].to_pylist()])
            found.append(scores(p, x, bags))
        # Sums depend on neighbours in their last digits.
        score = np.round(np.concatenate(found).astype(np.float64), 9) if found else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], names=[*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """`docs` with held_out, score and predicted; columns of these names are replaced.

    Null and empty texts are a passage without words and scored like others. Repeated
    rows are scored each; an empty table stays empty."""
    new = {"held_out", "score", "predicted"}
    kept = [c for c in docs.columns if c.lower() not in new]
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(_packed(model))
    # By place, so that a column may have any name; the text goes along as bytes.
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").cast("binary").alias("body"))
    schema = ", ".join([f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)] + ["score double"])
    found = rows.mapInArrow(functools.partial(_score_rows, sent), schema)
    found = found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "score")
    return found.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= THRESHOLD).cast("int")}).select(*[F.col(f"`{c}`") for c in kept], "held_out", "score", "predicted")
