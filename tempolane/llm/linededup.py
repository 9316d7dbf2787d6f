"""Fuzzy line dedup: one line stays of every group of similar lines in all documents.

Lines are lower-cased and trimmed; equal ones are one line, known by two 64-bit hashes.
A line's signature is the minima and maxima of hashes of all its character shingles
under several masks. Lines that agree in a pair of them are a bucket. In a bucket of
few lines all are compared. In a larger one a line first meets the first line of the
bucket, the first of those that agree in one more minimum, and its next neighbours
there in order of all others: a few pairs a line, however large the bucket. What is
then not in one group is joined exactly, so that no similar pair of a bucket is lost
(`rest_groups`): in a bucket of at most `CROWD` lines all across groups meet, in a larger
one those that share one of their rarest shingles. The Jaccard
similarity of all their character shingles decides; pairs whose parities of shingles
(`sketched`) differ in more bits than similar sets can are left out before. Similar
lines are joined by distributed union-find; of each component the first place stays,
by document and place.

Lines, buckets, joins and the rewriting of texts are column expressions. Signatures and
similarities are computed over flat numpy arrays in Arrow batches: as expressions they
were within results, but not within the limits (README has the figures). Characters are
UTF-16 units. Tables that may be sent to all tasks are measured first (`SENT_BYTES`);
beyond, they are joined by a shuffle.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolane.llm.components import components
from tempolane.llm.sentencepieces import _slices, releasing
from tempolane.llm.text import free_name
from tempolane.sources.shared import new_path, settled

SHINGLE = 10
SIMILAR = 0.8
MASKED = 6  # masks, each of which gives a minimum and a maximum
NEIGHBOURS = 2
CROWD = 4096  # lines that are ordered together in one task, or compared by parities in one bucket
FEW = 16  # lines of a bucket that are all compared with each other
SENT_BYTES = 32 << 20
SLICE_BYTES = 256 << 10  # of lines, whose arrays of shingles stay in a processor's cache
SKETCH = [f"s{k}" for k in range(8)]
FINE = [f"f{chr(97 + k)}" for k in range(16)]  # of lines that many others meet
ORDER_LINES, ORDER_SHINGLES = 1 << 14, 1 << 17  # lines that shingles are counted in for their order, and how many have a count
_rng = np.random.default_rng(6)
_UNIT = _rng.integers(0, 1 << 63, (1 << 16) + 1, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
MASKS = _rng.integers(0, 1 << 32, MASKED, dtype=np.uint32)
MINIMA = [f"{side}{k}" for k in range(MASKED) for side in ("lo", "hi")]


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """(doc, mark, pos, line, h1, h2) of every line that isn't blank."""
    rows = docs.select(
        F.col("doc_id").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.posexplode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("pos", "line"),
    )
    rows = rows.withColumn("line", F.lower(F.trim("line"))).filter("line <> ''")
    return rows.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(7), "line")})


def _rolled(values: np.ndarray, size: int) -> np.ndarray:
    """The polynomial of each `size` consecutive values, by doubling."""
    power = lambda k: np.uint64(pow(int(_BASE), k, 1 << 64))
    part, width, found, done = values, 1, None, 0
    while True:
        if size & width:
            # `width` values stand before the `done` ones that are summed up already.
            found = part if found is None else part[: len(found) - width] * power(done) + found[width:]
            done += width
        if done == size:
            return found
        part = part[: len(part) - width] * power(width) + part[width:]
        width *= 2


def line_shingles(lines: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number in each line): the character shingle at each place of each
    line. A shorter line is one shingle, filled up by what is no character."""
    data = [x.encode("utf-16-be", "surrogatepass") for x in lines]
    n = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) // 2
    width = np.maximum(n, size)
    flat = np.frombuffer(b"".join([x.ljust(2 * size, b"\0") for x in data]), dtype=">u2").astype(np.uint16)
    if not len(flat):
        return np.zeros(0, dtype=np.uint64), n
    starts = np.cumsum(width) - width
    values = _UNIT[flat]
    for i in np.flatnonzero(n < size).tolist():
        values[starts[i] + n[i] : starts[i] + size] = _UNIT[1 << 16]
    hashes = _rolled(values, size)
    inside = np.ones(len(hashes), dtype=bool)
    inside[((starts + width)[:-1, None] - np.arange(1, size)).ravel()] = False  # over the end of a line
    hashes = hashes[inside]
    hashes = (hashes ^ (hashes >> np.uint64(30))) * _MIX
    return hashes ^ (hashes >> np.uint64(31)), width - size + 1


def _minima(lines: list[str], masks: np.ndarray) -> list[np.ndarray]:
    """Minimum and maximum, for each mask, of the masked shingle hashes of each line."""
    hashes, counts = line_shingles(lines)
    short, starts = (hashes >> np.uint64(32)).astype(np.uint32), np.cumsum(counts) - counts
    found = []
    for mask in masks:
        masked = short ^ mask
        found += [np.minimum.reduceat(masked, starts).view(np.int32), np.maximum.reduceat(masked, starts).view(np.int32)]
    return found


def signed(lines: DataFrame) -> DataFrame:
    """(h1, h2, doc, mark, pos, minima) of each line."""
    kept = ["h1", "h2", "doc", "mark", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in _slices(whole.column(5), SLICE_BYTES):
                part = whole.slice(a, b - a)
                minima = [pa.array(m) for m in _minima(part.column(5).to_pylist(), MASKS)]
                yield pa.RecordBatch.from_arrays([*part.columns[:5], *minima], [*kept, *MINIMA])

    types = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    schema = ", ".join([f"{c} {types[c]}" for c in kept] + [f"{m} int" for m in MINIMA])
    return lines.select(*kept, "line").mapInArrow(releasing(run), schema)


def _sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, line, number in each line): the different shingles, ascending in a line."""
    hashes, counts = line_shingles(lines)
    line = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, line))
    hashes, line = hashes[order], line[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1]))[: len(hashes)]
    return hashes[new], line[new], np.bincount(line[new], minlength=len(counts))


def line_hashes(texts: DataFrame) -> DataFrame:
    """(id, h): the different hashes of the shingles of lines (id, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in _slices(whole.column(1), SLICE_BYTES):
                part = whole.slice(a, b - a)
                hashes, line, _ = _sets(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(line)), pa.array(hashes.view(np.int64))], ["id", "h"])

    return texts.select("id", "line").mapInArrow(releasing(run), "id long, h long")


def first_shingles(texts: DataFrame, often: tuple[np.ndarray, np.ndarray], similar: float) -> DataFrame:
    """(id, n, place, c, h): so many of the first shingles of lines (id, line) that
    similar ones share one, in order of c, which is how often `often` (ascending
    hashes, counts) has them, and hash; n is the number of all."""
    percent = round(100 * similar, 6)
    sent = texts.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = sent.value
        for whole in batches:
            for a, b in _slices(whole.column(1), SLICE_BYTES):
                part = whole.slice(a, b - a)
                hashes, line, n = _sets(part.column(1).to_pylist())
                c = np.zeros(len(hashes), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    c = np.where(known[at] == hashes, count[at], 0)
                order = np.lexsort((hashes, c, line))
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
                # Rounded up: one shingle more costs a comparison, one less a link.
                kept = place < (np.floor(n * (100 - percent) / 100 + 1e-6).astype(np.int64) + 1)[line]
                order, place, line = order[kept], place[kept], line[kept]
                found = [n[line], place, c[order], hashes[order].view(np.int64)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(line)), *map(pa.array, found)], ["id", "n", "place", "c", "h"])

    return texts.select("id", "line").mapInArrow(releasing(run), "id long, n long, place long, c long, h long")


def sketched(texts: DataFrame, names: list[str] = SKETCH) -> DataFrame:
    """(id, line, n, sketch): lines with the number of their different shingles and the
    parities of these in 64 cells for each of `names`, a power of two. Sets that differ in
    d shingles differ in at most d cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in _slices(whole.column(1), SLICE_BYTES):
                part = whole.slice(a, b - a)
                sizes, words = parities(part.column(1).to_pylist(), len(names))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes), *map(pa.array, words)], ["id", "line", "n", *names])

    return texts.select("id", "line").mapInArrow(releasing(run), "id long, line string, n long, " + ", ".join(f"{c} long" for c in names))


def parities(lines: list[str], words: int = len(SKETCH)) -> tuple[np.ndarray, np.ndarray]:
    """(number of different shingles of each line, `words` rows of their parities as words of 64 bits)."""
    hashes, counts = line_shingles(lines)
    # A number that sorts by line and hash, of which as many of its first bits as fit.
    bits = np.uint64(max(1, len(lines)).bit_length())
    keys = np.repeat(np.arange(len(lines), dtype=np.uint64), counts) << (np.uint64(64) - bits) | hashes >> bits
    keys.sort()
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    line = (keys >> (np.uint64(64) - bits)).astype(np.int64)
    cell = ((keys << bits) >> np.uint64(65 - (64 * words).bit_length())).astype(np.int64)
    word, bit = line * words + (cell >> 6), np.uint64(1) << (cell & 63).astype(np.uint64)
    found = np.zeros(len(lines) * words, dtype=np.uint64)
    if len(word):
        new = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        found[word[new]] = np.bitwise_xor.reduceat(bit, new)
    return np.bincount(line, minlength=len(lines)), np.ascontiguousarray(found.view(np.int64).reshape(-1, words).T)


def _near(similar: float, names: list[str] = SKETCH) -> Column:
    """Whether sets (n, sketch) and (n2, sketch2) may be similar; rounded up."""
    percent = round(100 * similar, 6)
    apart = functools.reduce(operator.add, [F.bit_count(F.col(c).bitwiseXOR(F.col(c + "2"))) for c in names])
    n, n2 = F.col("n"), F.col("n2")
    sizes = 100 * F.least(n, n2) + 1e-6 >= percent * F.greatest(n, n2)
    return sizes & ((100 + percent) * apart <= (100 - percent) * (n + n2) + 1e-6)


def near_pairs(pairs: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Those pairs (a, b) whose lines (id, n, sketch) may be similar."""
    one = texts.select(F.col("id").alias("x"), "n", *SKETCH)
    two = texts.select(F.col("id").alias("y"), *[F.col(c).alias(c + "2") for c in ("n", *SKETCH)])
    met = pairs.join(_measured(one, 240), F.col("a") == F.col("x")).join(_measured(two, 240), F.col("b") == F.col("y"))
    return settled(met.filter(_near(similar)).select("a", "b"), new_path(pairs.sparkSession, "near"))


def _measured(df: DataFrame, row_bytes: Column | int) -> DataFrame:
    """A written table, marked for broadcast if it is small."""
    size = df.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).first()[0] or 0
    return F.broadcast(df) if size <= SENT_BYTES else df


def buckets(signatures: DataFrame) -> DataFrame:
    """(id, band, next, then, first, size) of lines (id, minima) that agree with another
    one in a band: its next minimum, all others, and the first line and size of the bucket."""
    spark = signatures.sparkSession
    order = [*MINIMA[0::2], *MINIMA[1::2]]  # so that a mask's own two stand apart
    minimum = lambda k: F.col(order[k % len(order)])
    bands = F.array(*[
        F.struct(F.xxhash64(F.lit(b), minimum(b), minimum(b + MASKED + 1)).alias("band"), minimum(b + 1).alias("next"),
                 F.array(*[minimum(b + j) for j in range(2, len(order))]).alias("then"))
        for b in range(MASKED)
    ])
    spread = signatures.select("id", F.explode(bands).alias("x")).select("id", "x.*")
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first")).filter("size > 1")
    shared = settled(shared.select(F.col("band").alias("k"), "first", "size"), new_path(spark, "buckets"))
    return spread.join(_measured(shared, 32), F.col("band") == F.col("k")).drop("k")


def _pair(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).alias("p")


def candidates(met: DataFrame) -> DataFrame:
    """(a, b): different lines that should be compared, of `buckets`: all pairs of a
    bucket of at most `FEW` lines, and a few for each line of larger ones, whose
    other pairs `rest_groups` finds."""
    spark = met.sparkSession
    few = met.filter(F.col("size") <= FEW).groupBy("band").agg(F.collect_list("id").alias("ids"))
    few = few.select("ids", F.explode("ids").alias("a")).select("a", F.explode("ids").alias("b")).filter("a < b")
    large = met.filter(F.col("size") > FEW)
    inner = large.groupBy("band", "next").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("inner")).filter("n > 1")
    inner = settled(inner.select(F.col("band").alias("k"), F.col("next").alias("kn"), "n", "inner"), new_path(spark, "inner"))
    close = large.join(_measured(inner, 32), (F.col("band") == F.col("k")) & (F.col("next") == F.col("kn")))
    crowd = F.pmod(F.xxhash64(F.lit(9), "id"), F.ceil(F.col("n") / CROWD)).alias("crowd")
    close = close.select("id", "band", "next", "then", "inner", crowd)
    beside = Window.partitionBy("band", "next", "crowd").orderBy("then", "id")
    id_ = F.col("id")
    close = close.select("id", "inner", *[F.lead("id", j).over(beside).alias(f"n{j}") for j in range(1, NEIGHBOURS + 1)])
    found = large.select(_pair(id_, F.col("first"))).union(
        close.select(F.explode(F.array(_pair(id_, F.col("inner")), *[_pair(id_, F.coalesce(f"n{j}", "id")) for j in range(1, NEIGHBOURS + 1)])).alias("p"))
    )
    return few.union(found.select("p.a", "p.b").filter("a <> b")).distinct()


def _joined(groups: DataFrame, named: DataFrame, found: DataFrame) -> DataFrame:
    """`groups` after links (src, dst) between lines (id, comp), also of none so far."""
    spark = groups.sparkSession
    one, two = (named.select(F.col("id").alias(f"i{k}"), F.col("comp").alias(f"c{k}")) for k in "12")
    edges = found.join(one, F.col("src") == F.col("i1")).join(two, F.col("dst") == F.col("i2")).select(F.col("c1").alias("src"), F.col("c2").alias("dst"))
    merged = components(edges).select(F.col("node").alias("m"), F.col("component").alias("to"))
    merged = _measured(settled(merged, new_path(spark, "merged")), 24)
    own = groups.join(merged, F.col("component") == F.col("m"), "left").select("node", F.coalesce("to", "component").alias("component"))
    # A line that was in no group has its own id for one.
    alone = named.filter("alone").join(merged, F.col("comp") == F.col("m")).select(F.col("id").alias("node"), F.col("to").alias("component"))
    return settled(own.union(alone), new_path(spark, "groups"))


def _named(lines: DataFrame, groups: DataFrame) -> DataFrame:
    """`lines` with the group of each, `comp`; one that is `alone` has its own id for one."""
    found = lines.join(_measured(groups, 24), F.col("id") == F.col("node"), "left")
    return found.select(*lines.columns, F.coalesce("component", "id").alias("comp"), F.col("node").isNull().alias("alone"))


def rest_groups(met: DataFrame, texts: DataFrame, groups: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """`groups` (node, component) joined by all similar pairs within `buckets` of more
    than `FEW` lines; the pairs within smaller ones have been compared.

    Only buckets of lines of several groups are left, and only pairs across groups. In
    two steps, of which the first joins most groups: the first lines of a bucket's groups
    meet, then all that are still in different ones, if sizes and parities allow for
    similar sets. No line meets more than `CROWD` of a bucket so; in larger buckets only
    those that share one of their rarest shingles meet (`shared_shingles`).
    """
    spark = met.sparkSession
    keep = lambda df, name: settled(df, new_path(spark, name))
    large = keep(_named(met.filter(F.col("size") > FEW).select("id", "band", "size"), groups), "large")
    mixed = large.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    mixed = keep(mixed.select(F.col("band").alias("k")), "mixed")
    rest = keep(large.join(_measured(mixed, 16), F.col("band") == F.col("k"), "left_semi"), "rest")
    if rest.isEmpty():
        return groups
    own = keep(rest.groupBy(F.col("id").alias("k")).agg(F.min("comp").alias("comp"), F.max("size").alias("most")), "own")
    texts = keep(texts.join(_measured(own.select("k"), 16), F.col("id") == F.col("k"), "left_semi"), "texts")
    drawn = keep(sketched(texts, FINE).select(F.col("id").alias("k"), "n", *FINE), "drawn")
    beyond = own.filter(F.col("most") > CROWD).select("k", "comp")
    shown = None if beyond.isEmpty() else shared_shingles(beyond, texts, similar)
    for heads in (True, False):
        rest = rest if heads else keep(_named(rest.select("id", "band", "size"), groups), "rest")
        lines = rest.filter(F.col("size") <= CROWD)
        if heads:
            lines = lines.groupBy("band", "comp").agg(F.min("id").alias("id"))
        now = keep(lines.join(_measured(drawn, 400), F.col("id") == F.col("k")).select("band", "comp", "id", "n", *FINE), "now")
        other = now.select(*[F.col(c).alias(c + "2") for c in now.columns])
        pairs = now.join(other, (F.col("band") == F.col("band2")) & (F.col("comp") < F.col("comp2")) & _near(similar, FINE))
        pairs = pairs.select(_pair(F.col("id"), F.col("id2"))).select("p.a", "p.b")
        if shown is not None and heads:
            least = shown.select(_pair(F.col("id"), F.col("least"))).select("p.a", "p.b").filter("a <> b").distinct()
            pairs = pairs.union(near_pairs(keep(least, "pairs"), texts, similar))
        elif shown is not None:
            pairs = pairs.union(_across(shown, rest, texts, similar))
        pairs = keep(pairs.distinct(), "pairs")
        groups = _joined(groups, rest.select("id", "comp", "alone").distinct(), keep(links(pairs, texts, similar), "links"))
    return groups


def shared_shingles(own: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(id, n, place, h, least): the first shingles that lines (k, comp) share, each with
    the first line that has it.

    Similar sets share one of their first shingles in any order, so many as may be
    missing from the other and one more. In the order taken here those that are in
    lines of one group come first, as no pair across groups shares them, then rare
    ones, by counts of groups among some of the lines.
    """
    spark = texts.sparkSession
    keep = lambda df, name: settled(df, new_path(spark, name))
    texts = keep(texts.join(_measured(own.select("k"), 16), F.col("id") == F.col("k"), "left_semi"), "texts")
    # The order needs no more than an estimate: no order loses a pair, a bad one costs comparisons.
    step = max(1, -(-own.count() // ORDER_LINES))
    some = line_hashes(texts.filter(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(step)) == 0))
    some = some.join(_measured(own, 48), F.col("id") == F.col("k")).select("h", "comp").distinct()
    some = some.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").orderBy(F.desc("c"), "h").limit(ORDER_SHINGLES).toArrow()
    known, count = (some.column(c).to_numpy().astype(t) for c, t in (("h", np.int64), ("c", np.int64)))
    order = np.argsort(known.view(np.uint64))
    shown = keep(first_shingles(texts, (known.view(np.uint64)[order], count[order]), similar), "shown")
    # Of shingles that the same lines show the first in order stands for all: if one of
    # them is the first that two lines share, it is this one.
    ids = F.bit_xor(F.xxhash64("id")).alias("ids")
    lists = shown.groupBy("h").agg(F.first("c").alias("c"), F.count(F.lit(1)).alias("m"), F.min("id").alias("least"), ids).filter("m > 1")
    # As numbers without sign, the order within a line.
    lists = lists.groupBy("m", "least", "ids").agg(F.min(F.struct("c", (F.col("h") < 0).alias("high"), "h")).alias("first"))
    lists = keep(lists.select(F.col("first.h").alias("k"), "least"), "lists")
    return keep(shown.join(_measured(lists, 48), F.col("h") == F.col("k")).select("id", "n", "place", "h", "least"), "shown")


def _across(shown: DataFrame, lines: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """(a, b): lines (id, comp) of different groups that share a shingle of `shown`, if
    what follows it and the parities of their sets allow for similar ones."""
    spark = shown.sparkSession
    keep = lambda df, name: settled(df, new_path(spark, name))
    lines = lines.select(F.col("id").alias("k"), "comp").distinct()
    now = shown.join(_measured(keep(lines, "own"), 48), F.col("id") == F.col("k")).select("id", "n", "place", "h", "comp")
    across = now.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    across = keep(across.select(F.col("h").alias("k")), "across")
    now = now.join(_measured(across, 48), F.col("h") == F.col("k"), "left_semi")
    now = keep(now.join(_measured(texts.select(F.col("id").alias("k"), *SKETCH), 240), F.col("id") == F.col("k")).drop("k"), "now")
    other = now.select(*[F.col(c).alias(c + "2") for c in now.columns])
    # What two sets share from their first common shingle on must be enough.
    percent = round(100 * similar, 6)
    left = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    enough = (100 + percent) * left + 1e-6 >= percent * (F.col("n") + F.col("n2"))
    pairs = now.join(other, (F.col("h") == F.col("h2")) & (F.col("comp") < F.col("comp2")) & enough & _near(similar))
    return pairs.select(_pair(F.col("id"), F.col("id2"))).select("p.a", "p.b")


def links(pairs: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(src, dst): pairs (a, b) whose lines (id, line) are similar."""
    one = texts.select(F.col("id").alias("x"), F.col("line").alias("one"))
    two = texts.select(F.col("id").alias("y"), F.col("line").alias("two"))
    both = _measured(pairs, 48).join(one, F.col("a") == F.col("x")).join(two, F.col("b") == F.col("y")).select("a", "b", "one", "two")
    percent = round(100 * similar, 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in _slices(whole.column(2), SLICE_BYTES):
                part = whole.slice(a, b - a)
                close = similar_lines(part.column(2).to_pylist(), part.column(3).to_pylist(), percent)
                yield part.select(["a", "b"]).filter(pa.array(close)).rename_columns(["src", "dst"])

    return both.mapInArrow(releasing(run), "src long, dst long")


def similar_lines(one: list[str], two: list[str], percent: float) -> np.ndarray:
    """Of pairs of lines, whether 100 * |both| >= percent * |either| of their sets of shingles."""
    n = len(one)
    hashes, counts = line_shingles(one + two)
    line = np.repeat(np.arange(2 * n, dtype=np.uint64), counts)
    # A number that sorts by pair, hash (as many of its first bits as fit: 48 or so) and side.
    bits = np.uint64(max(1, n).bit_length())
    side = line >= n
    pair = np.where(side, line - np.uint64(n), line)
    keys = pair << (np.uint64(64) - bits) | hashes >> (bits + np.uint64(1)) << np.uint64(1) | side
    keys.sort()
    keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    pair = (keys >> (np.uint64(64) - bits)).astype(np.int64)
    sizes = np.bincount(pair, minlength=n)
    both = np.bincount(pair[1:][keys[1:] >> np.uint64(1) == keys[:-1] >> np.uint64(1)], minlength=n)
    return 100 * both >= percent * (sizes - both)


def line_groups(docs: DataFrame, text: str = "text", similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(places, stays): (h1, h2, doc, mark, pos) of every line, and (h1, h2, doc, mark,
    pos) of each line that repeats, exactly or nearly, with the place that stays."""
    spark = docs.sparkSession
    keep = lambda df, name: settled(df, new_path(spark, name))
    every = keep(signed(_lines(docs, text)), "lines")
    places = every.select("h1", "h2", "doc", "mark", "pos")
    first = F.min(F.struct("doc", "mark", "pos")).alias("first")
    unique = keep(places.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), first), "unique")
    signatures = keep(every.groupBy(F.col("h1").alias("id")).agg(*[F.min(m).alias(m) for m in MINIMA]), "signatures")
    met = keep(buckets(signatures), "met")
    asked = keep(met.select(F.col("id").alias("k")).distinct(), "asked")
    texts = _lines(docs, text).select("h1", "line").join(_measured(asked, 16), F.col("h1") == F.col("k"), "left_semi")
    texts = keep(sketched(texts.groupBy(F.col("h1").alias("id")).agg(F.first("line").alias("line"))), "texts")
    pairs = near_pairs(keep(candidates(met), "pairs"), texts, similar)
    groups = keep(components(keep(links(pairs, texts, similar), "links")), "groups")
    groups = rest_groups(met, texts, groups, similar)
    small = _measured(groups, 24)
    grouped = keep(unique.join(small, F.col("h1") == F.col("node")).select("h1", "h2", "component", "first"), "grouped")
    stays = grouped.groupBy("component").agg(F.min("first").alias("s")).withColumnRenamed("component", "c")
    near = grouped.join(stays, F.col("component") == F.col("c")).select("h1", "h2", "s")
    equal = unique.filter("n > 1").join(small, F.col("h1") == F.col("node"), "left_anti").select("h1", "h2", F.col("first").alias("s"))
    stays = near.union(equal).select("h1", "h2", *[F.col(f"s.{c}").alias(c) for c in ("doc", "mark", "pos")])
    return places, keep(stays, "stays")


def dedup_lines(docs: DataFrame, text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """`docs` with the text without repeated lines, and n_lines and n_dropped.

    Blank lines always stay. A null text stays null and has no lines; an empty one
    has one, which is blank. Rows of equal doc_id and text are one document that is
    there more than once: they lose the same lines and each row stays. A document
    may lose all its lines, its text is then empty. Null ids come first in the order
    of places. Columns n_lines and n_dropped are replaced, other columns are kept;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in {"n_lines", "n_dropped"}]
    places, stays = line_groups(docs, text, similar)
    stays = stays.withColumnsRenamed({"h1": "k1", "h2": "k2", "doc": "stays_doc", "mark": "stays_mark", "pos": "stays_pos"})
    again = places.join(_measured(stays, 64), (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
    again = again.filter(~(F.col("doc").eqNullSafe(F.col("stays_doc")) & (F.col("mark") == F.col("stays_mark")) & (F.col("pos") == F.col("stays_pos"))))
    d_doc, d_mark, gone, parts, mark = (free_name(docs.columns, n) for n in ("drop_doc", "drop_mark", "gone", "parts", "mark"))
    drops = settled(
        again.groupBy("doc", "mark").agg(F.collect_set("pos").alias("gone")).withColumnsRenamed({"doc": d_doc, "mark": d_mark, "gone": gone}),
        new_path(spark, "drops"),
    )
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64(F.col(f"`{text}`")).alias(mark))
    small = _measured(drops, F.size(gone) * 4 + 64)
    rows = rows.join(small, F.col("doc_id").eqNullSafe(F.col(d_doc)) & (F.col(mark) == F.col(d_mark)), "left")
    rows = rows.withColumn(parts, F.split(F.col(f"`{text}`"), "\n", -1))
    p, g = F.col(parts), F.col(gone)
    left = F.array_except(F.sequence(F.lit(0), F.size(p) - 1), g)
    new = F.when(g.isNull(), F.col(f"`{text}`")).otherwise(F.array_join(F.transform(left, lambda i: F.get(p, i)), "\n"))
    return rows.select(
        *[new.alias(c) if c == text else F.col(f"`{c}`") for c in kept],
        F.when(p.isNull(), F.lit(0)).otherwise(F.size(p)).cast("long").alias("n_lines"),
        F.coalesce(F.when(g.isNotNull(), F.size(g)), F.lit(0)).cast("long").alias("n_dropped"),
    )
