"""Exact self-join of documents on the Jaccard similarity of their word n-grams.

1. Equal sets are one node.
2. Of the smallest hashes of a set (a prefix in order of hash) a partner lacks few;
   documents that share fewer with all others have no partner, the rest are candidates.
3. Of candidates all shingles are counted. With rarest first, two partners share a
   shingle of their prefixes; documents that do so, also through others, are a group.
4. In a group each document asks the inverted lists of those before it for overlaps
   of at least T (DivideSkip: the longest lists are not merged, what may reach T with
   them is looked up). Groups above `BLOCK` documents go in blocks.
Only links that join two components of a task leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempolane.llm.components import components
from tempolane.llm.sentencepieces import BATCH_BYTES, _slices, releasing
from tempolane.sources.shared import new_path, settled

WORDS = 5
PERCENT = 75
BLOCK = 4096
LONG = 40  # percent of a set, smallest hashes first, that candidates are found by
SENT_BYTES = 32 << 20  # keys of candidates that may be sent to all tasks; beyond, a shuffle joins them
LOOKED_UP = 64  # documents of a cell that are looked up at first; a link spares the rest of its component
NO_KEY = -(1 << 63)  # sent in place of a null key
SMALL = 200  # sizes up to which what a prefix must share is computed exactly

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number in each text): the different word n-grams of each text, sorted
    within the text. Letters A-Z are lowered; a text of fewer words is one n-gram."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) + 1
    raw = np.frombuffer(b" ".join(data) + b" ", dtype=np.uint8)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    gap = (low == 32) | ((low >= 9) & (low <= 13))
    word = ~gap
    starts = np.flatnonzero(word & np.append(True, gap[:-1]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    stops = np.flatnonzero(word & np.append(gap[1:], True)) + 1
    # Polynomial over random values of the bytes, modulo 2^64, then mixed.
    within = np.arange(len(low), dtype=np.int64) - np.repeat(starts, np.diff(np.append(starts, len(low)))) if starts[0] == 0 else None
    if within is None:
        within = np.zeros(len(low), dtype=np.int64)
        within[starts[0]:] = np.arange(starts[0], len(low)) - np.repeat(starts, np.diff(np.append(starts, len(low))))
    most = int((stops - starts).max())
    powers = np.cumprod(np.append(np.uint64(1), np.full(min(most, 1 << 16) - 1, _BASE, dtype=np.uint64)), dtype=np.uint64)
    part = _BYTE[low] * powers[np.minimum(within, len(powers) - 1)]
    if most > len(powers):  # words beyond are told apart by place as well
        far = within >= len(powers)
        part[far] = _mixed(part[far] + within[far].astype(np.uint64) * _MIX[2])
    part[gap] = 0
    hashes = _mixed(np.add.reduceat(part, starts) + (stops - starts).astype(np.uint64) * _MIX[2])
    text = np.searchsorted(np.cumsum(sizes), starts, side="right")
    n_words = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    grams = np.zeros(len(hashes), dtype=np.uint64)
    padded = np.append(hashes, np.zeros(words, dtype=np.uint64))
    for k in range(words):
        grams = _mixed(grams * _BASE + padded[k : k + len(hashes)] + np.uint64(k + 1))
    place = np.arange(len(hashes)) - first[text]
    keep = place + words <= n_words[text]
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    for t in short.tolist():
        x = np.uint64(n_words[t])
        with np.errstate(over="ignore"):
            for h in hashes[first[t] : first[t] + n_words[t]]:
                x = _mixed(np.array([x * _BASE + h], dtype=np.uint64))[0]
        grams[first[t]] = x
        keep[first[t]] = True
    grams, text = grams[keep], text[keep]
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.append(True, (grams[1:] != grams[:-1]) | (text[1:] != text[:-1]))
    return grams[new], np.bincount(text[new], minlength=len(texts))


def _fingerprints(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    full = counts > 0
    out = np.zeros((2, len(counts)), dtype=np.uint64)
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        for i in (0, 1):
            out[i, full] = _mixed(np.add.reduceat(_mixed(grams ^ _MIX[i]), starts) + counts[full].astype(np.uint64) * _MIX[2])
    return out[0].view(np.int64), out[1].view(np.int64)


def _prefix(n, percent: int):
    """How many of a set's first n-grams hold one of any partner's first ones."""
    return n - (n * percent + 99) // 100 + 1


def _long_prefix(n, percent: int):
    """A longer prefix, of which a partner has more than one n-gram."""
    return np.maximum(_prefix(n, percent), -(-n * LONG // 100))


def least_shared(n: int, percent: int) -> int:
    """How many n-grams the long prefixes of a set of n and of any partner share at
    least: of the o that both sets hold, the first j ones stand in a prefix if the
    others, all before them at worst, leave room for them there."""
    least = n
    for m in range(-(-n * percent // 100), n * 100 // percent + 1):
        o = -(-percent * (n + m) // (100 + percent))
        if o <= min(n, m):
            room = [int(_long_prefix(np.int64(x), percent)) - (x - o) for x in (n, m)]
            least = min(least, o, *room)
    return max(1, least)


def _least_shared(n, percent: int):
    """The same for a column; above `SMALL` by the linear bound below it."""
    table = F.lit([0] + [least_shared(x, percent) for x in range(1, SMALL + 1)])
    linear = F.greatest(F.lit(1).cast("long"), F.floor(n * (LONG + percent - 100) / 100))
    return F.when(n <= SMALL, F.get(table, n.cast("int")).cast("long")).otherwise(linear)


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Two documents link when 100 * |both| >= percent * |either|. A null text, or one
    without words, has an empty set and links with nothing: it is a component of its
    own. Repeated rows give as many rows; rows of one key count as linked where one
    of them links. Null keys take part; a component of null keys alone has a null id.
    """
    spark = docs.sparkSession
    keep = lambda df, name: settled(df, new_path(spark, name))
    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))

    def rows_of(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for a, b in _slices(whole.column(1), BATCH_BYTES):
                part = whole.slice(a, b - a)
                grams, counts = shingle_sets([t or "" for t in part.column(1).to_pylist()], words)
                yield part.column(0), grams, counts, _fingerprints(grams, counts)

    def sizes(batches):
        for keys, _, counts, (one, two) in rows_of(batches):
            yield pa.RecordBatch.from_arrays([keys, pa.array(counts), pa.array(one), pa.array(two)], ["key", "n", "node", "other"])

    light = keep(source.mapInArrow(releasing(sizes), "key long, n long, node long, other long"), "sets")
    nodes = keep(light.filter("n > 0").groupBy("node", "other").agg(F.min("key").alias("id"), F.first("n").alias("n")), "nodes")

    def prefixes(batches):
        """Rows (token, node, shared): an n-gram that one text of the slice has among
        its first ones; one that several have, without a node; and for a text how many
        of its n-grams others of the slice have. So what is common is sent once a slice."""
        for _, grams, counts, (one, _) in rows_of(batches):
            _, first = np.unique(one, return_index=True)
            chosen = np.zeros(len(counts), dtype=bool)
            chosen[first] = True
            most = np.where(chosen & (counts > 0), _long_prefix(counts, percent), 0)
            starts = np.cumsum(counts) - counts
            doc = np.repeat(np.arange(len(counts)), most)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + starts[doc]
            tokens, index, back, n = np.unique(grams[at].view(np.int64), return_index=True, return_inverse=True, return_counts=True)
            local = np.bincount(doc[n[back] > 1], minlength=len(counts))
            some = np.flatnonzero(local)
            blank, zeros = np.zeros(len(some), dtype=np.int64), np.zeros(len(tokens), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(tokens, blank), mask=np.append(zeros, blank + 1) > 0),
                    pa.array(np.append(one[doc[index]], one[some]), mask=np.append(n > 1, blank > 0)),
                    pa.array(np.append(zeros, local[some])),
                ],
                ["token", "node", "shared"],
            )

    tokens = source.mapInArrow(releasing(prefixes), "token long, node long, shared long")
    times = F.count(F.lit(1)).over(Window.partitionBy("token"))
    met = tokens.filter("token IS NOT NULL").select("token", "node").withColumn("times", times).filter("times > 1 AND node IS NOT NULL")
    met = met.select("node", F.lit(1).cast("long").alias("shared")).union(tokens.filter("token IS NULL").select("node", "shared"))
    met = met.groupBy("node").agg(F.sum("shared").alias("shared"))
    wanted = keep(
        met.join(nodes.select(F.col("node").alias("k"), "n").dropDuplicates(["k"]), F.col("node") == F.col("k"))
        .filter(F.col("shared") >= _least_shared(F.col("n"), percent)).select("node"), "candidates",
    )
    sets = keep(_sets_of(source, light, wanted, rows_of), "candidate_sets")

    # Rarest first, by how many candidates hold an n-gram.
    one = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = keep(one.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "counts")
    held = one.join(often.withColumnRenamed("token", "t"), F.col("token") == F.col("t"))
    ranked = keep(
        held.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("x"))
        .select("node", "n", F.transform("x", lambda x: x["token"]).alias("tokens")), "ranked",
    )
    first = F.expr(f"n - (n * {percent} + 99) div 100 + 1 - (n - size(tokens))").cast("int")
    open_ = ranked.withColumn("p", first).filter("p > 0")
    postings = keep(open_.select("node", F.explode(F.slice("tokens", F.lit(1), F.col("p"))).alias("token")), "postings")
    lowest = keep(postings.groupBy("token").agg(F.min("node").alias("dst"), F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("token").alias("t"), "dst"), "lowest")
    edges = postings.join(lowest, F.col("token") == F.col("t")).filter("node <> dst").select(F.col("node").alias("src"), "dst").distinct()
    groups = keep(components(edges).withColumnsRenamed({"node": "k", "component": "group"}), "groups")
    counts = keep(groups.groupBy("group").agg(F.count(F.lit(1)).alias("size")), "group_sizes").withColumnRenamed("group", "g")
    members = keep(
        open_.join(groups, F.col("node") == F.col("k")).join(counts, F.col("group") == F.col("g"))
        .select("group", F.ceil(F.col("size") / block).cast("int").alias("blocks"), "node", "n", "tokens"), "members",
    )
    links = group_links(members, percent, block)
    ids = components(links).withColumnsRenamed({"node": "k", "component": "c"})
    placed = keep(nodes.join(ids, F.col("node") == F.col("k"), "left").select("node", "other", "id", F.coalesce("c", "node").alias("c")), "placed")
    # A component is named by its smallest key; components that share a key are one.
    named = keep(placed.groupBy("c").agg(F.min("id").alias("component_id")).withColumnRenamed("c", "d"), "named")
    placed = keep(placed.join(named, F.col("c") == F.col("d")).select(F.col("node").alias("k"), F.col("other").alias("o"), "component_id"), "placed")
    found = light.join(placed, (F.col("node") == F.col("k")) & (F.col("other") == F.col("o")), "left")
    alone = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), alone.alias("component_id"))


def _sets_of(source: DataFrame, light: DataFrame, wanted: DataFrame, rows_of) -> DataFrame:
    """(node, n, tokens) of the candidates, each node once, by its first row."""
    one = light.join(wanted.withColumnRenamed("node", "w"), F.col("node") == F.col("w")).groupBy("node").agg(F.coalesce(F.min("key"), F.lit(NO_KEY)).alias("kk"))
    keys = settled(one.select("kk").distinct(), new_path(source.sparkSession, "candidate_keys"))
    sent = F.broadcast(keys) if keys.count() * 16 <= SENT_BYTES else keys
    # One long a key, as a null-safe join would send three times the bytes. What it
    # takes for a null key besides goes below, with other texts of a key.
    chosen = source.join(sent, F.coalesce("key", F.lit(NO_KEY)) == F.col("kk"), "left_semi")

    def sets(batches):
        for _, grams, counts, (one, _) in rows_of(batches):
            good = counts > 0
            _, first = np.unique(one, return_index=True)
            once = np.zeros(len(one), dtype=bool)
            once[first] = True
            good &= once
            held = np.repeat(good, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[good]), pa.array(counts[good]), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts[good])).astype(np.int32)), pa.array(grams[held].view(np.int64)))],
                ["node", "n", "tokens"],
            )

    found = chosen.mapInArrow(releasing(sets), "node long, n long, tokens array<long>")
    # Rows of one key may hold other texts than the one that was asked for.
    found = found.join(wanted.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left_semi")
    return found.dropDuplicates(["node"])


class Overlaps:
    """Inverted lists of the documents of a cell, searched for overlaps with those before."""

    def __init__(self, tokens: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.percent, self.sizes = percent, sizes
        counts = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.stops = np.append(0, np.cumsum(counts))
        flat = np.concatenate(tokens) if len(tokens) else np.zeros(0, dtype=np.int64)
        kinds, self.ids = np.unique(flat, return_inverse=True)
        doc = np.repeat(np.arange(len(tokens), dtype=np.int32), counts)
        order = np.argsort(self.ids, kind="stable")
        self.lists = doc[order]  # documents in order, list behind list
        self.starts = np.searchsorted(self.ids[order], np.arange(len(kinds)))
        # How many documents stand in a token's list before the one that holds it.
        self.before = np.empty(len(flat), dtype=np.int64)
        self.before[order] = np.arange(len(flat)) - np.repeat(self.starts, np.diff(np.append(self.starts, len(flat))))
        self.mark = np.zeros(len(kinds), dtype=bool)

    def search(self, i: int, apart: np.ndarray) -> np.ndarray:
        """Documents before `i`, of another class than its own in `apart`, that may
        overlap enough, those with most n-grams in common lists first (DivideSkip).

        A partner of a set of n holds at least T = percent * n / 100 of it. Of the
        lists, the L longest are not merged: what the others count up to T - L is
        looked up by `linked`.
        """
        own = slice(self.stops[i], self.stops[i + 1])
        lengths, starts = self.before[own], self.starts[self.ids[own]]
        held = lengths > 0
        lengths, starts = lengths[held], starts[held]
        least = int(-(-self.sizes[i] * self.percent // 100))
        if len(lengths) < least or not len(lengths):
            return np.zeros(0, dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        long_ = max(0, min(int(least / (0.01 * math.log2(int(lengths[order[-1]]) + 1) + 1)), least - 1, len(lengths) - 1))
        short = order[: len(lengths) - long_]
        lengths, starts = lengths[short], starts[short]
        ends = np.cumsum(lengths)
        seen = np.bincount(self.lists[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)])
        found = np.flatnonzero(seen >= least - long_)
        need = np.maximum(least, -(-self.percent * (self.sizes[i] + self.sizes[found]) // (100 + self.percent)))
        found = found[(seen[found] + long_ >= need) & (apart[found] != apart[i])]
        return found[np.argsort(-seen[found], kind="stable")]

    def linked(self, i: int, found: np.ndarray) -> np.ndarray:
        """Which of the documents `found` link with `i`."""
        own = self.ids[self.stops[i] : self.stops[i + 1]]
        self.mark[own] = True
        counts = self.stops[found + 1] - self.stops[found]
        ends = np.cumsum(counts)
        hits = self.mark[self.ids[np.arange(ends[-1]) + np.repeat(self.stops[found] - ends + counts, counts)]]
        both = np.add.reduceat(hits, ends - counts, dtype=np.int64)
        self.mark[own] = False
        return 100 * both >= self.percent * (self.sizes[i] + self.sizes[found] - both)


def cell_links(cell: list[tuple[int, int, list[int], bool]], percent: int) -> list[tuple[int, int]]:
    """Links (node, node) that join components among the documents of a cell.

    `cell` has (node, n, tokens rarest first, asks); one that doesn't ask is only
    found. A document asks only for those that aren't in its component yet: the first
    one that links brings the whole component of it.
    """
    nodes = [x[0] for x in cell]
    index = Overlaps([np.asarray(x[2], dtype=np.int64) for x in cell], np.array([x[1] for x in cell], dtype=np.int64), percent)
    root = np.arange(len(cell))
    members = [[i] for i in range(len(cell))]
    links: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        links.append((nodes[i], nodes[j]))
        a, b = int(root[i]), int(root[j])
        if len(members[a]) < len(members[b]):
            a, b = b, a
        root[members[b]] = a
        members[a] += members[b]
        members[b] = []

    for i, (_, _, _, asks) in enumerate(cell):
        found = index.search(i, root) if asks else ()
        some = LOOKED_UP
        while len(found):
            now, found = found[:some], found[some:]
            for j in now[index.linked(i, now)].tolist():
                if root[i] != root[j]:
                    join(i, j)
            found = found[root[found] != root[i]]
            some *= 4
    return links


def _searched(cells: DataFrame, percent: int) -> DataFrame:
    """Rows (cell, asks, node, n, tokens) to links; the cells of a task stream by."""
    sorted_ = cells.repartition("group", "cell").sortWithinPartitions("group", "cell", "asks", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        names = ["src", "dst"]

        def found():
            links = cell_links(rows, percent)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], type=pa.int64()) for i in (0, 1)], names)

        for batch in batches:
            offsets, flat = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy()
            held = (flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
            for group, cell, asks, node, n, tokens in zip(*(c.to_pylist() for c in batch.columns[:5]), held):
                if (group, cell) != at:
                    if rows:
                        yield found()
                    at, rows = (group, cell), []
                rows.append((node, n, tokens, asks))
        if rows:
            yield found()

    return sorted_.mapInArrow(releasing(run), "src long, dst long")


def group_links(members: DataFrame, percent: float, block: int = BLOCK) -> DataFrame:
    """(src, dst): links that join what is similar in each group of `members` (group,
    blocks, node, n, tokens), where a group of more than `block` nodes has more blocks."""
    spark = members.sparkSession
    links = settled(_first_cells(members, percent), new_path(spark, "links"))
    large = members.filter("blocks > 1")
    if large.limit(1).count():
        links = links.union(settled(_rest_cells(large, links, percent, block), new_path(spark, "links")))
    return links


def _first_cells(members: DataFrame, percent: int) -> DataFrame:
    """Each block of a group with itself and with the group's first block."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.when(own == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    cells = members.select("group", F.explode(every).alias("cell"), F.lit(True).alias("asks"), "node", "n", "tokens")
    return _searched(cells, percent)


def _rest_cells(members: DataFrame, links: DataFrame, percent: int, block: int) -> DataFrame:
    """Of groups of several blocks: what isn't in the largest component, with all blocks."""
    spark = members.sparkSession
    ids = components(links).withColumnsRenamed({"node": "k", "component": "c"})
    joined = settled(
        members.join(ids, F.col("node") == F.col("k"), "left").select(*members.columns, F.coalesce("c", "node").alias("c")), new_path(spark, "placed")
    )
    sizes = joined.groupBy("group", "c").agg(F.count(F.lit(1)).alias("m"))
    main = sizes.groupBy("group").agg(F.max(F.struct("m", "c")).alias("x")).select(F.col("group").alias("g"), F.col("x.c").alias("main"))
    apart = joined.join(main, F.col("group") == F.col("g")).filter("c <> main")
    how_many = apart.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("rests")).withColumnRenamed("group", "gg")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64(F.lit("rest"), "node"), F.col("rests")).cast("int")
    both = lambda i, j: F.concat_ws("/", i.cast("string"), j.cast("string"))
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asked = joined.join(how_many, F.col("group") == F.col("gg")).withColumn("every", each("rests")).select(
        "group", both(F.col("every"), own).alias("cell"), F.lit(False).alias("asks"), "node", "n", "tokens")
    asking = apart.join(how_many, F.col("group") == F.col("gg")).withColumn("every", each("blocks")).select(
        "group", both(part, F.col("every")).alias("cell"), F.lit(True).alias("asks"), "node", "n", "tokens")
    return _searched(asked.union(asking), percent)
