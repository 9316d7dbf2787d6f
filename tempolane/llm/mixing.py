"""Mixing sources to target weights by Sainte-Laguë apportionment.

Blocks of equal size go to the sources by highest quotients target / (2k + 1);
each output shard takes the next part of that sequence, which gives it a whole
number of blocks of each source. The documents of a source lie in a seeded order,
and its blocks are taken from a seeded one on, again from the front after the
last. A document's share follows from where it lies: no block is made a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolane.llm.text import WORD, free_name, text_of

SEED = 17
BLOCK = 16  # words
SHARDS = 8
WEIGHTS = (1, 2, 3)
REPEATS = 3  # no document is taken more often
DIGITS = 3  # hex digits of a document's seeded order that name its part of a source


def n_words(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0) -> DataFrame:
    """(source, source_size, nth, weight, target) from (source, source_size).

    A row per source: the windows here see the short table of sources only. Words
    go by weight; what a source can't take (`REPEATS` times its size) is shared
    again among the others. With sources in order of capacity by weight the level
    w -> weight * level has a closed form: the first source, in that order, that
    stays below its capacity fixes it for all after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    rows = sizes.withColumn("nth", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int")).cast("double"))
    rows = rows.withColumn("capacity", F.col("source_size") * float(REPEATS))
    everything = Window.partitionBy()
    rows = rows.withColumn("wanted", F.sum("source_size").over(everything) * float(share))
    by_level = Window.orderBy(F.col("capacity") / F.col("weight"), "nth")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("full", F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
    rows = rows.withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("level", (F.col("wanted") - F.col("full")) / F.col("rest"))
    fits = F.col("level") * F.col("weight") <= F.col("capacity")
    rows = rows.withColumn("at", F.min(F.when(fits, F.struct((F.col("capacity") / F.col("weight")).alias("r"), "nth", "level"))).over(everything)["level"])
    target = F.least(F.coalesce(F.col("at") * F.col("weight"), F.col("capacity")), F.col("capacity"))
    return rows.select("source", "source_size", "nth", "weight", target.alias("target"))


def block_quotas(targets: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """(source, shard, blocks): the blocks of each source in each output shard.

    The house of all shards up to s has round(s / shards * blocks) seats. Between
    the quotients total / (2 seats - n) and total / (2 seats + n), n sources hold
    at most 2 n quotients: what lies above is counted, only those are ranked.
    """
    everything = Window.partitionBy()
    rows = targets.filter("target > 0").select(
        "source", "nth", "target",
        F.sum("target").over(everything).alias("total"),
        F.count(F.lit(1)).over(everything).alias("n"),
    )
    rows = rows.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # Every source has a seat's fraction at least, so a mix is never without seats.
    seats = F.greatest(F.round(F.col("total") / block), F.lit(1.0))
    rows = rows.withColumn("seats", F.round(seats * (F.col("shard") + 1) / shards))
    # A quotient target / (2 k + 1) is at least q for so many k.
    above = lambda q: F.greatest(F.floor(F.col("target") / q / 2 + 0.5), F.lit(0))
    high = F.when(F.col("seats") * 2 > F.col("n"), above(F.col("total") / (F.col("seats") * 2 - F.col("n")))).otherwise(F.lit(0))
    rows = rows.withColumn("low_k", high.cast("long"))
    rows = rows.withColumn("high_k", above(F.col("total") / (F.col("seats") * 2 + F.col("n"))).cast("long"))
    open_seats = F.col("seats") - F.sum("low_k").over(Window.partitionBy("shard"))
    rows = rows.withColumn("open", open_seats)
    doubtful = rows.filter("high_k > low_k").select(
        "source", "nth", "shard", "open", "target", F.explode(F.sequence("low_k", F.col("high_k") - 1)).alias("k")
    )
    rank = F.row_number().over(Window.partitionBy("shard").orderBy((F.col("target") / (F.col("k") * 2 + 1)).desc(), "nth"))
    won = doubtful.withColumn("rank", rank).filter("rank <= open").groupBy("nth", "shard").agg(F.count(F.lit(1)).alias("more"))
    held = rows.join(won, ["nth", "shard"], "left").withColumn("held", F.col("low_k") + F.coalesce("more", F.lit(0)))
    # Houses only grow a source's seats, so differences are not negative.
    last = F.lag("held", 1, 0).over(Window.partitionBy("nth").orderBy("shard"))
    return held.select("source", "nth", "shard", (F.col("held") - last).alias("blocks"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.0,
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """`docs` with size, source_size, target (its source's) and taken.

    Size counts the words of the text (null: 0). `taken` are the words that the
    mix takes of a document, repeats counted, at most `REPEATS` times its size.
    Null sources are a source of their own, after all others. A document without
    words takes no part and has taken 0; so have all where no text has a word.
    Repeated rows and null ids each count as documents. An empty table gives an
    empty result. Columns named size, source_size, target or taken are replaced.
    Reruns give the same result, however the rows are partitioned.
    """
    new = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c.lower() not in new]
    key, order, part, before, other_key, other_part = (
        free_name(docs.columns, n) for n in ("mix_key", "mix_order", "mix_part", "mix_before", "plan_key", "plan_part")
    )
    # Null is a source too: a plain key lets the window and the join below share one shuffle.
    key_of = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    seeded = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), key_of))
    light = docs.select("source", key_of.alias("key"), F.substring(seeded, 1, DIGITS).alias("part"), n_words().alias("size"))
    # A source is as many parts as its order has prefixes: no part is the whole of a large source.
    parts = light.groupBy("source", "key", "part").agg(F.sum("size").alias("part_size"))
    parts = parts.withColumn("part_start", F.sum("part_size").over(Window.partitionBy("key").orderBy("part")) - F.col("part_size"))
    totals = parts.groupBy("source", "key").agg(F.sum("part_size").alias("source_size"))
    targets = source_targets(totals.drop("key"), weights, share)
    seats = block_quotas(targets, block, shards).groupBy("nth").agg(F.sum("blocks").alias("seats"))
    size = F.col("source_size")
    quota = F.coalesce("seats", F.lit(0)) * block
    passes = F.when(size > 0, F.least(F.floor(quota / size), F.lit(REPEATS))).otherwise(F.lit(0))
    n_blocks = F.greatest(F.ceil(size / block), F.lit(1))
    source_key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), source_key)), 1, 8), 16, 10).cast("long")
    plan = targets.join(seats, "nth", "left").select(
        source_key.alias("key"), "source_size", "target", passes.alias("passes"),
        # The last pass is partial: so many words, from a block drawn by the seed.
        F.when(passes < REPEATS, quota - passes * size).otherwise(F.lit(0)).alias("extra"),
        (F.pmod(draw, n_blocks) * block).alias("first"),
    )
    layout = plan.join(parts.select("key", "part", "part_start"), "key").withColumnsRenamed({"key": other_key, "part": other_part})
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        n_words().alias("size"), key_of.alias(key), seeded.alias(order), F.substring(seeded, 1, DIGITS).alias(part),
    )
    placed = Window.partitionBy(key, part).orderBy(order, F.col("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(before, F.coalesce(F.sum("size").over(placed), F.lit(0)))
    rows = rows.join(layout, [F.col(key) == F.col(other_key), F.col(part) == F.col(other_part)], "left")
    start = F.col("part_start") + F.col(before)
    end = start + F.col("size")
    stop = F.col("first") + F.col("extra")
    over = lambda a, b: F.greatest(F.least(end, b) - F.greatest(start, a), F.lit(0))
    some = over(F.col("first"), F.least(stop, F.col("source_size"))) + over(F.lit(0), stop - F.col("source_size"))
    taken = F.coalesce(F.col("passes") * F.col("size") + some, F.lit(0)).cast("long")
    return rows.select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", taken.alias("taken"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as round(taken / size) says."""
    rows = mix(docs, **how)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    one = free_name(rows.columns, "copy")
    rows = rows.withColumn(one, F.explode(F.array_repeat(F.lit(1), times)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
