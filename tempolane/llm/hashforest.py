"""Nearest neighbours with a hash-prefix forest, in shards.

A tree sorts the long hash strings of its vectors, a bit per random bisecting
plane. A query goes down each tree to the longest prefix that it shares with any
vector, then up all trees at once, a bit at a time, until the vectors below the
prefixes are enough; their distances are computed exactly.

Vectors are dealt over shards of bounded size, each with a forest of its own, and
every block of queries visits every shard; what a shard finds is merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREES = 48
BITS = 32
SHARD_ROWS = 8192
QUERY_ROWS = 4096
# Of a shard: how many finds (a vector counts in each tree) end the way up.
FINDS = 6000
SAMPLE = 2048  # vectors that the planes are drawn from
SEED = 11


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of rows with an id and a vector of finite components that isn't zero."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v"))
    finite = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    return finite.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))


def _planes(rows: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Planes that bisect random pairs of a bounded sample of different vectors."""
    found = rows.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    if not found:
        return None
    sample = np.array([r["v"] for r in found])
    rng = np.random.default_rng(SEED)
    n = TREES * BITS
    a, b = rng.integers(0, len(sample), n), rng.integers(0, len(sample), n)
    normal = sample[a] - sample[b]
    same = ~normal.any(axis=1)
    normal[same] = rng.standard_normal((int(same.sum()), sample.shape[1]))
    return normal, ((sample[a] + sample[b]) / 2 * normal).sum(axis=1)


def _hashes(x: np.ndarray, normal: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Keys by vector and tree; a longer string is a larger number of leading bits."""
    bits = (x @ normal.T > offset).reshape(len(x), TREES, BITS)
    packed = np.packbits(bits, axis=2).reshape(len(x), TREES, BITS // 8)
    return packed.view(">u4").reshape(len(x), TREES).astype(np.uint64)


def search_shard(ids, x, qids, q, normal, offset, k: int, finds: int = FINDS) -> list[tuple[int, int, float]]:
    """(query id, id, distance) of up to k nearest that the forest of a shard finds."""
    keys = _hashes(x, normal, offset)
    order = np.argsort(keys, axis=0, kind="stable")
    trees = np.take_along_axis(keys, order, axis=0)
    wanted = _hashes(q, normal, offset)
    # Up all trees at once: for each length of prefix the ranges below it.
    open_ = np.ones(len(q), dtype=bool)
    low, high = np.zeros((len(q), TREES), dtype=np.int64), np.zeros((len(q), TREES), dtype=np.int64)
    for length in range(BITS, -1, -1):
        rest = np.uint64((1 << (BITS - length)) - 1)
        at = np.flatnonzero(open_)
        for t in range(TREES):
            low[at, t] = np.searchsorted(trees[:, t], wanted[at, t] & ~rest, side="left")
            high[at, t] = np.searchsorted(trees[:, t], wanted[at, t] | rest, side="right")
        open_[at[(high[at] - low[at]).sum(axis=1) >= min(finds, len(x) * TREES)]] = False
        if not open_.any():
            break
    result = []
    for i in range(len(q)):
        seen = np.zeros(len(x), dtype=bool)
        for t in range(TREES):
            seen[order[low[i, t] : high[i, t], t]] = True
        at = np.flatnonzero(seen & (ids != qids[i]))
        far = ((x[at] - q[i]) ** 2).sum(axis=1)
        if len(at) > k:
            near = np.partition(far, k - 1)[k - 1]
            at, far = at[far <= near], far[far <= near]
        best = np.lexsort((ids[at], far))[:k]
        result += zip([int(qids[i])] * len(best), ids[at[best]].tolist(), np.sqrt(far[best]).tolist())
    return result


def nearest(vectors: DataFrame, queries, k: int = 10, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query.

    `queries` is a condition on the columns `id` and `v`. Score is the Euclidean
    distance in double precision; ties go to the smaller id. A row is never its
    own candidate, nor is another row of the same id. Vectors that are null, zero
    or hold null or non-finite components take no part, nor do null ids. All must
    have one length. Repeated rows count once. Equal vectors are one entry of a shard with their k + 1
    smallest ids, which no answer can need more of, so a vector that a third of
    all rows share is as cheap as any. With fewer than k candidates all are given.
    Small shards are searched whole, so small tables have exact answers.
    """
    rows = usable(vectors, key, vector)
    sizes = [r["n"] for r in rows.select(F.size("v").alias("n")).distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError("vectors of different lengths")
    return _search(rows, queries, k, shard_rows)


def _fewest(rows: DataFrame, k: int) -> DataFrame:
    """Each different (id, vector) once; of equal vectors those with the k + 1 smallest ids."""
    mark, salt = F.xxhash64("v"), F.pmod(F.xxhash64("id"), F.lit(64))
    marked = rows.withColumn("mark", mark).withColumn("salt", salt)
    same = Window.partitionBy("mark", "salt", "id").orderBy("id")
    first = Window.partitionBy("mark", "salt").orderBy("id")
    then = Window.partitionBy("mark").orderBy("id")
    some = marked.withColumns({"copy": F.row_number().over(same), "nth": F.dense_rank().over(first)})
    some = some.filter((F.col("copy") == 1) & (F.col("nth") <= k + 1))
    return some.withColumn("nth", F.row_number().over(then)).filter(F.col("nth") <= k + 1).select("id", "v")


def _search(rows: DataFrame, queries, k: int, shard_rows: int) -> DataFrame:
    spark = rows.sparkSession
    found = "query_id long, id long, far double"
    planes = _planes(rows)
    if planes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(planes)
    # Within salts first, so that no task sees all rows of a common vector.
    base = _fewest(rows, k)
    asked = rows.filter(queries).distinct()
    n, m = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-m // QUERY_ROWS))
    # Every block of queries meets every shard: rows are repeated by the number of
    # blocks, queries by the number of shards.
    base = base.select(
        F.pmod(F.hash("id"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "v"
    )
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.hash("id"), F.lit(blocks)).alias("block"),
        F.col("id").alias("id"), F.col("v").alias("v"),
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "id": [], "far": []})
        got = search_shard(
            left["id"].to_numpy(), np.stack(left["v"].to_numpy()), right["id"].to_numpy(), np.stack(right["v"].to_numpy()), *sent.value, k
        )
        return pd.DataFrame(got, columns=["query_id", "id", "far"])

    pairs = base.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(search, found).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("far", "id"))
    best = pairs.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.col("far").alias("score"))
