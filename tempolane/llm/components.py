"""Connected components by alternating large-star and small-star steps.

Edges are rows (src, dst). Each round hangs larger neighbours on the smallest one
(large star), then the others below on it (small star), until nothing changes: every
node then has one edge, to the smallest of its component. Rounds are written to the
shared folder; a node that very many edges name is a skewed join key, which adaptive
execution splits, as both sides are read from tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolane.sources.shared import new_path, settled


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Loops and null ends are left out; a table without edges gives an empty one.
    """
    spark = edges.sparkSession
    keep = lambda df: settled(df, new_path(spark, "edges"))
    now = keep(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct())
    before = None
    while True:
        both = now.union(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        lowest = keep(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("k"), F.least("src", "m").alias("m")))
        large = keep(
            both.filter("dst > src").join(lowest, F.col("src") == F.col("k")).select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()
        )
        lowest = keep(large.groupBy("src").agg(F.min("dst").alias("m")).withColumnRenamed("src", "k"))
        hung = large.join(lowest, F.col("src") == F.col("k")).select("src", "dst", "m")
        now = keep(
            hung.select(F.col("dst").alias("src"), F.col("m").alias("dst")).filter("src <> dst")
            .union(lowest.select("k", "m")).distinct()
        )
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
