"""Connected components of a table of links, by alternating large-star and small-star rounds (Kiveris et al. 2014).

Every round is a join and two aggregations; the links stay in Spark and lineage is cut after each round by writing
them to the shared folder. The minimum of a node's neighbours is an aggregate with partial sums. Handing it back to the
node's links is a join by node; nodes that hold many of the links (:func:`spread_join`) are joined apart from it, so
that the links of a hub stay where they are.

Rounds needed grow with the logarithm of the longest path; the loop ends when nothing is left to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import frozen

#: A key that holds more than one in so many rows is hot: there are fewer hot keys than that, whatever the table.
HOT_SHARE = 400


def spread_join(rows: DataFrame, table: DataFrame, key: str, total: int, count: str = "n") -> DataFrame:
    """Inner join of many ``rows`` with a ``table`` of one row for each key, whose column ``count`` says how many rows
    the key has. Keys with more than one in ``HOT_SHARE`` of the ``total`` rows are at most ``HOT_SHARE``, so these are
    broadcast; the others are shuffled."""
    hot = F.col(count) > max(64, total // HOT_SHARE)
    few = F.broadcast(table.filter(hot).drop(count))
    cold = rows.join(F.broadcast(table.filter(hot).select(key)), key, "left_anti").join(table.filter(~hot).drop(count), key)
    return cold.unionByName(rows.join(few, key))


def _large_star(links: DataFrame, total: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return spread_join(both.filter("b > a"), least, "a", total).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = spread_join(down, least, "a", total).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the least node that it is connected with."""
    now = frozen(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    total = now.count()
    while True:
        now = frozen(_small_star(frozen(_large_star(now, total)), total))
        # Done when each node points straight at a root, that is when no root has a root of its own.
        state = now.agg(F.count("*").alias("n"), F.countDistinct("a").alias("nodes")).first()
        total = state["n"]
        if total == state["nodes"] and not now.join(now.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
