"""Connected components by alternating large and small stars; no link leaves the executors.

Each round hangs every node's larger neighbours on its least one, then its smaller neighbours
likewise, until nothing changes. Least neighbours are minima, combined before the shuffle; a hub's
links are dealt out by the join, which adaptive execution splits. Rounds are written to the shared
folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import discard, stored


def _least(links: DataFrame) -> DataFrame:
    """(a, least) for every node a: the least of itself and its neighbours."""
    return links.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hung = both.join(_least(both), "a").where(F.col("b") > F.col("a"))
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) of every node that has a link to another, root the least node; and its folder.

    ``links`` has two long columns a and b. The caller may discard the folder when done.
    """
    spark = links.sparkSession
    now, path = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        after, after_path = stored(_small_star(_large_star(now)), "links")
        discard(spark, path)
        seen, mark, now, path = mark, _mark(after), after, after_path
        if mark == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")), path
