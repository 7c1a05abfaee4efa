"""Connected components by alternating large and small stars, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import Written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every linked node: the smallest node it can reach.

    Takes the first two columns as undirected links between numbers; links with a null, links to
    oneself and repeated links change nothing, and no link gives no row. Minima are combined before
    the shuffle, so a node with very many links is no single task's group. Each round is stored in
    the shared folder; it ends when a round changes nothing.
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct()
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    now = Written(edges, "links", mark=mark)
    while now.rows:
        spread = Written(_large(now.df), "large", 2 * now.rows)
        after = Written(_small(spread.df), "small", 2 * spread.rows, mark=mark)
        same = after.figures == now.figures
        spread.drop()
        now.drop()
        now = after
        if same:
            break
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
