"""Connected components of links between numbered nodes.

Large-star and small-star steps in turn: each hangs neighbours on the smallest
node they can see, until every node hangs on the smallest of its component.
Minima are aggregated and joined back, so the neighbours of a node never come
together in one place; a node with very many is a key that the aggregation combines
early and the join may split.  Each round is a written table, in as many files as its rows ask
for: a file that a task opens costs more than the few links that a partition may hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramloom.llm.common import stage


def _hang(links: DataFrame) -> DataFrame:
    """Each (node, neighbour) with the smallest of the node and its neighbours."""
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select(F.col("node").alias("of"), F.least("node", "least").alias("least"))
    return links.join(least, links["node"] == least["of"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return _hang(both).filter("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))


def _small_star(links: DataFrame) -> DataFrame:
    hung = _hang(links)
    moved = hung.filter("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
    return moved.unionByName(hung.select("node", F.col("least").alias("other")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node but the smallest of each component.

    `links` has two bigint columns without nulls; order and repeats do not
    matter.
    """
    first, second = links.columns
    links = links.filter(F.col(first) != F.col(second)).select(
        F.greatest(first, second).alias("node"), F.least(first, second).alias("other")
    )
    links = stage(links.distinct(), "links")
    before = None
    while True:
        # The sum of hashes tells whether a round has changed anything.
        row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).head()
        if tuple(row) == before:
            return links.select("node", F.col("other").alias("component"))
        before = tuple(row)
        links = stage(_small_star(_large_star(links).distinct()).distinct(), "links", rows=row[0])
