"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour of a node that is larger than it is linked to the smallest node around."""
    both = edges.union(edges.select("dst", "src")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.filter("other > node")
        .join(least, "node")
        .select(F.col("other").alias("src"), F.least("least", "node").alias("dst"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("other"))
    least = down.groupBy("node").agg(F.min("other").alias("least"))
    moved = down.join(least, "node").select(F.col("other").alias("src"), F.col("least").alias("dst"))
    return moved.union(least.select("node", "least")).filter("src <> dst").distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)")), F.expr("bit_xor(xxhash64(dst, src))")
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node with a link the smallest node of its component.

    `links` has long columns `src` and `dst`. Each step is one aggregation and
    one join on a node; the minimum of a node with very many links is merged
    before the shuffle and its join is one that adaptive execution can split.
    Every round is a written table, so a lost executor repeats one round only.
    An empty table gives an empty one.
    """
    edges = stored(links.select("src", "dst").filter("src <> dst").distinct(), "edges")
    before = _digest(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
