"""Connected components of a link table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node below the smallest of them and itself.

    ``edges(a, b)`` has a > b. The large star moves the larger neighbours, the small
    star the node and its smaller ones. Minima combine before the shuffle, and the join
    back is one that the engine can split where a node has very many neighbours.
    """
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("low"))
        least = least.select(F.col("a").alias("node"), F.least("low", "a").alias("low"))
        moved = (
            sides.where("b > a").join(least, F.col("a") == F.col("node"))
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
    else:
        least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        joined = edges.join(least, F.col("a") == F.col("node"))
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is its smallest reachable.

    Large and small stars in turn; the number of rounds grows with the logarithm of the
    longest chain. A round's edges are stored, so a lost executor costs one round.
    """
    edges = cut_lineage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = cut_lineage(_star(_star(edges, large=True), large=False))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
