"""Connected components of a graph given as a table of edges, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.workspace import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is moved to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node itself, is moved to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, workspace: Workspace, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b of type long); root is the smallest node that can be
    reached. Alternating star contractions halve the depth of the trees, so a few rounds suffice; each
    round is written, and the loop ends when a round changes nothing. Nulls and loops are left out."""
    def fingerprint(table: DataFrame):
        return table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = workspace.stage(now, name)
    seen = fingerprint(now)
    while seen[0]:
        now = workspace.stage(_small_star(_large_star(now)).filter(F.col("a") != F.col("b")).distinct(), name)
        before, seen = seen, fingerprint(now)
        if before == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct())
