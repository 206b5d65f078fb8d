"""Connected components of links between numbered nodes, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import staged


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    around = _both(links)
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node in ``links(a, b)``, the root being the smallest node of its component.

    Alternating star contractions: every node hangs its larger neighbours on its smallest one,
    then its smaller ones, until nothing moves; the number of rounds grows with the logarithm of
    the longest path. Each round is written to the shared folder. Loops and repeated links do no
    harm; without links there are no rows.
    """
    edges = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    state = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = None
    while before != (now := state(edges)):
        edges, before = staged(_small_star(_large_star(edges)), "links"), now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
