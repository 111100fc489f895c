"""Connected components by label propagation with pointer jumping, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terralattice import session


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node, root for every node; `links` has columns a, b.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): each
    round links a node to the smallest in its neighbourhood, and rounds grow with
    the logarithm of the longest path. Aggregates are combined before the shuffle;
    each round is a written table, so lost executors cost no recompute. Few links
    lie in one file and take a round without a shuffle. Only counts and a sum reach
    the driver.
    """
    edges = session.gathered(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        edges = session.gathered(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or not state["n"]:
            break
        before = state
    return nodes.join(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = _each(edges, ("a", "b"), ("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them; edges have b < a."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return _each(edges.join(least, "a"), ("b", "m"), ("a", "m")).where("a != b").distinct()


def _each(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """a, b: for each row a link of each of the pairs of columns. A union would lose that all rows are in one place."""
    return rows.select(F.explode(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in ends])).alias("l")).select("l.*")
