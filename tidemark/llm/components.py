"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """From links (a, b): one row (node, label) for each node that isn't itself the smallest of its
    component; label is that smallest. Loops and repeated links don't matter; no links, no rows.

    Minima are aggregated before they are shuffled, so a node with very many links stays cheap. Each
    round is written to the shared folder, which cuts the lineage; rounds grow with the logarithm of
    the longest path."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = state
        edges = materialize(_small_star(_large_star(edges)).where("a <> b").distinct(), "stars")
