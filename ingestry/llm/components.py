"""Connected components of an edge table by alternating large-star and small-star steps.

Each round relinks every node to the smallest neighbour it knows; a component becomes a
star around its smallest node after a number of rounds that grows with the logarithm of its
size, chains included. A round's minima are pre-aggregated before their shuffle, and its
edges are staged in the shared folder, so no lineage builds up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    up = both.filter("b > a").join(least, "a")
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.filter("a != b").union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node, root): every node of an edge whose component's
    smallest node is another one. Roots themselves are not listed."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(pairs.filter("a != b").distinct(), "links")
    print_of = [F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")]
    seen = now.agg(*print_of).first()
    while seen["n"]:
        now = stage(_small_star(_large_star(now)), "links")
        last, seen = seen, now.agg(*print_of).first()
        if last == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
