"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.session import settle


def _smallest_neighbour(pairs: DataFrame) -> DataFrame:
    # Partial aggregates: a node with very many neighbours is one row per task.
    return pairs.groupBy("node").agg(F.min("other").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node now points at the node's smallest neighbour (or the node)."""
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(
        edges.select(F.col("dst").alias("node"), F.col("src").alias("other"))
    )
    return (
        both.join(_smallest_neighbour(both), "node")
        .filter(F.col("other") > F.col("node"))
        .select(F.col("other").alias("src"), F.least("node", "least").alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours now point at the smallest of them."""
    down = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"))
    least = _smallest_neighbour(down)
    others = (
        down.join(least, "node")
        .filter(F.col("other") != F.col("least"))
        .select(F.col("other").alias("src"), F.col("least").alias("dst"))
    )
    return others.unionByName(least.select(F.col("node").alias("src"), F.col("least").alias("dst"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``src``, ``dst`` for every node but the smallest of its component, ``dst`` being that smallest.

    ``edges`` holds longs ``src`` and ``dst``, in any direction, repeats and loops
    allowed. Each round is written to the shared scratch folder; rounds go on
    until one changes nothing. An empty input gives an empty result.
    """
    current = settle(
        edges.filter("src != dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(src, dst))").alias("x")
        ).first()
        if state["n"] == 0 or tuple(state) == before:
            return current
        before = tuple(state)
        current = settle(_small_star(_large_star(current)), "edges")
