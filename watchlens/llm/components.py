"""Connected components of a graph of any size, by alternating large and small stars.

Each round ties every node's larger neighbours to the smallest node near it, then every
node's smaller neighbours, until nothing changes: all nodes then hang on the smallest of
their component. A hub's edges meet only its one minimum, so no task needs them together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchlens.session import materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = both.where(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b, longs): the root is its component's smallest node.

    Loops and repeated edges do no harm, edges with a null end are dropped, no edges give no rows.
    Every round is a written table, so a lost executor costs one round's part at most.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.where((F.col("a") != F.col("b"))).distinct(), "components")
    state = _state(edges)
    while state[0]:
        edges = materialize(_small(_large(edges)), "components")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
