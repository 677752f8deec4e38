"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roostline.llm.common import Rounds


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and all its neighbours. The aggregate combines
    before its shuffle and the join may be split, so a node with very many edges is no single
    task."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").withColumn("least", F.least("u", "least"))


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) of every node of the edges (a, b): the root is the least node reachable.

    Alternating large and small stars: each round links every node to the least of its
    neighbours, larger neighbours first, then smaller ones, until only stars are left. The
    number of rounds grows with the logarithm of the longest path. Each round is a table, so
    neither lineage nor lost executors repeat earlier rounds.
    """
    rounds = Rounds(edges.sparkSession)
    now = rounds.next(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        label,
    )
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_least(both)
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .distinct()
        )
        starred = _with_least(large)
        small = starred.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            starred.select("u", F.col("least").alias("v"))
        )
        now = rounds.next(small.filter("u <> v").distinct(), label)
        # Sums of whole rows' hashes: equal in two rounds when nothing changed.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
