"""Connected components of an edge table, on Spark alone (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import written


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
    return tuple(r)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component = the smallest node of it.

    Each round lets every node point its larger neighbours (large star), then
    its smaller ones (small star), at the smallest it knows; the edge table
    stays linear in the nodes and the number of rounds logarithmic in the
    longest chain. Minima are partial aggregates and the joins back are plain
    equi-joins, so a node with very many neighbours is split by AQE. Every
    round is written to the shared folder. Null ends and self-loops are
    ignored, repeated edges count once; an empty table gives no rows.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")
    before = _fingerprint(e)
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = written(small, "edges")
        now = _fingerprint(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
