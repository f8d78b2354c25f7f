"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchflow.session import materialise


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Columns node and root (smallest node reachable) for every node of ``edges`` (columns a, b; bigint).

    Each round links the larger neighbours of a node to its smallest neighbour, then the smaller ones; long chains shrink
    by a constant factor per round. Minima are aggregated before the shuffle and joined back, so a node with very many
    neighbours is split like any skewed join key. Loops, copies and nulls are ignored; no edges give no rows.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = _settled(current)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
        small = near.select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct()
        current, now = _settled(small)
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
    if before[0]:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges, written out, and their number and digest."""
    written = materialise(edges, "edges")
    row = written.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")).first()
    return written, (row["n"], row["h"])
