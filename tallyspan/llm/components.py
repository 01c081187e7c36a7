"""Connected components of an edge table by large-star and small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Edge cases. Repeated edges, either way round, count once; an edge of a node to
itself, or with a null end, is no edge. No edges: no rows. Ties: none, as a
component has one smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.session import ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(moved.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(id, component) for every id in edges (u, v: long); component is the
    smallest id reachable. Each round is checkpointed, and its size and sum
    tell when nothing moves any more."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    seen = None
    for _ in range(most_rounds):
        now = _small_star(_large_star(now)).checkpoint()
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    ids = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
