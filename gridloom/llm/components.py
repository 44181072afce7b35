"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import drop_staged, stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the least of u and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, *, max_rounds: int = 100) -> DataFrame:
    """``(u, v)``: each node above the least of its component, with that least node; edges are columns u and v.

    Minima are combined before the shuffle and each round writes a table, so a star with very many rays neither
    meets in one task nor carries lineage. Loops (u = v) and null ends are left out; no edges: no rows.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            return now
        after = stage(_small_star(_large_star(now)), "edges")
        drop_staged(now)
        now, before, state = after, state, _state(after)
        if state == before:
            return now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
