"""Along-track series: modal range, chunk pairs, sliding windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def modal_range(pings: DataFrame) -> DataFrame:
    """Commonest ping length and depth bin of each transect; the smallest on ties."""
    return pings.groupBy("transect").agg(F.mode("ping_cnt", True).alias("ping_max"), F.mode("dep_bin", True).alias("dep_mode"))


def depth_range(pings: DataFrame, order: str = "ping") -> DataFrame:
    """Rows to keep of each transect: the commonest ping length, and for water-column tiles the commonest depth in
    pixels of its first ping, cut to a whole number, and 50 more. The smallest on ties."""
    mode = pings.groupBy("transect").agg(F.mode("ping_cnt", True).alias("ping_max"), F.mode("dep_m", True).alias("dep"), F.min_by("pixM", order).alias("pix"))
    return mode.select("transect", F.col("ping_max").cast("long").alias("ping_max"), (F.try_divide("dep", "pix").cast("long") + 50).alias("dep_max"))


def fit_height(strips: DataFrame, ranges: DataFrame, water_column: bool = False) -> DataFrame:
    """``strips (transect, c, r, v)`` cut below the transect's range, or filled up with 0 to it."""
    size = ranges.select("transect", F.col("dep_max" if water_column else "ping_max").alias("size"))
    return pad_trim(strips.join(size, "transect"), F.col("size"), ("transect", "c"), "r", "v")


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """Each chunk with the one after it in its transect; null after the last."""
    w = Window.partitionBy("transect").orderBy("chunk")
    return chunks.select("transect", "chunk", F.lead("chunk").over(w).alias("next_chunk"))


def sliding(pings: DataFrame, width: int, stride: int, value: Column) -> DataFrame:
    """Windows of ``width`` pings over a chunk and the next, starting in the chunk every ``stride`` (0 counts as 1);
    past the last chunk there is nothing to sum. Per window: pings and sum."""
    step = max(1, stride)
    n = pings.groupBy("transect", "chunk").agg(F.count("*").alias("size"), F.min("ping").alias("first"))
    starts = n.select("transect", "chunk", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.least("size", F.lit(width)) - 1, F.lit(step).cast("long"))).alias("start"))
    # A ping belongs to the starts at or before it that are less than a window away, in its chunk or the one before.
    p = pings.select("transect", "ping", value.alias("x"), F.explode(F.array(F.col("chunk"), F.col("chunk") - 1)).alias("chunk"))
    met = p.join(starts, ["transect", "chunk"]).where((F.col("ping") >= F.col("first") + F.col("start")) & (F.col("ping") < F.col("first") + F.col("start") + width))
    return met.groupBy("transect", "chunk", "start").agg(F.count("*").alias("pings"), F.sum("x").alias("total"))


def window_cells(strips: DataFrame, width: int, stride: int) -> DataFrame:
    """``(transect, chunk, start, r, c, v)``: the cells of windows over image strips ``(transect, chunk, r, c, v)``.

    A chunk's strip, filled up to ``width`` columns, is followed by the next one's. Windows of ``width`` columns start
    every ``stride`` (0 counts as 1) while they start on a column that the chunk has; cells without a value are not
    returned and count as 0."""
    step = max(1, stride)
    size = strips.groupBy("transect", "chunk").agg((F.max("c") + 1).alias("size"))
    cells = strips.select("transect", "r", "v", F.explode(F.array(F.struct("chunk", "c"), F.struct((F.col("chunk") - 1).alias("chunk"), (F.col("c") + width).alias("c")))).alias("p")).select("transect", "p.chunk", "p.c", "r", "v")
    first, last = F.greatest(F.lit(0), F.ceil((F.col("c") - width + 1) / step)), F.least(F.floor(F.col("c") / step), F.floor((F.col("size") - 1) / step))
    met = cells.join(size, ["transect", "chunk"]).withColumn("a", first.cast("long")).withColumn("b", last.cast("long")).where("a <= b")
    met = met.select("transect", "chunk", "r", "c", "v", F.explode(F.sequence("a", "b")).alias("k")).withColumn("start", F.col("k") * step)
    return met.select("transect", "chunk", "start", "r", (F.col("c") - F.col("start")).alias("c"), "v")


def pad_trim(strips: DataFrame, size: Column, keys: tuple[str, ...], place: str, value: str) -> DataFrame:
    """Each series cut or padded with 0 to ``size`` places (a column of ``strips``, one for each series)."""
    grid = strips.groupBy(*keys).agg(F.max(size).alias("size")).where("size > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("size").cast("long") - 1)).alias(place))
    return grid.join(strips.select(*keys, place, value), [*keys, place], "left").select(*keys, place, F.coalesce(value, F.lit(0)).alias(value))
