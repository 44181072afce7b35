"""Label maps under windows: clipping, class areas, acceptance, burning and masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import crosswalk
from .spatial import box_join, clip

NEVER_VALID = ("mask", "shadow")


def clip_areas(windows: DataFrame, features: DataFrame, cell: float) -> DataFrame:
    """``(win_id, fid, class_name, area)`` of each feature's part in each window."""
    return clip(box_join(windows, features, cell)).select(F.col("a_win_id").alias("win_id"), F.col("b_fid").alias("fid"), F.col("b_class_name").alias("class_name"), "area")


def valid_class(name: Column, value: Column) -> Column:
    """Mapped to an id above 0 and not named as a mask or a shadow."""
    return F.coalesce((value > 0) & ~F.lower(F.trim(name)).isin(*NEVER_VALID), F.lit(False))


def window_areas(clipped: DataFrame, ids: dict[str, int]) -> DataFrame:
    """Per window: total area and area of valid classes."""
    c = clipped.withColumn("value", crosswalk(F.col("class_name"), ids))
    ok = valid_class(F.col("class_name"), F.col("value"))
    return c.groupBy("win_id").agg(F.sum("area").alias("total_area"), F.coalesce(F.sum(F.when(ok, F.col("area"))), F.lit(0.0)).alias("valid_area"), F.max(ok.cast("int")).alias("has_valid"))


def accept(windows: DataFrame, areas: DataFrame, window_area: float, min_percent: float, allow_empty: bool) -> DataFrame:
    """What becomes of each window: ``label``, ``empty`` (a label tile of zeros) or ``reject``."""
    w = windows.join(areas, "win_id", "left").na.fill({"total_area": 0.0, "valid_area": 0.0, "has_valid": 0})
    good = (F.col("total_area") > 0) & (F.col("has_valid") == 1) & (F.col("valid_area") >= F.lit(min_percent * window_area))
    return w.select("win_id", "total_area", "valid_area", F.when(good, F.lit("label")).otherwise(F.lit("empty" if allow_empty else "reject")).alias("outcome"))


def class_fractions(clipped: DataFrame) -> DataFrame:
    """Each class's share of a window's labelled area. Features without a class stay in the divisor only."""
    per = clipped.groupBy("win_id", "class_name").agg(F.sum("area").alias("area"))
    # A row for each class of a window: the total is a sum over these, so features are joined and shuffled once.
    per = per.withColumn("total", F.sum("area").over(Window.partitionBy("win_id")))
    return per.where("class_name is not null").select("win_id", "class_name", (F.col("area") / F.col("total")).alias("fraction"))


def fraction_map(fractions: DataFrame) -> DataFrame:
    """One row a window, classes in a map."""
    return fractions.groupBy("win_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("class_name", "fraction")))).alias("class_frac"))


def burn(features: DataFrame, value: Column) -> DataFrame:
    """``(r, c, value)``: pixels whose centre lies in a box feature; of several the last one counts."""
    def centres(lo: str, hi: str) -> Column:
        a, b = F.ceil(F.col(lo) - 0.5).cast("long"), (F.ceil(F.col(hi) - 0.5) - 1).cast("long")
        return F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))

    p = features.withColumn("value", value).where("value is not null")
    p = p.select("fid", "value", F.explode(centres("x_min", "x_max")).alias("c"), "y_min", "y_max").select("fid", "value", "c", F.explode(centres("y_min", "y_max")).alias("r"))
    return p.groupBy("r", "c").agg(F.max_by("value", "fid").alias("value"))


def mask_labels(labels: DataFrame, pixels: DataFrame) -> DataFrame:
    """Labels under pixels without data become 0; pixels without a label have 0."""
    return pixels.join(labels, ["r", "c"], "left").select("r", "c", F.when(F.col("v") > 0, F.coalesce("value", F.lit(0))).otherwise(F.lit(0)).alias("value"))
