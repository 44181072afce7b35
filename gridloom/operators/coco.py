"""Annotations in the COCO layout, from class masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import extension, stem
from .regions import rings, simplify
from .state import numbered

#: Image types by preference.
TYPES = ("png", "jpg", "jpeg", "tif", "tiff")


def boxes(labelled: DataFrame) -> DataFrame:
    """Per region (not class 0): bounding box and contour area. The contour runs through pixel centres, so what is
    one pixel wide has no area and goes, and a full w x h block has (w - 1) * (h - 1)."""
    p = labelled.where("cls <> 0")
    b = p.groupBy("comp", "cls").agg(F.min("c").alias("x"), F.min("r").alias("y"), (F.max("c") - F.min("c") + 1).alias("w"), (F.max("r") - F.min("r") + 1).alias("h"))
    # Area of the polygon through border pixels' centres: full squares of 2 x 2 pixels, and halves for three of four.
    corner = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(c).alias("b")) for a in (0, 1) for c in (0, 1)))).alias("k")
    quad = p.select("comp", (F.col("r")).alias("r"), F.col("c").alias("c"), corner).select("comp", (F.col("r") - F.col("k.a")).alias("qr"), (F.col("c") - F.col("k.b")).alias("qc")).groupBy("comp", "qr", "qc").agg(F.count("*").alias("n"))
    area = quad.groupBy("comp").agg(F.sum(F.when(F.col("n") == 4, 1.0).when(F.col("n") == 3, 0.5).otherwise(0.0)).alias("area"))
    return b.join(area, "comp").where("area > 0")


def images(files: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """``(id, file_name, width, height)``, numbered from 1 by name; only those that ``used`` names, if given."""
    f = files.join(used, "file_name", "left_semi") if used is not None else files
    return numbered(f.select("file_name", "width", "height"), "file_name", name="id", first=1).select(F.col("id").cast("long").alias("id"), "file_name", "width", "height")


def categories(names: dict[int, str]) -> list[tuple[int, str]]:
    """Class 0 is background and no category."""
    return [(k, v) for k, v in sorted(names.items()) if k != 0]


def annotations(regions: DataFrame) -> DataFrame:
    """``(id, image_id, category_id, bbox, area, iscrowd, comp)``, numbered from 1 without gaps by image, category, place.
    The numbers run over regions already cut down to one row each."""
    own = numbered(regions, "image_id", "cls", "y", "x", "comp", name="id", first=1)
    return own.select(F.col("id").cast("long").alias("id"), "image_id", F.col("cls").alias("category_id"), F.array("x", "y", "w", "h").alias("bbox"), "area", F.lit(0).alias("iscrowd"), "comp")


def segmentation(labelled: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Simplified outer outlines, flat: ``(comp, segmentation)``; those of fewer than three points go."""
    r = simplify(rings(labelled.where("cls <> 0")), tolerance).where("part = 0 and size(ring) >= 3")
    return r.select("comp", F.flatten("ring").alias("segmentation"))


def match_masks(masks: DataFrame, images_: DataFrame, keep_unmatched: bool) -> DataFrame:
    """Each mask with the image of its name, of several types the first in ``TYPES``; without one it goes, or keeps
    its own name."""
    ranked = images_.select(stem(F.col("path")).alias("base"), F.col("path").alias("image"), F.array_position(F.array(*map(F.lit, TYPES)), extension(F.col("path"))).alias("rank")).where("rank > 0")
    first = ranked.groupBy("base").agg(F.min_by("image", F.struct("rank", "image")).alias("image"))
    out = masks.select(F.col("path").alias("mask"), stem(F.col("path")).alias("base")).join(first, "base", "left" if keep_unmatched else "inner")
    return out.select("mask", F.coalesce("image", "mask").alias("image"))


def document(images_: DataFrame, annotations_: DataFrame, names: dict[int, str]) -> DataFrame:
    """The whole COCO document as one JSON text. One row by its nature; write large sets as tables instead."""
    spark = images_.sparkSession
    cats = spark.createDataFrame(categories(names), "id int, name string")
    part = lambda df, n: df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(n))
    doc = part(images_, "images").crossJoin(part(annotations_, "annotations")).crossJoin(part(cats, "categories"))
    return doc.select(F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("info"), F.array().cast("array<string>").alias("licenses"), "images", "annotations", "categories")).alias("json"))
