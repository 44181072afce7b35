"""Pairing of files by their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import stem


def first_by_base(files: DataFrame) -> DataFrame:
    """``(base, path)``: of several files with one base name the first path."""
    return files.groupBy(stem(F.col("path")).alias("base")).agg(F.min("path").alias("path"))


def duplicates(files: DataFrame) -> DataFrame:
    return files.groupBy(stem(F.col("path")).alias("base")).agg(F.count("*").alias("n")).where("n > 1")


def paired(mosaics: DataFrame, maps: DataFrame) -> DataFrame:
    """Each mosaic with the map of its name; null where there is none."""
    m = first_by_base(maps).select("base", F.col("path").alias("map"))
    return mosaics.select(F.col("path").alias("mosaic"), stem(F.col("path")).alias("base")).join(m, "base", "left").select("mosaic", "map")


def with_tensors(manifest: DataFrame, tensors: DataFrame, tile: str = "tile") -> DataFrame:
    """``manifest`` with the probabilities ``(classes, height, width, t)`` of the file of the tile's name, whatever the
    folder and the type; tiles without one go, and of several files of a name the one with the least numbers counts."""
    base = F.regexp_replace(stem(F.col(tile)), r"\.png$", "")
    first = tensors.groupBy("base").agg(F.min(F.struct("classes", "height", "width", "t")).alias("p"))
    return manifest.withColumn("base", base).join(first, "base").select(*manifest.columns, "p.*")


def unmatched(mosaics: DataFrame, maps: DataFrame) -> DataFrame:
    m = maps.select(stem(F.col("path")).alias("base"))
    return mosaics.select(F.col("path").alias("mosaic"), stem(F.col("path")).alias("base")).join(m, "base", "left_anti").select("mosaic")
