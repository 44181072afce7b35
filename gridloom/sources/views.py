"""Rasters, maps, tiles and series as views over the driver's tables, with the same definitions as DuckDB SQL.

Pixel (r, c) covers [c, c + 1) x [r, r + 1); 0 means no data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE_CLASSES = ("Fines", "Sand", "Gravel", " BOULDER ", "mask", "shadow", "unknown")
FEATURE_IDS = {"fines": 1, "sand": 2, "gravel": 3, "boulder": 4, "mask": 255, "shadow": 5}
PRIORITY_IDS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 0}
PIXEL_WIDTH, LABEL_WIDTH, CHUNK = 40, 100, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raster_id, r, c, v)"""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(F.lit("part").alias("raster_id"), F.expr(f"p_partkey div {PIXEL_WIDTH}").alias("r"), (key % PIXEL_WIDTH).alias("c"), F.when(size <= 10, 0).otherwise(size * 5).alias("v"))


def label_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, v, class_name, cls)"""
    ids = F.create_map(*(F.lit(x) for kv in PRIORITY_IDS.items() for x in kv))
    return table(spark, sf_dir, "orders").select(
        F.expr(f"o_orderkey div {LABEL_WIDTH}").alias("r"), (F.col("o_orderkey") % LABEL_WIDTH).alias("c"),
        F.when(F.col("o_orderstatus") == "P", F.lit(0)).otherwise(F.floor(F.col("o_totalprice") / 2000)).cast("long").alias("v"),
        F.col("o_orderpriority").alias("class_name"), F.element_at(ids, F.col("o_orderpriority")).alias("cls"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fid, x_min, y_min, x_max, y_max, class_name): box-shaped map features"""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("fid"), (k * 7 % 100).cast("double").alias("x_min"), (k * 13 % 150).cast("double").alias("y_min"), "s_nationkey")
    name = F.element_at(F.array(*map(F.lit, FEATURE_CLASSES)), (F.col("s_nationkey") % 7 + 1).cast("int"))
    return s.select("fid", "x_min", "y_min", (F.col("x_min") + 3 + F.col("fid") % 9).alias("x_max"), (F.col("y_min") + 3 + F.col("fid") % 5).alias("y_max"), name.alias("class_name"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tile_id, x_min, y_min, x_max, y_max, t): 4 classes x 4 rows x 4 columns, row 0 at the top; stride 2"""
    v = F.col("vec_id")
    e = table(spark, sf_dir, "embeddings").select(v.alias("tile_id"), (v % 25 * 2).cast("double").alias("x_min"), F.expr("cast(vec_id div 25 * 2 as double)").alias("y_min"), F.col("embedding").alias("t"))
    return e.select("tile_id", "x_min", "y_min", (F.col("x_min") + 4).alias("x_max"), (F.col("y_min") + 4).alias("y_max"), "t")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(transect, ping, chunk, ping_cnt, dep_bin, event_type, value)"""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").withColumn("transect", F.col("user_id") % 10)
    order = Window.partitionBy("transect").orderBy("ts", "event_id")
    e = e.withColumn("ping", (F.row_number().over(order) - 1).cast("long"))
    return e.select("transect", "ping", F.expr(f"ping div {CHUNK}").alias("chunk"), (F.floor("value") + 1).cast("long").alias("ping_cnt"), (F.col("event_id") % 7).alias("dep_bin"), "event_type", "value")


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("path"))


_CLASSES = "[" + ", ".join(f"'{c}'" for c in FEATURE_CLASSES) + "]"
_PRIORITIES = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITY_IDS.items()) + " END"
SQL = {
    "v_pixels": f"SELECT 'part' AS raster_id, p_partkey // {PIXEL_WIDTH} AS r, p_partkey % {PIXEL_WIDTH} AS c, CASE WHEN p_size <= 10 THEN 0 ELSE p_size * 5 END AS v FROM part",
    "v_label_pixels": f"SELECT o_orderkey // {LABEL_WIDTH} AS r, o_orderkey % {LABEL_WIDTH} AS c, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE floor(o_totalprice / 2000)::BIGINT END AS v, o_orderpriority AS class_name, {_PRIORITIES} AS cls FROM orders",
    "v_features": f"SELECT fid, x_min, y_min, x_min + 3 + fid % 9 AS x_max, y_min + 3 + fid % 5 AS y_max, {_CLASSES}[1 + k % 7] AS class_name FROM (SELECT s_suppkey AS fid, (s_suppkey * 7 % 100)::DOUBLE AS x_min, (s_suppkey * 13 % 150)::DOUBLE AS y_min, s_nationkey AS k FROM supplier)",
    "v_tiles": "SELECT vec_id AS tile_id, (vec_id % 25 * 2)::DOUBLE AS x_min, (vec_id // 25 * 2)::DOUBLE AS y_min, (vec_id % 25 * 2 + 4)::DOUBLE AS x_max, (vec_id // 25 * 2 + 4)::DOUBLE AS y_max, embedding AS t FROM embeddings",
    "v_pings": f"SELECT transect, ping, ping // {CHUNK} AS chunk, (floor(value) + 1)::BIGINT AS ping_cnt, event_id % 7 AS dep_bin, event_type, value FROM (SELECT *, user_id % 10 AS transect, row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) - 1 AS ping FROM events)",
    "v_paths": "SELECT page_id AS id, url AS path FROM pages",
}


def sql(query: str) -> str:
    """``query`` with the views it names put before it."""
    used = [f"{name} AS ({text})" for name, text in SQL.items() if name in query]
    body = query.strip()
    if not used:
        return body
    recursive = body.upper().startswith("WITH RECURSIVE")
    rest = body[len("WITH RECURSIVE") :] if recursive else body[len("WITH") :] if body.upper().startswith("WITH") else ""
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(used) + (", " + rest.strip() if rest else " " + body)
