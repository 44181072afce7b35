"""Tables that cut the lineage of loops, in the folder that driver and executors share, and row numbers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Used only by a session on one machine that names no folder (tests).
LOCAL_DEFAULT = "/tmp/checkpoints"


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, else the folder its context was given. A session on one machine that has
    neither gets the local default; on a cluster, where executors would not see such a folder, it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = LOCAL_DEFAULT
    return path.rstrip("/")


def saved(df: DataFrame, name: str, folder: str = "state") -> DataFrame:
    """``df`` written as Parquet to the shared folder, and read from there: lost executors cost a reread."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out


def dropped(df: DataFrame | None) -> None:
    """Delete a table made by :func:`saved` that nothing reads any more. None, or any other table: nothing."""
    path = getattr(df, "_saved_path", None)
    if path:
        sc = df.sparkSession.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def numbered(df: DataFrame, *order: str, name: str = "n", first: int = 0) -> DataFrame:
    """``df`` with its rows numbered in order, without gaps; rows alike in all of ``order`` in any order.

    Rows are dealt into ranges, numbered there and shifted by what comes before, so no task sees them all; the driver
    sees one count a range."""
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = saved(ranged, "ranges")
    counts = sorted((r["_range"], r["n"]) for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect())
    before, total = [], first
    for part, n in counts:
        before.append((part, total))
        total += n
    shifts = F.broadcast(df.sparkSession.createDataFrame(before, "_range int, _before long"))  # a row for each range
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn(name, within).join(shifts, "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")
