"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import gc
import threading

from pyspark.sql import DataFrame, SparkSession

from ..operators.state import dropped, saved

#: Seconds after which the driver is asked to collect garbage.
RELEASE_AFTER = 2.0


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the written table.

    Lost executors cost a reread, not a recomputation, and later passes read only the columns they use.
    """
    return saved(df, name, "staged")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps soon. Its cleaner does so when the driver collects garbage,
    which with a large heap may be long after; steps that shuffle whole texts call this when what they wrote is staged.
    The bridge to Java lets go of objects a second after Python has, so the driver is asked a little later, meanwhile the
    next step begins."""
    gc.collect()  # writers and frames that refer to each other hold their plans
    later = threading.Timer(RELEASE_AFTER, _collect, [spark])
    later.daemon = True
    later.start()


def _collect(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        spark.sparkContext._jvm.System.gc()


def drop_staged(*tables: DataFrame | None) -> None:
    """Delete tables made by :func:`stage` that nothing reads any more."""
    for df in tables:
        dropped(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
