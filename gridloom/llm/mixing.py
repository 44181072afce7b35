"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.state import numbered
from .staging import drop_staged, stage

#: Sources whose plan is broadcast, at most; a longer plan is joined by shuffle.
BROADCAST_SOURCES = 100_000
#: Documents that the boundary bucket of a source holds, about; only these are put in order.
BUCKET_ROWS = 2_000
WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    """Number of words, native: every word becomes one mark and white space goes (null: 0)."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words with the white space between, and that before the first and after the last. Each word with
    the white space around it is a match of its own: one pattern over them all would recurse a level a word."""
    words = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*+{WORD}[\x20\x09-\x0D]*+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def water_fill(sources: DataFrame, total: float) -> DataFrame:
    """``sources (weight, limit, ...)`` with ``target``: shares of ``total`` by weight, none above its limit.

    What a limited source leaves is shared anew by weight among the others, until none is above. With every source at
    its limit the rest stays unshared; weight 0 gets 0. A round is one sum over a row for each source, and ends when no
    more of them are at their limit: then one level, times weight, is the share of all others.
    """
    at_limit = lambda level: F.col("limit") < F.lit(level) * F.col("weight")
    level, full = 0.0, -1
    while True:
        r = sources.where("weight > 0").agg(F.sum(F.when(at_limit(level), F.col("limit"))).alias("spent"), F.sum(F.when(~at_limit(level), F.col("weight"))).alias("free"), F.count_if(at_limit(level)).alias("n")).first()
        if r["n"] == full or not r["free"]:
            break
        full = r["n"]
        level = max(0.0, (total - (r["spent"] or 0.0)) / r["free"])
    if not r["free"]:
        level = float("inf")  # all stand at their limits
    share = F.when(F.col("weight") > 0, F.least(F.col("limit"), F.lit(level) * F.col("weight"))).otherwise(F.lit(0.0))
    return sources.withColumn("target", share)


def cycle_weights(cycle: Sequence[float] = (5, 2, 1)) -> Callable[[Column], Column]:
    """Weights by a source's place (from 0, in code-point order, null last), from a repeating list."""
    return lambda place: F.element_at(F.array(*(F.lit(float(x)) for x in cycle)), (place % len(cycle) + 1).cast("int"))


def mix(docs: DataFrame, weights: Callable[[Column], Column], *, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None, share: float = 1.5, cap: float = 2.0, seed: int = 17, keep: tuple[str, ...] = ()) -> DataFrame:
    """How much of each document a mix takes.

    Returns ``(id, source, size, source_size, target, repeats, partial, taken)`` and, if columns are to be kept, ``kept``,
    a struct of them. A source's targets come from :func:`water_fill` over all sizes; with r = target / source size every
    document goes in floor(r) times whole. The fraction left over is filled by whole documents in a seeded order of the
    source; the one document that crosses the boundary gives its first ``partial`` words. So a source's taken words
    equal its target, rounded, and no document exceeds ``cap`` times its size when cap is whole.

    Null text: size 0. Null source: a source of its own, the last. Null ids and rows that repeat an id are documents of
    their own; ties in the seeded order are settled by size and the kept columns. An empty table gives no rows.
    """
    size = size if size is not None else word_count(F.col("text"))
    kept = F.struct(*keep) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), kept.alias("kept"))
    rows = stage(rows.withColumn("u", F.xxhash64(F.lit(seed), "id")).withColumn("tie", F.xxhash64("kept") if keep else F.lit(0)), "mix-rows")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).select("*", F.col("source").isNull().alias("none"))
    plan = numbered(per_source, "none", "source", name="place")
    plan = stage(plan.select("source", F.coalesce("size", F.lit(0)).alias("source_size"), "n", weights(F.col("place")).cast("double").alias("weight")).withColumn("limit", F.col("source_size") * F.lit(float(cap))), "mix-sources")
    all_ = plan.agg(F.sum("source_size").alias("size"), F.max("n").alias("most"), F.count("*").alias("n")).first()
    small = all_["n"] <= BROADCAST_SOURCES
    side = F.broadcast if small else (lambda df: df)  # a row for each source
    want = F.rint("target").cast("long")
    filled = water_fill(plan, share * (all_["size"] or 0))
    whole = F.when(F.col("source_size") > 0, F.expr("cast(rint(target) as long) div source_size")).otherwise(F.lit(0))
    filled = stage(filled.select(F.col("source").alias("p_source"), "source_size", "target", whole.alias("whole"), F.when(F.col("source_size") > 0, want - whole * F.col("source_size")).otherwise(F.lit(0)).alias("rest")), "mix-plan")
    drop_staged(plan)
    buckets = max(64, 1 << int((all_["most"] or 0) // BUCKET_ROWS).bit_length())
    rows = rows.withColumn("slot", F.shiftrightunsigned("u", 64 - buckets.bit_length() + 1))
    # Which bucket of the seeded order holds the boundary: sums by (source, bucket), then a running sum in a source.
    sums = rows.groupBy("source", "slot").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    edge = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0))).join(side(filled), F.col("source").eqNullSafe(F.col("p_source"))).where("before < rest and before + sum >= rest")
    edge = edge.select("p_source", F.col("slot").alias("edge"), (F.col("rest") - F.col("before")).alias("left"))
    planned = stage(filled.join(edge.withColumnRenamed("p_source", "e_source"), F.col("p_source").eqNullSafe(F.col("e_source")), "left").drop("e_source"), "mix-edges")
    joined = rows.join(side(planned), F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source")
    whole_in, at_edge = F.col("slot") < F.col("edge"), F.coalesce(F.col("slot") == F.col("edge"), F.lit(False))
    plain = joined.where(~at_edge).withColumn("extra", F.when(whole_in, F.col("size")).otherwise(F.lit(0)))
    run = Window.partitionBy("source").orderBy("u", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    edges = joined.where(at_edge).withColumn("ahead", F.coalesce(F.sum("size").over(run), F.lit(0)))
    edges = edges.withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("left") - F.col("ahead")))).drop("ahead")
    out = plain.unionByName(edges)
    full = (F.col("extra") == F.col("size")) & (F.col("size") > 0)
    return out.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("whole") + full.cast("long")).alias("repeats"),
        F.when(full, F.lit(0)).otherwise(F.col("extra")).cast("long").alias("partial"),
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
        *(["kept"] if keep else []),
    )
