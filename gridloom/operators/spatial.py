"""Box joins and footprints without a range join: boxes meet in grid cells and a pair counts in one cell only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("x_min", "y_min", "x_max", "y_max")


def overlaps(a: str, b: str, strict: bool = True) -> Column:
    """Boxes with columns prefixed a and b share area (strict) or at least touch."""
    x0, y0, x1, y1 = ((F.col(f"{a}{k}"), F.col(f"{b}{k}")) for k in BOX)
    if strict:
        return (x0[0] < x1[1]) & (x1[0] > x0[1]) & (y0[0] < y1[1]) & (y1[0] > y0[1])
    return (x0[0] <= x1[1]) & (x1[0] >= x0[1]) & (y0[0] <= y1[1]) & (y1[0] >= y0[1])


def _cells(df: DataFrame, cell: float, to: str) -> DataFrame:
    def span(lo: str, hi: str) -> Column:
        return F.sequence(F.floor(F.col(lo) / cell).cast("long"), F.floor(F.col(hi) / cell).cast("long"))

    return df.select("*", F.explode(span(f"{to}x_min", f"{to}x_max")).alias("cx")).select("*", F.explode(span(f"{to}y_min", f"{to}y_max")).alias("cy"))


def box_join(left: DataFrame, right: DataFrame, cell: float, *, strict: bool = True) -> DataFrame:
    """Pairs of boxes that overlap. Columns come back prefixed ``a_`` and ``b_``. ``cell`` should be about the size
    of the larger boxes: smaller cells copy rows more often, larger ones compare more pairs."""
    a = _cells(left.select(*(F.col(c).alias(f"a_{c}") for c in left.columns)), cell, "a_")
    b = _cells(right.select(*(F.col(c).alias(f"b_{c}") for c in right.columns)), cell, "b_")
    own = (F.col("cx") == F.floor(F.greatest("a_x_min", "b_x_min") / cell)) & (F.col("cy") == F.floor(F.greatest("a_y_min", "b_y_min") / cell))
    return a.join(b, ["cx", "cy"]).where(overlaps("a_", "b_", strict) & own).drop("cx", "cy")


def clip(pairs: DataFrame) -> DataFrame:
    """The common box of each pair and its area."""
    p = pairs.withColumn("x_min", F.greatest("a_x_min", "b_x_min")).withColumn("y_min", F.greatest("a_y_min", "b_y_min")).withColumn("x_max", F.least("a_x_max", "b_x_max")).withColumn("y_max", F.least("a_y_max", "b_y_max"))
    return p.withColumn("area", (F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min")))


def footprint_cells(pixels: DataFrame, cell: int, valid: Column | None = None) -> DataFrame:
    """Coarse cells of data: each cell takes its centre pixel (nearest resampling) and counts if that is valid."""
    ok = valid if valid is not None else F.col("v") != 0
    mid = cell // 2
    return pixels.where((F.pmod("r", F.lit(cell)) == mid) & (F.pmod("c", F.lit(cell)) == mid) & ok).select(F.floor(F.col("c") / cell).alias("cx"), F.floor(F.col("r") / cell).alias("cy")).distinct()


def buffered(cells: DataFrame, reach: int) -> DataFrame:
    """All cells within a Euclidean distance of ``reach`` cells of a footprint cell."""
    d = F.array(*(F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x in range(-reach, reach + 1) for y in range(-reach, reach + 1) if x * x + y * y <= reach * reach))
    return cells.select("cx", "cy", F.explode(d).alias("d")).select((F.col("cx") + F.col("d.dx")).alias("cx"), (F.col("cy") + F.col("d.dy")).alias("cy")).distinct()


def in_footprint(windows: DataFrame, cells: DataFrame, cell: float) -> DataFrame:
    """Windows that touch a footprint cell (closed boxes): a semi join on the cells under a window."""
    def span(lo: str, hi: str) -> Column:
        # A cell's closed box touches a window that ends on its border
        return F.sequence((F.ceil(F.col(lo) / cell) - 1).cast("long"), F.floor(F.col(hi) / cell).cast("long"))

    under = windows.select("*", F.explode(span("x_min", "x_max")).alias("cx")).select("*", F.explode(span("y_min", "y_max")).alias("cy"))
    return under.join(cells, ["cx", "cy"], "left_semi").drop("cx", "cy").distinct()
