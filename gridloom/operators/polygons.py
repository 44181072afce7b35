"""Polygons as rings, ``array<array<array<double>>>``: holes run the other way round than outlines. Areas, clipping to
boxes, burning into grids, projections and WKT; all in column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs
from .spatial import box_join

_POINTS = "array<array<double>>"


def _each(ring: Column, make: Callable[[Column, Column], Column], empty: Column) -> Column:
    """``make(point, next point)`` along a ring, which closes by itself."""
    n = F.size(ring)
    at = lambda i: F.element_at(ring, i)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: make(at(i), at(i % n + 1)))).otherwise(empty)


def ring_area(rings: str | Column = "rings") -> Column:
    """Area by the shoelace formula; holes take away."""
    rings = F.col(rings) if isinstance(rings, str) else rings
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    one = lambda ring: total(_each(ring, lambda p, q: p[0] * q[1] - q[0] * p[1], F.array().cast("array<double>")))
    return F.abs(total(F.transform(rings, one))) / 2


def inside(point: Column, ring: Column) -> Column:
    """A point within a ring, by the parity of the edges to its left."""
    x, y = point[0], point[1]
    left = _each(ring, lambda p, q: ((p[1] <= y) != (q[1] <= y)) & (F.try_divide((y - p[1]) * (q[0] - p[0]), q[1] - p[1]) + p[0] <= x), F.array().cast("array<boolean>"))
    return F.size(F.filter(left, lambda x: F.coalesce(x, F.lit(False)))) % 2 == 1


def with_box(features: DataFrame, rings: str = "rings") -> DataFrame:
    """``features`` with the box around their rings; those without points have none."""
    points = F.flatten(F.col(rings))
    return features.select("*", *(f(F.transform(points, lambda p: p[k])).alias(f"{n}_{e}") for k, n in ((0, "x"), (1, "y")) for e, f in (("min", F.array_min), ("max", F.array_max))))


def _half(ring: Column, axis: int, bound: Column, sign: int) -> Column:
    """The part of a ring on one side of a line along the other axis. Where it leaves and comes back it follows the
    line, so areas are right for rings of any shape."""

    def step(p: Column, q: Column) -> Column:
        a, b = sign * (p[axis] - bound), sign * (q[axis] - bound)
        t = F.try_divide(a, a - b)
        cut = F.array(p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
        return F.when((a >= 0) & (b >= 0), F.array(q)).when(a >= 0, F.array(cut)).when(b >= 0, F.array(cut, q)).otherwise(F.array().cast(_POINTS))

    return F.flatten(_each(ring, step, F.array().cast(f"array<{_POINTS}>")))


def clipped(pairs: DataFrame, rings: str, x_min: str, y_min: str, x_max: str, y_max: str) -> DataFrame:
    """``pairs`` with the rings cut to a box; a side at a time, so that each result is made once."""
    for axis, bound, sign in ((0, x_min, 1), (0, x_max, -1), (1, y_min, 1), (1, y_max, -1)):
        cut = F.transform(F.col(rings), lambda r: _half(r, axis, F.col(bound), sign))  # noqa: B023
        pairs = pairs.withColumn(rings, F.filter(cut, lambda r: F.size(r) > 0))
    return pairs


def clip_areas(windows: DataFrame, features: DataFrame, cell: float) -> DataFrame:
    """``(win_id, fid, class_name, area, rings)`` of each feature's part in each window; parts without area go."""
    pairs = box_join(windows.select("win_id", "x_min", "y_min", "x_max", "y_max"), with_box(features.select("fid", "class_name", "rings")), cell)
    cut = clipped(pairs, "b_rings", "a_x_min", "a_y_min", "a_x_max", "a_y_max").withColumn("area", ring_area("b_rings")).where("area > 0")
    return cut.select(F.col("a_win_id").alias("win_id"), F.col("b_fid").alias("fid"), F.col("b_class_name").alias("class_name"), "area", F.col("b_rings").alias("rings"))


def burn(features: DataFrame, value: Column, x0: float = 0.0, y0: float = 0.0, res: tuple[float, float] = (1.0, -1.0)) -> DataFrame:
    """``(r, c, value)``: pixels whose centre lies in a polygon; of several the last one counts.

    Pixel (r, c) begins at ``x0 + c * res[0]``, ``y0 - r * res[1]``. Each edge gives a crossing to the rows of centres it
    passes; a row's crossings, in order, begin and end the runs inside. So the work is that of the outline and of what is
    burnt, however large the polygon's box."""
    rx, ry = res
    f = features.withColumn("value", value).where("value is not null").select("fid", "value", F.explode("rings").alias("ring"))
    edge = lambda p, q: F.struct(p[0].alias("xa"), p[1].alias("ya"), q[0].alias("xb"), q[1].alias("yb"))
    none = F.array().cast("array<struct<xa:double,ya:double,xb:double,yb:double>>")
    e = f.select("fid", "value", F.explode(_each(F.col("ring"), edge, none)).alias("e")).select("fid", "value", "e.*").where("ya <> yb")
    # Rows whose centre is at or above the lower end and below the upper one
    place = lambda y: (F.lit(y0) - F.col(y)) / F.lit(ry) - 0.5
    a, b = (F.least(place("ya"), place("yb")), F.greatest(place("ya"), place("yb")))
    first, last = (F.floor(a) + 1, F.floor(b)) if ry > 0 else (F.ceil(a), F.ceil(b) - 1)
    e = e.withColumn("first", first.cast("long")).withColumn("last", last.cast("long")).where("first <= last")
    e = e.select("*", F.explode(F.sequence("first", "last")).alias("r"))
    y = F.lit(y0) - (F.col("r") + 0.5) * F.lit(ry)
    x = F.col("xa") + (y - F.col("ya")) / (F.col("yb") - F.col("ya")) * (F.col("xb") - F.col("xa"))
    runs = e.select("fid", "value", "r", ((x - F.lit(x0)) / F.lit(rx)).alias("x")).groupBy("fid", "value", "r").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pair = F.sequence(F.lit(1), F.size("xs") - 1, F.lit(2))
    begin, end = (lambda i: F.ceil(F.element_at("xs", i) - 0.5)), (lambda i: F.ceil(F.element_at("xs", i + 1) - 0.5) - 1)
    spans = runs.where("size(xs) > 1").select("fid", "value", "r", F.explode(F.transform(pair, lambda i: F.struct(begin(i).alias("a"), end(i).alias("b")))).alias("s")).where("s.a <= s.b")
    cells = spans.select("fid", "value", "r", F.explode(F.sequence("s.a", "s.b")).alias("c"))
    return cells.groupBy("r", "c").agg(F.max_by("value", "fid").alias("value"))


def reprojected(features: DataFrame, source: int, target: int, rings: str = "rings") -> DataFrame:
    """Each point of the rings in another coordinate system."""

    def moved(p: Column) -> Column:
        return F.array(*crs.reproject(p[0], p[1], source, target))

    return features.withColumn(rings, F.transform(rings, lambda r: F.transform(r, moved)))


def from_wkt(text: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON; null for other texts and for numbers that are none."""
    number = lambda p, i: F.get(F.split(F.trim(p), r"\s+"), F.lit(i)).try_cast("double")
    rings = F.transform(F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda r: F.transform(F.split(r, ","), lambda p: F.array(number(p, 0), number(p, 1))))
    whole = F.forall(F.flatten(rings), lambda p: p[0].isNotNull() & p[1].isNotNull())
    return F.when(text.rlike(r"(?i)^\s*(MULTI)?POLYGON\b") & whole, rings)


def to_wkt(rings: Column) -> Column:
    """A POLYGON of these rings, closed; EMPTY without any."""
    point = lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))
    closed = lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1)))
    ring = lambda r: F.concat(F.lit("("), F.concat_ws(", ", F.transform(closed(r), point)), F.lit(")"))
    return F.when(F.size(rings) > 0, F.concat(F.lit("POLYGON ("), F.concat_ws(", ", F.transform(rings, ring)), F.lit(")"))).otherwise("POLYGON EMPTY")
