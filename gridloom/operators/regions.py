"""Connected regions of class rasters: labelling, clean-up, polygons and patch merging.

Labelling works on blocks of bounded size in parallel; only pixels at block borders are then matched, and the regions
they join are relabelled by a loop over regions, not pixels.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import dropped, saved

#: Rows and columns of a block.
BLOCK = 256


def _steps(connectivity: int) -> list[tuple[int, int]]:
    return [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if connectivity == 8 else [])


def _label_block(connectivity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c, v = (pdf[k].to_numpy() for k in ("r", "c", "cls"))
        r0, c0 = r.min(), c.min()
        grid = np.full((int(r.max() - r0) + 1, int(c.max() - c0) + 1), -1, dtype=np.int64)
        grid[r - r0, c - c0] = np.arange(len(r))
        root = np.arange(len(r))
        a, b = [], []
        for dr, dc in _steps(connectivity):
            x = grid[: grid.shape[0] - dr, max(0, -dc) : grid.shape[1] - max(0, dc)]
            y = grid[dr:, max(0, dc) : grid.shape[1] - max(0, -dc)]
            ok = (x >= 0) & (y >= 0)
            p, q = x[ok], y[ok]
            same = v[p] == v[q]
            a.append(p[same])
            b.append(q[same])
        a, b = np.concatenate(a), np.concatenate(b)
        while True:  # hook the larger root to the smaller, then shorten
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (root[root] != root).any():
                root = root[root]
        order = np.lexsort((c, r))
        rank = np.empty(len(r), dtype=np.int64)
        rank[order] = np.arange(len(r))
        first = np.full(len(r), len(r), dtype=np.int64)
        np.minimum.at(first, root, rank)
        lead = order[first[root]]
        return pd.DataFrame({"r": r, "c": c, "cls": v, "comp": r[lead] * _WIDE + c[lead]})

    return run


#: A region is named by its first pixel in reading order: row * _WIDE + column.
_WIDE = 1 << 31


def components(pixels: DataFrame, *, connectivity: int = 8, background: int | None = 0, block: int = BLOCK) -> DataFrame:
    """``(r, c, cls, comp)``: regions of one class, 4- or 8-connected; ``comp`` names the region's first pixel in
    reading order. Pixels of the background class go. ``r`` and ``c`` are not negative."""
    p = pixels.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), F.col("cls").cast("int").alias("cls"))
    p = p.where(F.col("cls") != background) if background is not None else p
    blocks = p.groupBy(F.floor(F.col("r") / block).alias("br"), F.floor(F.col("c") / block).alias("bc"))
    local = saved(blocks.applyInPandas(_label_block(connectivity), "r long, c long, cls int, comp long"), "blocks")
    edge = local.where((F.col("r") % block).isin(0, block - 1) | (F.col("c") % block).isin(0, block - 1))
    steps = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in _steps(connectivity)))
    there = edge.select("cls", F.col("comp").alias("a"), F.explode(steps).alias("s"), "r", "c").select("cls", "a", (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"))
    links = there.join(edge.select("r", "c", "cls", F.col("comp").alias("b")), ["r", "c", "cls"]).where("a <> b").select("a", "b").distinct()
    roots = connected(links)
    return local.join(roots.select(F.col("node").alias("comp"), "root"), "comp", "left").select("r", "c", "cls", F.coalesce("root", "comp").alias("comp"))


def connected(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` over undirected links ``(a, b)``: the least node reached. Minimum labels spread along links
    and along the labels themselves, so chains shorten by half a round."""
    both = saved(links.union(links.select("b", "a")).distinct(), "links")
    now = table = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    for _ in range(max_rounds):
        near = both.join(now.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").groupBy(F.col("a").alias("node")).agg(F.min("rb").alias("m"))
        step = now.join(near, "node").select("node", "root", F.least("root", "m").alias("new"))
        jump = step.join(step.select(F.col("node").alias("new"), F.col("new").alias("further")), "new", "left").select("node", "root", F.least("new", F.coalesce("further", "new")).alias("new"))
        after = saved(jump, "roots")
        dropped(table)
        table = after
        if not after.where("new <> root").limit(1).count():
            dropped(both)
            return after.select("node", F.col("new").alias("root"))
        now = after.select("node", F.col("new").alias("root"))
    raise RuntimeError("regions did not settle")


def sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("comp").agg(F.first("cls").alias("cls"), F.count("*").alias("size"))


def without_small(labelled: DataFrame, min_size: int) -> DataFrame:
    """Pixels of regions of at least ``min_size``; all of them if there is at most one region."""
    s = sizes(labelled)
    many = s.limit(2).count() > 1
    return labelled.join(s.where(F.col("size") >= min_size), "comp", "left_semi") if many else labelled


def fill_holes(mask: DataFrame, min_size: int) -> DataFrame:
    """``mask (r, c, cls)`` of 0 and 1 with 4-connected regions of 0 below ``min_size`` set to 1."""
    zeros = components(mask.where("cls = 0"), connectivity=4, background=None)
    small = sizes(zeros).where(F.col("size") < min_size)
    holes = zeros.join(small, "comp", "left_semi").select("r", "c", F.lit(1).alias("hole"))
    return mask.join(holes, ["r", "c"], "left").select("r", "c", F.coalesce("hole", "cls").cast("int").alias("cls"))


def flood(labels: DataFrame, mask: DataFrame) -> DataFrame:
    """Labels ``(r, c, cls)`` spread to the 4-connected pixels of ``mask (r, c)``; nearest first, the lower class on
    ties. Unreached pixels have 0.

    What a rim reaches next to it was reached a round before it, with it, or is new, so a round looks at two rims only,
    however large the area behind them. It ends when nothing new is reached."""
    steps = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))))
    area = saved(mask.select("r", "c").distinct(), "mask")
    done = [saved(labels.where("cls > 0").join(area, ["r", "c"]).select("r", "c", "cls"), "rim")]
    while True:
        near = done[-1].select("cls", F.explode(steps).alias("s"), "r", "c").select((F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"), "cls")
        known = reduce(DataFrame.union, done[-2:]).select("r", "c")
        rim = saved(near.join(known, ["r", "c"], "left_anti").join(area, ["r", "c"], "left_semi").groupBy("r", "c").agg(F.min("cls").alias("cls")), "rim")
        if not rim.limit(1).count():
            break
        done.append(rim)
        if len(done) > 32:  # so that the plan does not grow with the rounds
            old = done[:-2]
            done = [saved(reduce(DataFrame.union, old), "rims"), *done[-2:]]
            for x in old:
                dropped(x)
    return area.join(reduce(DataFrame.union, done), ["r", "c"], "left").select("r", "c", F.coalesce("cls", F.lit(0)).alias("cls"))


def clean_labels(pixels: DataFrame, min_size: int) -> DataFrame:
    """Small regions out, small holes filled, and the classes flooded into what was filled."""
    labelled = components(pixels, connectivity=8)
    kept = without_small(labelled, min_size).select("r", "c", "cls")
    grid = pixels.select("r", "c").join(kept.select("r", "c", F.lit(1).alias("on")), ["r", "c"], "left").select("r", "c", F.coalesce("on", F.lit(0)).alias("cls"))
    filled = fill_holes(grid, min_size).where("cls = 1").select("r", "c")
    grown = flood(kept, filled)
    return pixels.select("r", "c").join(grown, ["r", "c"], "left").select("r", "c", F.coalesce("cls", F.lit(0)).alias("cls"))


def polygons(pixels: DataFrame, pixel_area: float = 1.0) -> DataFrame:
    """4-connected regions of every class: ``(comp, cls, area_m, r_min, c_min, r_max, c_max)``."""
    p = components(pixels, connectivity=4, background=None)
    return p.groupBy("comp", "cls").agg((F.count("*") * F.lit(pixel_area)).alias("area_m"), *(f(k).alias(f"{k}_{n}") for n, f in (("min", F.min), ("max", F.max)) for k in ("r", "c")))


def rings(labelled: DataFrame) -> DataFrame:
    """Outline of each region as pixel edges, with the region on their left: ``(comp, x0, y0, x1, y1)``."""
    sides = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("dr", "dc", "x0", "y0", "x1", "y1"), s))) for s in ((-1, 0, 1, 0, 0, 0), (1, 0, 0, 1, 1, 1), (0, -1, 0, 0, 0, 1), (0, 1, 1, 1, 1, 0))))
    e = labelled.select("comp", "r", "c", F.explode(sides).alias("s")).select("comp", "r", "c", "s.*").withColumn("nr", F.col("r") + F.col("dr")).withColumn("nc", F.col("c") + F.col("dc"))
    inner = labelled.select(F.col("r").alias("nr"), F.col("c").alias("nc"), "comp")
    out = e.join(inner, ["nr", "nc", "comp"], "left_anti")
    return out.select("comp", *((F.col("c") + F.col(k)).alias(k) if k[0] == "x" else (F.col("r") + F.col(k)).alias(k) for k in ("x0", "y0", "x1", "y1")))


def adjacency(labelled: DataFrame, touch: int = 8, reach: float = 0.0) -> DataFrame:
    """Pairs of different regions that touch, both ways: ``(comp, nbr)``; or that lie within ``reach`` pixels of each
    other, from edge to edge."""
    far = int(reach) + 1
    gap = lambda d: max(abs(d) - 1, 0)
    offsets = [(a, b) for a in range(far + 1) for b in range(-far, far + 1) if (a, b) > (0, 0) and gap(a) ** 2 + gap(b) ** 2 <= reach * reach] if reach > 0 else _steps(touch)
    steps = F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in offsets))
    there = labelled.select("comp", F.explode(steps).alias("s"), "r", "c").select("comp", (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"))
    one = there.join(labelled.select("r", "c", F.col("comp").alias("nbr")), ["r", "c"]).where("comp <> nbr").select("comp", "nbr").distinct()
    return one.union(one.select("nbr", "comp")).distinct()


def receivers(patches: DataFrame, neighbours: DataFrame, min_area: float) -> DataFrame:
    """One pass of merging: ``(comp, into)`` for each patch below ``min_area`` that has a neighbour: its largest one by
    area at the start of the pass, the lowest name on ties."""
    small = patches.where(F.col("area") < min_area).select("comp")
    options = neighbours.join(small, "comp").join(patches.select(F.col("comp").alias("nbr"), "area"), "nbr")
    return options.groupBy("comp").agg(F.max_by("nbr", F.struct("area", -F.col("nbr"))).alias("into"))


def settle(moves: DataFrame, patches: DataFrame) -> DataFrame:
    """``(comp, root)``: where each moving patch ends. Chains lead to their last receiver; of two small patches that
    chose each other the larger one stays, the lower name on ties."""
    back = moves.select(F.col("comp").alias("into"), F.col("into").alias("back"))
    area = patches.select("comp", "area")
    m = moves.join(back, "into", "left").join(area, "comp").join(area.select(F.col("comp").alias("into"), F.col("area").alias("other")), "into")
    stays = (F.col("back") == F.col("comp")) & ((F.col("area") > F.col("other")) | ((F.col("area") == F.col("other")) & (F.col("comp") < F.col("into"))))
    now = table = saved(m.where(~F.coalesce(stays, F.lit(False))).select("comp", F.col("into").alias("root")), "moves")
    while True:
        nxt = saved(now.join(now.select(F.col("comp").alias("root"), F.col("root").alias("further")), "root", "left").select("comp", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "moves")
        dropped(table)
        table = nxt
        if not nxt.where("moved").limit(1).count():
            return nxt.select("comp", "root")
        now = nxt.select("comp", "root")


def dissolve(labelled: DataFrame, min_area: float, *, pixel_area: float = 1.0, max_passes: int = 5, touch: int = 8, reach: float = 0.0) -> DataFrame:
    """``(comp, cls, area)`` after small patches have gone into their largest touching neighbour of any class, at most
    ``max_passes`` times. Patches without neighbours stay. The total area does not change."""
    return merged(labelled, min_area, pixel_area=pixel_area, max_passes=max_passes, touch=touch, reach=reach)[0]


def merged(labelled: DataFrame, min_area: float, *, pixel_area: float = 1.0, max_passes: int = 5, touch: int = 8, reach: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The patches that :func:`dissolve` leaves, and ``(comp, root)``: where each region went (itself, if it stays)."""
    class_of = labelled.groupBy("comp").agg(F.first("cls").alias("cls"))
    patches = saved(labelled.groupBy("comp").agg((F.count("*") * F.lit(pixel_area)).alias("area")), "patches")
    where = patches.select("comp", F.col("comp").alias("root"))
    near = saved(adjacency(labelled, touch, reach), "near")
    for _ in range(max_passes):
        moves = saved(receivers(patches, near, min_area), "receivers")
        if not moves.limit(1).count():
            break
        roots = settle(moves, patches)

        def moved(df: DataFrame, name: str) -> DataFrame:
            return df.join(roots.select(F.col("comp").alias(name), F.col("root").alias("_root")), name, "left").withColumn(name, F.coalesce("_root", name)).drop("_root")

        old = (where, patches, near, moves)
        where = saved(moved(where, "root"), "where")
        patches = saved(moved(patches, "comp").groupBy("comp").agg(F.sum("area").alias("area")), "patches")
        near = saved(moved(moved(near, "comp"), "nbr").where("comp <> nbr").distinct(), "near")
        for x in old:
            dropped(x)
    return patches.join(class_of, "comp").select("comp", "cls", "area"), where.select("comp", "root")


def simplify(outline: DataFrame, tolerance: float, block: int = BLOCK) -> DataFrame:
    """Rings ``(comp, part, ring, hole)`` of pixel edges, joined end to end and thinned by Douglas-Peucker; of a region the
    outline first.

    Edges between two regions are one line with a region on either side. Lines are followed and thinned block by block,
    each once for both its regions, so shared borders stay shared. Corners where more than two lines meet stay, and so do
    points where a line passes into another block. Only thinned lines of a region meet in one task."""
    swap = (F.col("x0") > F.col("x1")) | (F.col("y0") > F.col("y1"))
    ends = {"ax": F.least("x0", "x1"), "ay": F.least("y0", "y1"), "bx": F.greatest("x0", "x1"), "by": F.greatest("y0", "y1")}
    e = outline.select(*(v.alias(k) for k, v in ends.items()), F.when(~swap, F.col("comp")).alias("ahead"), F.when(swap, F.col("comp")).alias("back"))
    e = e.groupBy("ax", "ay", "bx", "by").agg(F.max("ahead").alias("ahead"), F.max("back").alias("back"))
    e = saved(e.select("*", F.floor(F.col("ax") / block).alias("bc"), F.floor(F.col("ay") / block).alias("br")), "edges")
    tips = e.select(F.col("ax").alias("x"), F.col("ay").alias("y"), "br", "bc").union(e.select("bx", "by", "br", "bc"))
    place = F.struct("br", "bc")
    stops = tips.groupBy("x", "y").agg(F.count("*").alias("n"), (F.min(place) != F.max(place)).alias("crosses")).where("n <> 2 or crosses").select("x", "y", F.lit(True).alias("stop"))
    for p in ("a", "b"):
        e = e.join(stops.select(F.col("x").alias(f"{p}x"), F.col("y").alias(f"{p}y"), F.col("stop").alias(f"{p}s")), [f"{p}x", f"{p}y"], "left")

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = [(a, b, thin) for a, b, line in _lines(pdf) for thin in [thinned(line, tolerance)]]
        rows = [(int(c), [list(map(float, p)) for p in (line if k == 0 else line[::-1])]) for *both, line in lines for k, c in enumerate(both) if c == c and c is not None]
        return pd.DataFrame(rows, columns=["comp", "line"])

    thin = e.groupBy("br", "bc").applyInPandas(follow, "comp long, line array<array<double>>")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _whole_regions(batches):
            out = []
            for comp, group in part.groupby("comp", sort=False):
                rings_ = sorted(((_area(r) > 0, min(r), r) for r in _rings([[tuple(p) for p in line] for line in group["line"]])), key=lambda x: x[:2])
                out += [(int(comp), i, [list(p) for p in ring], hole) for i, (hole, _, ring) in enumerate(rings_)]
            yield pd.DataFrame(out, columns=["comp", "part", "ring", "hole"])

    return thin.repartition("comp").sortWithinPartitions("comp").mapInPandas(join, "comp long, part int, ring array<array<double>>, hole boolean")


def _lines(edges: pd.DataFrame) -> Iterator[tuple[float, float, list[tuple[int, int]]]]:
    """``(region ahead, region back, points)`` of the lines that edges make up, each from its lesser end; a closed one
    without a stop comes in two halves."""
    at: dict[tuple[int, int], list[int]] = {}
    tips, stop, sides = [], set(), []
    for i, (ax, ay, bx, by, ahead, back, a_stop, b_stop) in enumerate(edges[["ax", "ay", "bx", "by", "ahead", "back", "as", "bs"]].itertuples(index=False, name=None)):
        a, b = (int(ax), int(ay)), (int(bx), int(by))
        tips.append((a, b))
        sides.append((ahead, back))
        for p, s in ((a, a_stop), (b, b_stop)):
            at.setdefault(p, []).append(i)
            if s is True:
                stop.add(p)
    used = [False] * len(tips)

    def walk(p: tuple[int, int], i: int) -> tuple[list[tuple[int, int]], tuple[float, float]]:
        """Along a line from one of its points; the regions as for an edge that is walked forward."""
        side = sides[i] if tips[i][0] == p else sides[i][::-1]
        line = [p]
        while True:
            used[i] = True
            p = tips[i][1] if tips[i][0] == p else tips[i][0]
            line.append(p)
            if p in stop or p == line[0]:
                return line, side
            i = next(k for k in at[p] if k != i)

    for p in sorted(stop):
        for i in at.get(p, ()):
            if not used[i]:
                line, side = walk(p, i)
                if line[0] > line[-1] or (line[0] == line[-1] and line[1] > line[-2]):
                    line, side = line[::-1], side[::-1]
                yield *side, line
    for i in sorted(range(len(tips)), key=lambda k: tips[k]):
        if not used[i]:  # the least point of a closed line
            line, side = walk(tips[i][0], i)
            half = len(line) // 2
            yield *side, line[: half + 1]
            yield *side, line[half:]


def _rings(lines: list[list[tuple[float, float]]]) -> Iterator[list[tuple[float, float]]]:
    """Lines joined end to end."""
    nexts: dict[tuple[float, float], list[list[tuple[float, float]]]] = {}
    for line in sorted(lines, reverse=True):
        nexts.setdefault(line[0], []).append(line)
    while nexts:
        start = at = min(nexts)
        ring: list[tuple[float, float]] = []
        while True:
            line = nexts[at].pop()
            if not nexts[at]:
                del nexts[at]
            ring += line[:-1]
            at = line[-1]
            if at == start:
                break
        yield ring


def _area(ring: list[tuple[float, float]]) -> float:
    """Of a ring with rows downwards: outlines run so that it is negative."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]])) / 2


def _whole_regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by region, cut so that no region is split; the last region of one goes with the next."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        comp = b["comp"].to_numpy()
        if held and held[-1]["comp"].iloc[-1] != comp[-1] or comp[0] != comp[-1]:
            last = comp == comp[-1]
            yield pd.concat([*held, b[~last]], ignore_index=True)
            held = [b[last]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held, ignore_index=True)


def thinned(line: list[tuple[int, int]], tolerance: float) -> list[tuple[int, int]]:
    """Douglas-Peucker, without recursion."""
    pts = np.array(line, dtype=float)
    keep = np.zeros(len(pts), dtype=bool)
    keep[[0, -1]] = True
    todo = [(0, len(pts) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d = pts[b] - pts[a]
        rel = pts[a + 1 : b] - pts[a]
        n = np.hypot(*d)
        off = np.abs(rel[:, 0] * d[1] - rel[:, 1] * d[0]) / n if n else np.hypot(rel[:, 0], rel[:, 1])
        i = int(off.argmax())
        if off[i] > tolerance:
            keep[a + 1 + i] = True
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return [p for p, k in zip(line, keep) if k]
