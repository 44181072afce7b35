"""Names, paths, half-even rounding, class maps and colours as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("long")


def tile_name(out: Column, mosaic: Column, window: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """``out_mosaic_<window>m_x0_y0_x1_y1``, bounds rounded half to even."""
    return F.concat_ws("_", out, mosaic, F.concat(window.cast("string"), F.lit("m")), *(half_even(x).cast("string") for x in (x0, y0, x1, y1)))


def frame_number(n: Column) -> Column:
    """At least five digits; longer numbers are not cut."""
    return F.format_string("%05d", n)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(basename(path), r"\.([^.]*)$", 1))


def crosswalk(name: Column, ids: dict[str, int | str]) -> Column:
    """Class id of a name: as written, and only where that misses trimmed and lower-cased; null if neither. Ids given as
    text are read as numbers; what is no whole number is null, and no second choice."""
    whole = {k: str(v) for k, v in ids.items()}
    direct = F.create_map(*(F.lit(x) for kv in whole.items() for x in kv)) if whole else F.create_map().cast("map<string,string>")
    plain = {k.strip().lower(): v for k, v in whole.items() if re.fullmatch(r"\s*[+-]?\d+\s*", v)}
    second = F.create_map(*(F.lit(x) for kv in plain.items() for x in kv)) if plain else F.create_map().cast("map<string,string>")
    return F.coalesce(F.try_element_at(direct, name), F.try_element_at(second, F.lower(F.trim(name)))).try_cast("int")


def class_names(config: Column) -> Column:
    """Map from class id (as text) to name out of a JSON configuration: ``MY_CLASS_NAMES``, else ``id2label``, else
    ``label2id``, the latter two in either direction. Keys are normalised to plain integers. Raises if none serves."""
    as_map = "map<string,string>"
    number = r"^\s*[+-]?[0-9]+\s*$"

    def read(key: str) -> Column:
        m = F.from_json(F.get_json_object(config, f"$.{key}"), as_map)
        return F.when(F.size(m) > 0, m)

    def normal(x: Column) -> Column:
        return F.trim(x).cast("bigint").cast("string")

    def all_like(entries: Column, field: str) -> Column:
        return F.forall(entries, lambda e: e[field].rlike(number))

    own = read("MY_CLASS_NAMES")
    kept = F.filter(F.map_entries(own), lambda e: e["key"].rlike(number))
    direct = F.map_from_entries(F.transform(kept, lambda e: F.struct(normal(e["key"]), e["value"])))

    def either(m: Column, ids_first: bool) -> Column:
        e = F.map_entries(m)
        forward = F.map_from_entries(F.transform(e, lambda x: F.struct(normal(x["key"]), x["value"])))
        back = F.map_from_entries(F.transform(e, lambda x: F.struct(normal(x["value"]), x["key"])))
        if ids_first:
            return F.when(all_like(e, "key"), forward).when(all_like(e, "value"), back)
        return F.when(all_like(e, "value"), back).when(all_like(e, "key"), forward)

    found = F.coalesce(F.when(own.isNotNull(), direct), either(read("id2label"), True), either(read("label2id"), False))
    return F.coalesce(found, F.raise_error(F.lit("no class names in the configuration")).cast(as_map))


def target_size(config: Column) -> Column:
    """(height, width) a model wants: ``image_size`` squared, else the first two of ``TARGET_SIZE``, else 224."""
    side = F.get_json_object(config, "$.image_size").cast("int")
    pair = F.from_json(F.get_json_object(config, "$.TARGET_SIZE"), "array<int>")
    return F.coalesce(F.when(side.isNotNull(), F.array(side, side)), F.when(F.size(pair) >= 2, F.slice(pair, 1, 2)), F.array(F.lit(224), F.lit(224)))


def hex_colour(colour: Column) -> Column:
    """[red, green, blue] of ``#rrggbb``."""
    h = F.ltrim(colour, F.lit("#"))
    return F.array(*(F.conv(F.substring(h, i, 2), 16, 10).cast("int") for i in (1, 3, 5)))


def label_colour(label: Column, masked: Column, palette: Sequence[str], offset: int) -> Column:
    """Colour of a class from a palette, shifted and wrapped; black where masked."""
    table = F.array(*map(F.lit, palette))
    return F.when(masked, F.array(F.lit(0), F.lit(0), F.lit(0))).otherwise(hex_colour(F.element_at(table, (F.pmod(label + offset, F.lit(len(palette))) + 1).cast("int"))))


def blend(image: Column, colour: Column, alpha: Column) -> Column:
    return (1 - alpha) * image + alpha * colour


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box, or null if it has no area."""
    return F.when((x0 < x1) & (y0 < y1), F.struct(x0.alias("x_min"), y0.alias("y_min"), x1.alias("x_max"), y1.alias("y_max")))


def out_shape(width: Column, height: Column, cell: Column, max_pixels: Column) -> Column:
    """(w, h) in cells, rounded half to even and at least 1; scaled down to the pixel budget, truncated."""
    w, h = F.greatest(F.lit(1), half_even(width / cell)), F.greatest(F.lit(1), half_even(height / cell))
    scale = F.sqrt((w * h).cast("double") / max_pixels)
    over = w * h > max_pixels
    return F.struct(F.when(over, F.greatest(F.lit(1), (w / scale).cast("long"))).otherwise(w).alias("w"), F.when(over, F.greatest(F.lit(1), (h / scale).cast("long"))).otherwise(h).alias("h"))


#: Colours of the classes of an overlay, by rank.
OVERLAY = (
    "#0072B2", "#E69F00", "#009E73", "#CC79A7", "#D55E00", "#56B4E9", "#F0E442", "#332288", "#44AA99", "#117733", "#999933", "#AA4499",
    "#88CCEE", "#882255", "#DDCC77", "#AA3377", "#66CCEE", "#228833", "#4477AA", "#EE6677", "#BBBBBB", "#77AADD", "#EE8866", "#44BB99",
)


def overlay(image: Column, label: Column, ids: dict[str, int]) -> Column:
    """[red, green, blue] of a grey image with class colours half over it: the palette by rank of the ids above 0, black
    for other labels, the image alone where the label is 0."""
    ranks = sorted({v for v in ids.values() if v > 0})
    rgb = lambda h: F.array(*(F.lit(int(h[i : i + 2], 16)) for i in (1, 3, 5)))
    table = F.create_map(*(x for k, v in enumerate(ranks) for x in (F.lit(v), rgb(OVERLAY[k % len(OVERLAY)])))) if ranks else F.create_map().cast("map<int,array<int>>")
    colour = F.coalesce(F.try_element_at(table, label.cast("int")), F.array(F.lit(0), F.lit(0), F.lit(0)))
    return F.transform(colour, lambda x: blend(image.cast("double"), x, F.when(label > 0, 0.5).otherwise(0.0)))
