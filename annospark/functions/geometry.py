"""Boxes as columns: conversion of shapes, normalisation, layouts, validity and overlap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NORMS = ("raw", "norm_1", "norm_100", "norm_1000")
LAYOUTS = ("xyxy", "yxyx", "xywh", "cxcywh")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """A box with ordered corners; null if a corner is null."""
    made = F.struct(F.least(x1, x2).alias("x_min"), F.least(y1, y2).alias("y_min"), F.greatest(x1, x2).alias("x_max"), F.greatest(y1, y2).alias("y_max"))
    return F.when(x1.isNotNull() & y1.isNotNull() & x2.isNotNull() & y2.isNotNull(), made)


def points_box(points: Column) -> Column:
    """The bounding box of polygon or line points; null with fewer than two points or no extent in x or y."""
    xs, ys = F.transform(points, lambda p: F.get(p, 0)), F.transform(points, lambda p: F.get(p, 1))
    found = F.struct(F.array_min(xs).alias("x_min"), F.array_min(ys).alias("y_min"), F.array_max(xs).alias("x_max"), F.array_max(ys).alias("y_max"))
    return F.when(F.size(points) >= 2, let(found, lambda b: F.when((b["x_max"] > b["x_min"]) & (b["y_max"] > b["y_min"]), b)))


def rectangle_box(points: Column) -> Column:
    """The box between a rectangle's first two points, in whichever order."""
    a, b = F.get(points, 0), F.get(points, 1)
    return F.when(F.size(points) >= 2, box(F.get(a, 0), F.get(a, 1), F.get(b, 0), F.get(b, 1)))


def circle_box(points: Column, radius: Column) -> Column:
    """The box around a circle; a missing radius counts as 0, which no later check accepts."""
    c, r = F.get(points, 0), F.coalesce(radius, F.lit(0.0))
    return F.when(F.size(points) >= 1, box(F.get(c, 0) - r, F.get(c, 1) - r, F.get(c, 0) + r, F.get(c, 1) + r))


def shape_box(shape: Column) -> Column:
    """A shape's box by its type; a missing type counts as polygon, an unknown one gives null."""
    kind, points = F.coalesce(shape["shape_type"], F.lit("polygon")), shape["points"]
    return (
        F.when(kind == "rectangle", rectangle_box(points))
        .when(kind.isin("polygon", "line", "linestrip", "point"), points_box(points))
        .when(kind == "circle", circle_box(points, shape["radius"]))
    )


def invalid_reason(b: Column, width: Column, height: Column, min_size: float = 0.0) -> Column:
    """Why a box in pixels is unusable (no_box, negative, out_of_bounds, zero_area, too_small), or null."""
    w, h = b["x_max"] - b["x_min"], b["y_max"] - b["y_min"]
    return (
        F.when(b.isNull(), "no_box")
        .when((b["x_min"] < 0) | (b["y_min"] < 0), "negative")
        .when((b["x_max"] > width) | (b["y_max"] > height), "out_of_bounds")
        .when((w <= 0) | (h <= 0), "zero_area")
        .when((w < min_size) | (h < min_size), "too_small")
    )


def normalize(b: Column, width: Column, height: Column, norm: str = "norm_1000") -> Column:
    """A box in the units of ``norm``: pixels, 0-1 with four places, or whole hundredths or thousandths. Ties round to even.
    A size of 0 or less gives null."""
    if norm not in NORMS:
        raise ValueError(f"unknown normalisation: {norm}")
    if norm == "raw":
        return b
    times, places = {"norm_1": (1, 4), "norm_100": (100, 0), "norm_1000": (1000, 0)}[norm]
    whole = lambda v: F.rint(v) + F.lit(0.0)  # bround without decimal numbers; the sum makes -0.0 a 0.0
    scale = lambda v, size: F.bround(v / size * times, places) if places else whole(v / size * times)
    made = F.struct(scale(b["x_min"], width).alias("x_min"), scale(b["y_min"], height).alias("y_min"), scale(b["x_max"], width).alias("x_max"), scale(b["y_max"], height).alias("y_max"))
    return F.when(b.isNotNull() & (width > 0) & (height > 0), made)


def layout(b: Column, kind: str = "xyxy") -> Column:
    """A box as an array of four numbers."""
    x1, y1, x2, y2 = (b[k].cast("double") for k in ("x_min", "y_min", "x_max", "y_max"))
    made = {"xyxy": (x1, y1, x2, y2), "yxyx": (y1, x1, y2, x2), "xywh": (x1, y1, x2 - x1, y2 - y1), "cxcywh": ((x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1)}
    if kind not in LAYOUTS:
        raise ValueError(f"unknown layout: {kind}")
    return F.when(b.isNotNull(), F.array(*made[kind]))


def from_layout(c: Column, kind: str = "xyxy") -> Column:
    """The box of an array of four numbers."""
    a, b, d, e = (F.get(c, i) for i in range(4))
    if kind not in LAYOUTS:
        raise ValueError(f"unknown layout: {kind}")
    corners = {"xyxy": (a, b, d, e), "yxyx": (b, a, e, d), "xywh": (a, b, a + d, b + e), "cxcywh": (a - d / 2, b - e / 2, a + d / 2, b + e / 2)}[kind]
    return F.when(F.size(c) == 4, F.struct(*[v.alias(k) for v, k in zip(corners, ("x_min", "y_min", "x_max", "y_max"))]))


def box_2d(b: Column, width: Column, height: Column) -> Column:
    """[y1, x1, y2, x2] in thousandths, clamped to 0-1000."""
    scale = lambda v, size: F.least(F.lit(1000), F.greatest(F.lit(0), F.bround(v / size * 1000).cast("int")))
    return F.when(b.isNotNull() & (width > 0) & (height > 0), F.array(scale(b["y_min"], height), scale(b["x_min"], width), scale(b["y_max"], height), scale(b["x_max"], width)))


def box_2d_pixels(c: Column, width: Column, height: Column) -> Column:
    """The inverse of ``box_2d``: pixel [x1, y1, x2, y2]."""
    back = lambda i, size: F.bround(F.get(c, i) / 1000 * size).cast("int")
    return F.when(F.size(c) == 4, F.array(back(1, width), back(0, height), back(3, width), back(2, height)))


def coords_text(c: Column, norm: str = "norm_1000") -> Column:
    """``[a, b, c, d]``: four places for norm_1, whole numbers (truncated) otherwise."""
    each = (lambda v: F.format_string("%.4f", v.cast("double"))) if norm == "norm_1" else (lambda v: v.cast("long").cast("string"))
    return F.concat(F.lit("["), F.array_join(F.transform(c, each), ", "), F.lit("]"))


def all_unit(c: Column) -> Column:
    """Whether all numbers lie in 0-1."""
    return F.forall(c, lambda v: (v >= 0) & (v <= 1))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two [x1, y1, x2, y2] arrays or boxes; 0 without overlap or area."""
    at = lambda v, i: F.get(v, i).cast("double")
    w = F.least(at(a, 2), at(b, 2)) - F.greatest(at(a, 0), at(b, 0))
    h = F.least(at(a, 3), at(b, 3)) - F.greatest(at(a, 1), at(b, 1))
    inter = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    union = (at(a, 2) - at(a, 0)) * (at(a, 3) - at(a, 1)) + (at(b, 2) - at(b, 0)) * (at(b, 3) - at(b, 1)) - inter
    return F.when((inter > 0) & (union > 0), inter / union).otherwise(0.0)


def image_size(real: Column, stated: Column, default: int = 1024) -> Column:
    """A size from the image header, else from the annotation, else the default; 0 and less count as missing."""
    return F.coalesce(F.when(real > 0, real), F.when(stated > 0, stated), F.lit(default))
