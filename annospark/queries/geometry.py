"""Queries on boxes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark import fixtures as fx
from annospark.functions import geometry as g


def _boxes(spark, sf):
    """Each shape's box through the shape dispatch."""
    return fx.shape_rows(spark, sf).withColumn("b", g.shape_box(F.col("s")))


BOXES_SQL = (
    fx.SHAPES_SQL
    + """, boxes AS (
  SELECT image_id, width, height, label, shape_type,
    CASE shape_type WHEN 'circle' THEN x1 - (x2 - x1) / 2.0 ELSE least(x1, x2) END::DOUBLE AS x_min,
    CASE shape_type WHEN 'circle' THEN y1 - (x2 - x1) / 2.0 ELSE least(y1, y2) END::DOUBLE AS y_min,
    CASE shape_type WHEN 'circle' THEN x1 + (x2 - x1) / 2.0 ELSE greatest(x1, x2) END::DOUBLE AS x_max,
    CASE shape_type WHEN 'circle' THEN y1 + (x2 - x1) / 2.0 ELSE greatest(y1, y2) END::DOUBLE AS y_max,
    NOT (shape_type IN ('polygon', 'line') AND (x1 = x2 OR y1 = y2)) AS has_box
  FROM shapes)"""
)


def shape_boxes(spark, sf):
    return _boxes(spark, sf).select("image_id", F.col("s.label").alias("label"), F.col("s.shape_type").alias("shape_type"), "b.x_min", "b.y_min", "b.x_max", "b.y_max")


def box_validity(spark, sf):
    b = _boxes(spark, sf)
    reason = F.coalesce(g.invalid_reason(F.col("b"), F.col("width"), F.col("height"), 5), F.lit("valid"))
    return b.groupBy(F.col("s.label").alias("label"), reason.alias("reason")).agg(F.count("*").alias("n"))


def _valid(spark, sf):
    return _boxes(spark, sf).filter(g.invalid_reason(F.col("b"), F.col("width"), F.col("height")).isNull())


VALID_SQL = BOXES_SQL + ", valid AS (SELECT * FROM boxes WHERE has_box AND x_min >= 0 AND y_min >= 0 AND x_max <= width AND y_max <= height AND x_max > x_min AND y_max > y_min)"


def box_norms(spark, sf):
    rows = _valid(spark, sf)
    w, h = F.col("width"), F.col("height")
    out = []
    for norm in ("norm_1", "norm_100", "norm_1000"):
        n = g.normalize(F.col("b"), w, h, norm)
        out += [F.round(F.sum(n["x_min"]), 4).alias(f"{norm}_x"), F.round(F.sum(n["y_max"]), 4).alias(f"{norm}_y")]
    return rows.groupBy(F.col("s.label").alias("label")).agg(*out)


def box_layouts(spark, sf):
    rows = _valid(spark, sf).select("image_id", F.col("s.label").alias("label"), *[g.layout(F.col("b"), k).alias(k) for k in g.LAYOUTS])
    at = lambda c, i: F.get(F.col(c), i)
    return rows.select("image_id", "label", at("xyxy", 0).alias("x1"), at("yxyx", 0).alias("y1"), at("xywh", 2).alias("w"), at("xywh", 3).alias("h"), at("cxcywh", 0).alias("cx"), at("cxcywh", 1).alias("cy"), F.get(g.layout(g.from_layout(F.col("cxcywh"), "cxcywh")), 2).alias("x2"))


def box_2d_round_trip(spark, sf):
    rows = _valid(spark, sf)
    w, h = F.col("width"), F.col("height")
    rows = rows.select("image_id", F.col("s.label").alias("label"), "width", "height", g.box_2d(F.col("b"), w, h).alias("c"))
    p = g.box_2d_pixels(F.col("c"), F.col("width"), F.col("height"))
    return rows.select("image_id", "label", *[F.get("c", i).alias(f"c{i}") for i in range(4)], *[F.get(p, i).alias(f"p{i}") for i in range(4)])


def coords_text(spark, sf):
    rows = _valid(spark, sf)
    b = g.layout(g.normalize(F.col("b"), F.col("width"), F.col("height"), "norm_1000"))
    raw = g.layout(F.col("b"))
    unit = g.all_unit(g.layout(g.normalize(F.col("b"), F.col("width"), F.col("height"), "norm_1")))
    return rows.select("image_id", g.coords_text(b).alias("thousandths"), g.coords_text(raw, "raw").alias("pixels"), unit.alias("is_unit"))


def neighbour_iou(spark, sf):
    """The overlap of each image's first box with every other one."""
    rows = _valid(spark, sf).groupBy("image_id").agg(F.sort_array(F.collect_list(g.layout(F.col("b")))).alias("bs"))
    pairs = rows.select("image_id", F.get("bs", 0).alias("a"), F.explode("bs").alias("b"))
    v = g.iou(F.col("a"), F.col("b"))
    return pairs.groupBy("image_id").agg(F.round(F.sum(v), 6).alias("sum_iou"), F.round(F.max(v), 6).alias("max_iou"), F.count("*").alias("n"))


QUERIES = {
    "shape_boxes": shape_boxes,
    "box_validity": box_validity,
    "box_norms": box_norms,
    "box_layouts": box_layouts,
    "box_2d_round_trip": box_2d_round_trip,
    "coords_text": coords_text,
    "neighbour_iou": neighbour_iou,
}

_c2 = ", ".join(f"greatest(0, least(1000, round_even({v} / {s} * 1000, 0)::INT)) AS c{i}" for i, (v, s) in enumerate((("y_min", "height"), ("x_min", "width"), ("y_max", "height"), ("x_max", "width"))))
ORACLE_SQL = {
    "shape_boxes": f"WITH {BOXES_SQL} SELECT image_id, label, shape_type, " + ", ".join(f"CASE WHEN has_box THEN {k} END AS {k}" for k in ("x_min", "y_min", "x_max", "y_max")) + " FROM boxes",
    "box_validity": f"""WITH {BOXES_SQL} SELECT label, CASE WHEN NOT has_box THEN 'no_box' WHEN x_min < 0 OR y_min < 0 THEN 'negative'
      WHEN x_max > width OR y_max > height THEN 'out_of_bounds' WHEN x_max <= x_min OR y_max <= y_min THEN 'zero_area'
      WHEN x_max - x_min < 5 OR y_max - y_min < 5 THEN 'too_small' ELSE 'valid' END AS reason, count(*) AS n FROM boxes GROUP BY ALL""",
    "box_norms": f"WITH {VALID_SQL} SELECT label, " + ", ".join(f"round(sum(round_even(x_min / width * {t}, {p})), 4) AS norm_{t}_x, round(sum(round_even(y_max / height * {t}, {p})), 4) AS norm_{t}_y" for t, p in ((1, 4), (100, 0), (1000, 0))) + " FROM valid GROUP BY label",
    "box_layouts": f"WITH {VALID_SQL} SELECT image_id, label, x_min AS x1, y_min AS y1, x_max - x_min AS w, y_max - y_min AS h, (x_min + x_max) / 2 AS cx, (y_min + y_max) / 2 AS cy, x_max AS x2 FROM valid",
    "box_2d_round_trip": f"WITH {VALID_SQL}, c AS (SELECT image_id, label, width, height, {_c2} FROM valid) SELECT image_id, label, c0, c1, c2, c3, round_even(c1 / 1000 * width, 0)::INT AS p0, round_even(c0 / 1000 * height, 0)::INT AS p1, round_even(c3 / 1000 * width, 0)::INT AS p2, round_even(c2 / 1000 * height, 0)::INT AS p3 FROM c",
    "coords_text": f"""WITH {VALID_SQL} SELECT image_id, '[' || concat_ws(', ', round_even(x_min / width * 1000, 0)::BIGINT, round_even(y_min / height * 1000, 0)::BIGINT, round_even(x_max / width * 1000, 0)::BIGINT, round_even(y_max / height * 1000, 0)::BIGINT) || ']' AS thousandths,
      '[' || concat_ws(', ', trunc(x_min)::BIGINT, trunc(y_min)::BIGINT, trunc(x_max)::BIGINT, trunc(y_max)::BIGINT) || ']' AS pixels, true AS is_unit FROM valid""",
    "neighbour_iou": f"""WITH {VALID_SQL}, a AS (SELECT image_id, min([x_min, y_min, x_max, y_max]) AS a FROM valid GROUP BY image_id),
      i AS (SELECT image_id, greatest(0, least(a[3], x_max) - greatest(a[1], x_min)) * greatest(0, least(a[4], y_max) - greatest(a[2], y_min)) AS i,
                   (a[3] - a[1]) * (a[4] - a[2]) + (x_max - x_min) * (y_max - y_min) AS s FROM valid JOIN a USING (image_id))
      SELECT image_id, round(sum(CASE WHEN i > 0 THEN i / (s - i) ELSE 0 END), 6) AS sum_iou, round(max(CASE WHEN i > 0 THEN i / (s - i) ELSE 0 END), 6) AS max_iou, count(*) AS n FROM i GROUP BY image_id""",
}
