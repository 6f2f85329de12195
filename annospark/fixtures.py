"""Annotation views over the star-schema tables, by integer arithmetic that Spark and SQL evaluate alike.

Each view exists twice: as a DataFrame and, for the oracles, as SQL text of common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.operators.spread import once, small, spread, spread_for_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: an image with its size; every fourth shares the image key of the one before."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("image_id"),
        (key - F.when(key % 4 == 3, 1).otherwise(0)).alias("image_key"),
        (640 + 64 * (F.col("o_custkey") % 5)).cast("int").alias("width"),
        (480 + 48 * (F.col("o_custkey") % 3)).cast("int").alias("height"),
        F.concat(F.lit("img_"), key.cast("string")).alias("stem"),
    )


IMAGES_SQL = """images AS (
  SELECT o_orderkey AS image_id, o_orderkey - CASE WHEN o_orderkey % 4 = 3 THEN 1 ELSE 0 END AS image_key,
         (640 + 64 * (o_custkey % 5))::INT AS width, (480 + 48 * (o_custkey % 3))::INT AS height, 'img_' || o_orderkey AS stem
  FROM orders)"""


def shapes(spark: SparkSession, sf_dir: str, every_image: bool = False) -> DataFrame:
    """One row per line item: a shape's label, type and corners in its image. Some lie outside it or are flat. With ``every_image`` an image
    without shapes has a row of its size with nulls."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    hashed = part if small(part) else part.hint("shuffle_hash")  # a part's share of a partition is small, line items need no sort
    named = spread_for_join(line, part, "l_partkey").join(hashed, F.col("l_partkey") == F.col("p_partkey"))
    joined = spread(named, "l_orderkey").join(images(spark, sf_dir), F.col("l_orderkey") == F.col("image_id"), "right" if every_image else "inner")
    n = F.col("l_linenumber")
    return joined.select(
        "image_id", "image_key", "width", "height",
        F.when(F.col("l_partkey") % 97 == 0, "RARE").otherwise(F.col("p_type")).alias("label"),
        F.when(n <= 3, "rectangle").when(n <= 5, "polygon").when(n == 6, "circle").otherwise("line").alias("shape_type"),
        (F.col("l_partkey") % F.col("width")).cast("long").alias("x1"),
        ((F.col("l_suppkey") * 5) % F.col("height")).cast("long").alias("y1"),
        (F.col("l_partkey") % F.col("width") + F.col("l_quantity").cast("int") * 8 - 8).cast("long").alias("x2"),
        ((F.col("l_suppkey") * 5) % F.col("height") + 20 * n - 20).cast("long").alias("y2"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


SHAPES_SQL = (
    IMAGES_SQL
    + """, shapes AS (
  SELECT image_id, image_key, width, height, CASE WHEN l_partkey % 97 = 0 THEN 'RARE' ELSE p_type END AS label,
         CASE WHEN l_linenumber <= 3 THEN 'rectangle' WHEN l_linenumber <= 5 THEN 'polygon' WHEN l_linenumber = 6 THEN 'circle' ELSE 'line' END AS shape_type,
         (l_partkey % width)::BIGINT AS x1, ((l_suppkey * 5) % height)::BIGINT AS y1,
         (l_partkey % width + trunc(l_quantity)::INT * 8 - 8)::BIGINT AS x2, ((l_suppkey * 5) % height + 20 * l_linenumber - 20)::BIGINT AS y2,
         l_partkey AS part, l_suppkey AS supp, l_discount AS discount, l_tax AS tax
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN images ON l_orderkey = image_id)"""
)


def _shape(at=F.col) -> Column:
    """A shape as annotation files have it, of columns or of a row's fields."""
    corners = lambda *xy: F.array(*[F.array(at(x).cast("double"), at(y).cast("double")) for x, y in xy])
    kind = at("shape_type")
    points = F.when(kind == "polygon", corners(("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))).when(kind == "circle", corners(("x1", "y1"))).otherwise(corners(("x1", "y1"), ("x2", "y2")))
    return F.struct(at("label").alias("label"), kind.alias("shape_type"), points.alias("points"), F.when(kind == "circle", ((at("x2") - at("x1")) / 2)).alias("radius"))


def shape_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each shape with its image's size, without gathering those of an image."""
    return shapes(spark, sf_dir).select("image_id", "image_key", "width", "height", _shape().alias("s"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per image with its array of shapes in a fixed order; images without shapes have an empty array. Corners are gathered, and
    shapes are made of them afterwards and once."""
    grouped = shapes(spark, sf_dir).groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("x1", "y1", "x2", "y2", "label", "shape_type"))).alias("_c"))
    full = images(spark, sf_dir).join(grouped, "image_id", "left")
    none = F.array().cast("array<struct<label:string,shape_type:string,points:array<array<double>>,radius:double>>")
    return once(full, shapes=F.coalesce(F.transform("_c", lambda c: _shape(lambda name: c[name])), none)).drop("_c")


def found_by(model: str) -> Column:
    """The box that a model makes of a shape, jittered; null for a flat shape and for those that it doesn't find."""
    dx, dy, most = {"A": ("supp", "part", 0.06), "B": ("part", "supp", 0.04)}[model]
    box = F.struct(
        F.lit(model).alias("model"), "label",
        (F.col("x1") + F.col(dx) % 5).alias("x1"), (F.col("y1") + F.col(dy) % 7).alias("y1"), (F.col("x2") + F.col(dx) % 5).alias("x2"), (F.col("y2") + F.col(dy) % 7).alias("y2"),
        F.round(1 - F.col("discount"), 2).alias("confidence"),
    )
    return F.when((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")) & (F.col("tax") <= most), box)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that two models, A and B, find: jittered and thinned shapes."""
    return shapes(spark, sf_dir).select("image_id", "image_key", F.inline(F.array_compact(F.array(found_by("A"), found_by("B")))))


DETECTIONS_SQL = SHAPES_SQL + ", detections AS (" + " UNION ALL ".join(
    f"SELECT image_id, image_key, '{m}' AS model, label, x1 + {dx} % 5 AS x1, y1 + {dy} % 7 AS y1, x2 + {dx} % 5 AS x2, y2 + {dy} % 7 AS y2, round(1 - discount, 2) AS confidence "
    f"FROM shapes WHERE x2 > x1 AND y2 > y1 AND tax <= {most}"
    for m, dx, dy, most in (("A", "supp", "part", 0.06), ("B", "part", "supp", 0.04))
) + ")"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat records of ``conversations``: messages in turn order, each with one text item."""
    c = table(spark, sf_dir, "conversations")
    item = F.array(F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text")))
    message = F.struct("turn", "role", item.alias("content"))
    grouped = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("m"))
    return grouped.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def worker_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task events: worker, status, cost in seconds and time."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "click", "claimed").otherwise("done")
    return e.select(F.col("event_id").alias("sample_index"), (F.col("user_id") % 8).cast("int").alias("worker"), status.alias("status"), F.col("value").alias("cost"), "ts")


WORKER_LOG_SQL = """worker_log AS (
  SELECT event_id AS sample_index, (user_id % 8)::INT AS worker,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'claimed' ELSE 'done' END AS status, value AS cost, ts
  FROM events)"""


def gpu_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with a group of columns per GPU, as a monitor writes it: one row per step of four readings."""
    e = table(spark, sf_dir, "events")
    step = F.floor(F.col("event_id") / 4)
    wide = [F.max(F.when(F.col("event_id") % 4 == g, F.round(F.col("value") * f, 4))).alias(f"gpu{g}_{name}") for g in range(4) for name, f in (("alloc_gb", 0.1), ("util_pct", 0.5))]
    return e.groupBy(step.alias("step")).agg(F.min("ts").alias("timestamp"), *wide)
