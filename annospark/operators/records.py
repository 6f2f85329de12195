"""Training records from annotations: filters, boxes, prompts and responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import geometry as g
from annospark.functions import text as t
from annospark.operators import validate
from annospark.operators.spread import once


def usable_boxes(shapes: Column, width: Column, height: Column, types=("rectangle", "polygon"), remap: dict[str, str] | None = None, allow=None, deny=(), norm: str = "norm_1000", layout: str = "xyxy", min_size: float = 0.0) -> Column:
    """array<(coords, label, reason)> of shapes of these types, labels mapped before the lists of allowed and denied ones.
    ``reason`` is null for a usable box."""
    table = F.create_map(*[F.lit(x) for kv in (remap or {}).items() for x in kv]) if remap else None
    label = lambda s: F.coalesce(F.try_element_at(table, s["label"]), s["label"]) if remap else s["label"]
    kept = F.filter(shapes, lambda s: F.coalesce(s["shape_type"], F.lit("polygon")).isin(*types))
    if allow is not None:
        kept = F.filter(kept, lambda s: label(s).isin(*allow))
    if deny:
        kept = F.filter(kept, lambda s: ~label(s).isin(*deny))

    def one(s: Column) -> Column:
        made = lambda b: F.struct(g.layout(g.normalize(b, width, height, norm), layout).alias("coords"), label(s).alias("label"), g.invalid_reason(b, width, height, min_size).alias("reason"))
        return g.let(g.shape_box(s), made)

    return F.transform(kept, one)


def convert(annotations: DataFrame, strategy: str = "all_in_one", lang: str = "en", keep_empty: bool = False, norm: str = "norm_1000", layout: str = "xyxy", style: str = "simple", custom: dict[str, str] | None = None, prompt: Callable[[Column], Column] | None = None, output: str = "json", **filters) -> DataFrame:
    """One record per image, or per image and class: record_id, image_id, image_key, stem, outcome, labels, num_objects,
    n_invalid, messages. ``outcome``: converted, empty (kept only with ``keep_empty``); images without usable boxes are skipped else.

    ``prompt`` makes the question of an array of labels; without one, the template of language, style and strategy does. ``output``
    is ``json`` or ``list``.
    """
    return from_boxes(with_boxes(annotations, keep_empty, norm, layout, **filters), strategy, lang, norm, layout, style, custom, prompt, output)


def with_boxes(annotations: DataFrame, keep_empty: bool = False, norm: str = "norm_1000", layout: str = "xyxy", items: bool = False, **filters) -> DataFrame:
    """What the records of both strategies are made of, per image: its columns, n_invalid, labels (sorted, distinct) and boxes
    (coords, label; with ``items`` item, the box's text in an answer, in place of coords). Images without usable boxes go unless ``keep_empty``."""
    found = usable_boxes(F.col("shapes"), F.col("width"), F.col("height"), norm=norm, layout=layout, **filters)
    rows = once(annotations.select("image_id", "image_key", "stem", "width", "height", "shapes"), _b=found)
    made = lambda b: t.json_item(b["coords"], b["label"], norm).alias("item") if items else b["coords"].alias("coords")
    usable = F.transform(F.filter("_b", lambda b: b["reason"].isNull()), lambda b: F.struct(made(b), b["label"].alias("label")))
    rows = once(rows, boxes=usable, n_invalid=F.size(F.filter("_b", lambda b: b["reason"].isNotNull()))).drop("_b", "shapes")
    if not keep_empty:
        rows = rows.filter(F.size("boxes") > 0)
    return rows.withColumn("labels", F.array_sort(F.array_distinct(F.col("boxes.label"))))


def from_boxes(rows: DataFrame, strategy: str = "all_in_one", lang: str = "en", norm: str = "norm_1000", layout: str = "xyxy", style: str = "simple", custom: dict[str, str] | None = None, prompt: Callable[[Column], Column] | None = None, output: str = "json") -> DataFrame:
    """The records that ``convert`` makes, of images from ``with_boxes`` (with the same norm and layout). Further columns stay."""
    if output not in ("json", "list"):
        raise ValueError(f"unknown output: {output}")
    items = "item" in rows.schema["boxes"].dataType.elementType.names
    more = [c for c in rows.columns if c not in ("image_id", "image_key", "stem", "width", "height", "boxes", "n_invalid", "labels")]
    if strategy == "per_class":
        rows = rows.withColumn("label", F.explode_outer("labels"))
        rows = once(rows, boxes=F.filter("boxes", lambda b: b["label"] == F.col("label"))).withColumn("record_id", F.concat_ws("_", "stem", "label"))
        names = F.when(F.col("label").isNotNull(), F.array("label")).otherwise(F.array().cast("array<string>"))
    else:
        rows, names = rows.withColumn("record_id", F.col("stem")), F.col("labels")
    message = lambda role, text: F.struct(F.lit(role).alias("role"), F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("content"))
    question = prompt(names) if prompt else t.detection_prompt(names, strategy, lang, custom, style)
    category = F.get(names, 0) if strategy == "per_class" else None
    json = t.joined_items(F.col("boxes.item"), norm, layout) if items else t.json_response(F.col("boxes"), norm, layout)
    answer = json if output == "json" else t.list_response(F.col("boxes"), strategy, norm, lang, category)
    messages = F.array(message("user", question), message("assistant", answer))
    return rows.select(
        "record_id", "image_id", "image_key", "stem", "width", "height", F.when(F.size("boxes") > 0, "converted").otherwise("empty").alias("outcome"),
        names.alias("labels"), F.size("boxes").alias("num_objects"), "n_invalid", messages.alias("messages"), *more,
    )


def both_strategies(annotations: DataFrame, **options) -> DataFrame:
    """Records of both strategies with a ``strategy`` column."""
    a, b = (convert(annotations, s, **options).withColumn("strategy", F.lit(s)) for s in ("all_in_one", "per_class"))
    return a.unionByName(b)


def conversion_counters(annotations: DataFrame, **options) -> DataFrame:
    """One row: records, images converted and empty, unusable boxes."""
    rows = convert(annotations, keep_empty=True, **options)
    return rows.agg(F.count_if(F.col("outcome") == "converted").alias("converted"), F.count_if(F.col("outcome") == "empty").alias("empty"), F.sum("n_invalid").alias("invalid_boxes"), F.sum("num_objects").alias("objects"))


def conversion_outcomes(files: DataFrame, strategy: str = "all_in_one", keep_empty: bool = False, need_image: bool = True, **filters) -> DataFrame:
    """``files`` (raw, a, image, width, height, ...; ``ok`` where known: whether raw is a JSON object) with outcome, n_records and n_invalid.

    Outcomes, the first that holds: failed (no JSON object, or shapes that are no list), no_image_path, missing_image (no such
    image, where one is needed), empty (no usable box), converted. ``keep_empty`` makes one record of an empty file.
    ``n_records`` has a record per file, or per class, or both; unusable boxes count only in files that got so far.
    """
    odd = lambda v: F.try_variant_get(v, "$.shapes", "variant").isNotNull() & F.try_variant_get(v, "$.shapes", "array<variant>").isNull()
    odd_shapes = F.col("a.shapes").isNull() & g.let(F.try_parse_json("raw"), odd)
    none = F.array().cast(f"array<{validate.SHAPE}>")
    found = usable_boxes(F.coalesce("a.shapes", none), F.col("width"), F.col("height"), **filters)
    whole = F.col("ok") if "ok" in files.columns else validate.is_object(F.col("raw"))
    rows = once(files, _b=found, _failed=~whole | odd_shapes)
    rows = once(rows, _ok=F.filter("_b", lambda b: b["reason"].isNull()))
    outcome = (
        F.when(F.col("_failed"), "failed")
        .when(F.coalesce("a.imagePath", F.lit("")) == "", "no_image_path")
        .when(F.col("image").isNull() & F.lit(need_image), "missing_image")
        .when(F.size("_ok") == 0, "empty")
        .otherwise("converted")
    )
    rows = rows.withColumn("outcome", outcome)
    classes = F.size(F.array_distinct(F.transform("_ok", lambda b: b["label"])))
    per_file = {"all_in_one": F.lit(1), "per_class": classes, "both": classes + 1}[strategy]
    n = F.when(F.col("outcome") == "converted", per_file).when((F.col("outcome") == "empty") & F.lit(keep_empty), 1).otherwise(0)
    bad = F.when(F.col("outcome").isin("empty", "converted"), F.size("_b") - F.size("_ok")).otherwise(0)
    return rows.withColumns({"n_records": n, "n_invalid": bad}).drop("_b", "_ok", "_failed")


def conversion_report(outcomes: DataFrame) -> DataFrame:
    """One row: files, records (``converted``), failed, skipped and why, unusable boxes, and records per hundred files."""
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    found = outcomes.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("converted"),
        n("failed").alias("failed"),
        F.count_if(F.col("outcome").isin("no_image_path", "missing_image", "empty") & (F.col("n_records") == 0)).alias("skipped"),
        n("missing_image").alias("missing_images"),
        n("empty").alias("empty"),
        F.coalesce(F.sum("n_invalid"), F.lit(0)).alias("invalid_boxes"),
    )
    return found.withColumn("rate_pct", F.round(validate.ratio(F.col("converted"), F.col("files")), 4))


def export_payload(results: DataFrame) -> DataFrame:
    """Annotation JSON of detection results: index, file, payload. A row without image path has null file and payload and counts as
    failed; the others don't stop for it.

    ``results`` has index, image_path, width, height and detections; gpu_id, model_type, metrics (precision, recall, f1), query,
    raw_response, inference_success, inference_error, the image's real size (loaded_width, loaded_height) and that of the record's
    metadata (meta_width, meta_height) are used where they are there. The size is the result's if both numbers are above 0, else the
    real one, else the metadata's, else 1000. Boxes without four numbers are left out. Files are ``{index:06d}_{stem}.json``, or
    ``{stem}.json`` without an index.
    """
    have = lambda name, kind: F.col(name) if name in results.columns else F.lit(None).cast(kind)
    dets = F.coalesce("detections", F.array().cast(results.schema["detections"].dataType))
    pair = lambda w, h: F.when((have(w, "int") > 0) & (have(h, "int") > 0), F.struct(have(w, "int").cast("int").alias("w"), have(h, "int").cast("int").alias("h")))
    meta = F.struct(F.coalesce(have("meta_width", "int"), F.lit(1000)).alias("w"), F.coalesce(have("meta_height", "int"), F.lit(1000)).alias("h"))
    size = F.coalesce(pair("width", "height"), pair("loaded_width", "loaded_height"), meta)
    gpu, model = have("gpu_id", "int"), have("model_type", "string")
    shape = lambda d: F.struct(
        F.coalesce(d["label"], F.lit("object")).alias("label"),
        F.array(F.slice(d["bbox"], 1, 2), F.slice(d["bbox"], 3, 2)).cast("array<array<double>>").alias("points"),
        F.lit(None).cast("string").alias("group_id"),
        F.concat(F.lit("confidence="), F.format_string("%.4f", F.coalesce(d["confidence"].cast("double"), F.lit(0.0))), F.lit(",gpu="), F.coalesce(gpu.cast("string"), F.lit("None")), F.lit(",model="), F.coalesce(model, F.lit("None"))).alias("description"),
        F.lit("rectangle").alias("shape_type"),
    )
    metric = lambda name: F.coalesce(F.col(f"metrics.{name}") if "metrics" in results.columns else F.lit(None).cast("double"), F.lit(0.0)).alias(name)
    empty = lambda name: F.coalesce(have(name, "string"), F.lit("")).alias(name)
    payload = F.to_json(
        F.struct(
            F.lit("5.4.1").alias("version"),
            F.transform(F.filter(dets, lambda d: F.size(d["bbox"]) == 4), shape).alias("shapes"),
            F.regexp_extract("image_path", r"([^/]*)$", 1).alias("imagePath"),
            F.lit(None).cast("string").alias("imageData"),
            size["h"].alias("imageHeight"),
            size["w"].alias("imageWidth"),
            F.struct(gpu.alias("gpu_id"), model.alias("model_type"), metric("precision"), metric("recall"), metric("f1"), F.size(dets).alias("num_detections")).alias("metadata"),
            F.struct(
                empty("query"), empty("raw_response"), F.size(dets).alias("detections_count"), (F.size(dets) > 0).alias("parse_success"),
                F.coalesce(have("inference_success", "boolean"), F.lit(True)).alias("inference_success"), empty("inference_error"),
            ).alias("raw_inference_data"),
        ),
        {"ignoreNullFields": "false"},
    )
    stem = F.coalesce(F.nullif(F.regexp_extract("image_path", r"([^/]*?)(\.[^./]*)?$", 1), F.lit("")), F.lit("image"))
    file = F.when(F.col("index").isNull(), F.concat(stem, F.lit(".json"))).otherwise(F.format_string("%06d_%s.json", F.col("index"), stem))
    there = F.col("image_path").isNotNull()
    return results.select("index", F.when(there, file).alias("file"), F.when(there, payload).alias("payload"))


def export_counts(exported: DataFrame) -> DataFrame:
    """One row: payloads written, and rows that failed for want of an image path."""
    return exported.agg(F.count("payload").alias("written"), F.count_if(F.col("payload").isNull()).alias("failed"))


def convert_directory(files: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``files`` (path, name, stem, a: null where broken) to box lists: path, file (``{stem}_boxes.json``), boxes (JSON, or null
    where the file failed). Sizes by file name come before those of the annotation, and 1024 after them."""
    rows = lookup_sizes(files, sizes) if sizes is not None else files.withColumns({"size_width": F.lit(None).cast("int"), "size_height": F.lit(None).cast("int")})
    w, h = (g.image_size(F.col(f"size_{k}"), F.col(f"a.image{k.title()}")) for k in ("width", "height"))
    boxes = lambda s: F.struct(g.box_2d(g.rectangle_box(s["points"]), w, h).alias("box_2d"), s["label"].alias("label"))
    found = F.filter(F.transform(F.filter(F.coalesce("a.shapes", F.array().cast(f"array<{validate.SHAPE}>")), lambda s: s["shape_type"] == "rectangle"), boxes), lambda b: b["box_2d"].isNotNull())
    return rows.select("path", F.concat("stem", F.lit("_boxes.json")).alias("file"), F.when(F.col("a").isNotNull(), F.to_json(found)).alias("boxes"))


def lookup_sizes(files: DataFrame, sizes: DataFrame) -> DataFrame:
    """``files`` (name, ...) with size_width and size_height of a table (name, width, height), null where it has none. Spark broadcasts
    the table if it is small."""
    table = sizes.select("name", F.col("width").alias("size_width"), F.col("height").alias("size_height")).dropDuplicates(["name"])
    return files.join(table, "name", "left")


def directory_counts(converted: DataFrame) -> DataFrame:
    """One row: files, converted, failed."""
    return converted.agg(F.count("*").alias("total_files"), F.count("boxes").alias("converted"), F.count_if(F.col("boxes").isNull()).alias("failed"))


def selected_files(rows: DataFrame, chosen: DataFrame, key: str = "path") -> DataFrame:
    """The rows of an explicit list of files."""
    return rows.join(chosen.select(key).distinct(), key, "left_semi")


def strip_answers(records: DataFrame, schema: str = "openai") -> DataFrame:
    """``records`` (split, messages) without answers where a split is for testing: test, and for chat turns validation too."""
    bare = F.col("split").isin(*(("test",) if schema == "openai" else ("test", "val", "valid")))
    return records.withColumn("messages", F.when(bare, t.user_only(F.col("messages"))).otherwise(F.col("messages")))
