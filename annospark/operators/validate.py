"""Structural checks of annotation JSON, integrity issues, image lookup and one annotation per image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions import geometry as g
from annospark.operators.spread import spread, spread_for_join

IMAGE_EXTENSIONS = (".bmp", ".gif", ".jpeg", ".jpg", ".png", ".tif", ".tiff", ".webp")
SHAPE = "struct<label:string,shape_type:string,type:string,points:array<array<double>>,radius:double>"
ANNOTATION = f"struct<version:string,imagePath:string,imageUrl:string,imageWidth:double,imageHeight:double,shapes:array<{SHAPE}>>"
NEED_POINTS = ("polygon", "rectangle", "line", "linestrip", "point")


def _kind(raw: Column, path: str) -> Column:
    """The variant type at a path: null if absent, VOID for JSON null, ARRAY<...> for a list."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), path, "variant"))


def is_object(raw: Column) -> Column:
    return F.coalesce(F.try_parse_json(raw).isNotNull() & _braced(raw), F.lit(False))


def _braced(raw: Column) -> Column:
    """Whether a JSON text is that of an object: of valid JSON, only objects begin with a brace."""
    return F.ltrim(raw, F.lit(" \t\r\n")).startswith("{")


def parse(raw: Column) -> Column:
    """The annotation of a JSON text; null where it is no JSON object."""
    return F.from_json(raw, ANNOTATION)


def structure(raw: Column) -> Column:
    """(status, shapes_count) of a JSON text, parsed once. Status: invalid_json, missing_shapes (absent or no list),
    empty_shapes, invalid_image_path, or valid; the first that holds. The count is null unless valid."""

    def judged(v: Column) -> Column:
        def counted(n: Column) -> Column:
            status = (
                F.when(~F.coalesce(v.isNotNull() & _braced(raw), F.lit(False)), "invalid_json")
                .when(F.coalesce(n, F.lit(-1)) < 0, "missing_shapes")
                .when(n == 0, "empty_shapes")
                .when(F.coalesce(F.try_variant_get(v, "$.imagePath", "string"), F.lit("")) == "", "invalid_image_path")
                .otherwise("valid")
            )
            return g.let(status, lambda s: F.struct(s.alias("status"), F.when(s == "valid", n).alias("shapes_count")))

        return g.let(F.size(F.try_variant_get(v, "$.shapes", "array<variant>")), counted)

    return g.let(F.try_parse_json(raw), judged)


def structure_status(raw: Column) -> Column:
    return structure(raw)["status"]


def shapes_count(raw: Column) -> Column:
    return structure(raw)["shapes_count"]


def image_source(a: Column) -> Column:
    """(kind, value): the remote URL before the local path, else nothing."""
    url, path = F.nullif(a["imageUrl"], F.lit("")), F.nullif(a["imagePath"], F.lit(""))
    return F.struct(F.when(url.isNotNull(), "remote").when(path.isNotNull(), "local").otherwise("none").alias("kind"), F.coalesce(url, path).alias("value"))


def has_image(a: Column) -> Column:
    return image_source(a)["kind"] != "none"


def map_labels(shapes: Column, mapping: dict[str, str]) -> Column:
    """Shapes with mapped labels: label, original_label and label_mapped; null shapes go."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]) if mapping else F.create_map().cast("map<string,string>")
    to = lambda s: F.try_element_at(table, s["label"])
    return F.transform(
        F.filter(shapes, lambda s: s.isNotNull()),
        lambda s: s.withField("original_label", s["label"]).withField("label_mapped", to(s).isNotNull()).withField("label", F.coalesce(to(s), s["label"])),
    )


def standardize(df: DataFrame, annotation: str = "a", path: str = "path", cleaned_at: Column | None = None, status: str | None = None) -> DataFrame:
    """Adds cleaned_at (one time for all rows), source_path, cleaning_status (that of column ``status`` where it has one), and
    standard_shapes with label_normalized and a shape type (its own, the legacy ``type``, or rectangle)."""
    shapes = F.transform(
        F.col(annotation)["shapes"],
        lambda s: s.withField("label_normalized", F.lower(F.trim(s["label"]))).withField("shape_type", F.coalesce(s["shape_type"], s["type"], F.lit("rectangle"))),
    )
    when = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if cleaned_at is None else cleaned_at
    own = F.coalesce(F.col(status), F.lit("cleaned")) if status else F.lit("cleaned")
    return df.withColumns({"cleaned_at": when, "source_path": F.col(path), "cleaning_status": own, "standard_shapes": shapes})


def normalized_label(label: Column) -> Column:
    return F.lower(F.trim(F.coalesce(label, F.lit(""))))


def relative_path(path: Column, base: str) -> Column:
    """The path below ``base``, or its last part where it lies outside."""
    base = base.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(F.regexp_extract(path, r"([^/]*)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def same_stem(a: Column, b: Column) -> Column:
    return F.lower(stem(a)) == F.lower(stem(b))


def annotation_issues(a: Column) -> Column:
    """(bad, empty, soft) of a parsed annotation: issues that fail it, whether it has a list without shapes, and missing labels."""
    s = a["shapes"]
    listed = F.coalesce(s, F.array().cast(f"array<{SHAPE}>"))
    fails = F.array(
        F.when(a["imagePath"].isNull(), "missing_field:imagePath"),
        F.when(s.isNull(), "missing_field:shapes"),
    )
    no_points = F.transform(
        listed,
        lambda x, i: F.when(F.coalesce(x["shape_type"], x["type"], F.lit("polygon")).isin(*NEED_POINTS) & (F.coalesce(F.size(x["points"]), F.lit(0)) <= 0), F.concat(F.lit("missing_points:"), i.cast("string"))),
    )
    no_label = F.transform(listed, lambda x, i: F.when(F.trim(F.coalesce(x["label"], F.lit(""))) == "", F.concat(F.lit("missing_label:"), i.cast("string"))))
    return F.struct(F.array_compact(F.concat(fails, no_points)).alias("bad"), (F.size(s) == 0).alias("empty"), F.array_compact(no_label).alias("soft"))


def with_image_issues(found: Column, image_bytes: Column) -> Column:
    """(status, issues) of ``annotation_issues`` and the size of the image, null where that is absent."""
    warns = F.array(F.when(found["empty"], "empty_shapes"), F.when(image_bytes.isNull(), "missing_image").when(image_bytes < 100, "small_image"))
    bad, soft = found["bad"], F.concat(F.array_compact(warns), found["soft"])
    status = F.when(F.size(bad) > 0, "fail").when(F.size(soft) > 0, "warning").otherwise("pass")
    return F.struct(status.alias("status"), F.concat(bad, soft).alias("issues"))


def integrity(a: Column, image_bytes: Column) -> Column:
    """(status, issues) of a parsed annotation: fail for missing fields or points, warning for empty shapes, missing labels
    and images that are absent or under 100 bytes, else pass."""
    return with_image_issues(annotation_issues(a), image_bytes)


def detection_errors(raw: Column) -> Column:
    """Error strings of a JSON list of {box_2d, label}: not_list, or per item no_box, box_arity, box_number, box_range, no_label."""
    items = F.try_variant_get(F.try_parse_json(raw), "$", "array<variant>")
    is_list = F.coalesce(F.schema_of_variant(F.try_parse_json(raw)).startswith("ARRAY"), F.lit(False))

    def errors(v: Column, i: Column) -> Column:
        box = F.try_variant_get(v, "$.box_2d", "array<variant>")
        numbers = F.try_variant_get(v, "$.box_2d", "array<double>")
        label = F.try_variant_get(v, "$.label", "string")
        name = lambda what: F.concat(F.lit(what + ":"), i.cast("string"))
        return F.array_compact(
            F.array(
                F.when(box.isNull(), name("no_box")).when(F.size(box) != 4, name("box_arity")).when(numbers.isNull() | F.exists(numbers, lambda x: x.isNull()), name("box_number")).when(F.exists(numbers, lambda x: (x < 0) | (x > 1000)), name("box_range")),
                F.when(F.coalesce(label, F.lit("")) == "", name("no_label")),
            )
        )

    return F.when(~is_list, F.array(F.lit("not_list"))).otherwise(F.flatten(F.transform(items, errors)))


def find_images(annotations: DataFrame, manifest: DataFrame, strict: bool = True) -> DataFrame:
    """``annotations`` (path, dir, stem, image_path) with the ``image`` path each one means, or null.

    An absolute path must exist. Otherwise: the same directory and file name, else the same directory and stem with one of
    the known extensions (alphabetical first). Strict mode wants equal stems for the first two. ``manifest`` has path,
    dir, name, stem and ext; joins are by equality, and Spark broadcasts the manifest if it is small.
    """
    a = annotations.withColumn("_name", F.regexp_extract("image_path", r"([^/]*)$", 1)).withColumn("_absolute", F.col("image_path").startswith("/"))
    ok = (lambda image: F.lower(F.col("stem")) == F.lower(stem(image))) if strict else (lambda image: F.lit(True))
    by_path = manifest.select(F.col("path").alias("_p1"))
    by_name = manifest.select(F.col("dir").alias("_d2"), F.col("name").alias("_n2"), F.col("path").alias("_p2"))
    known = manifest.filter(F.lower("ext").isin(*IMAGE_EXTENSIONS)).groupBy(F.col("dir").alias("_d3"), F.col("stem").alias("_s3")).agg(F.min_by("path", F.lower("ext")).alias("_p3"))
    joined = spread_for_join(a, by_path, "image_path").join(by_path, F.col("_absolute") & (F.col("image_path") == F.col("_p1")), "left")
    joined = spread_for_join(joined, by_name, "dir", "_name").join(by_name, ~F.col("_absolute") & (F.col("dir") == F.col("_d2")) & (F.col("_name") == F.col("_n2")), "left")
    joined = spread_for_join(joined, known, "dir", "stem").join(known, ~F.col("_absolute") & (F.col("dir") == F.col("_d3")) & (F.col("stem") == F.col("_s3")), "left")
    image = F.coalesce(F.when(ok(F.col("_p1")), F.col("_p1")), F.when(ok(F.col("_p2")), F.col("_p2")), F.col("_p3"))
    return joined.withColumn("image", image).select(*annotations.columns, "image")


def primary_annotation(annotations: DataFrame) -> DataFrame:
    """One annotation per image: ``annotations`` (path, stem, image, shapes_count) with rank, status (primary or
    duplicate_annotation). First come those with the image's stem, in path order; then more shapes, shorter stem, stem, path."""
    matched = F.lower(F.col("stem")) == F.lower(stem(F.col("image")))
    w = Window.partitionBy("image").orderBy(F.desc(matched), F.when(~matched, -F.col("shapes_count")), F.when(~matched, F.length("stem")), F.when(~matched, F.lower("stem")), "path")
    ranked = spread(annotations, "image").withColumn("rank", F.row_number().over(w))
    return ranked.withColumn("status", F.when(F.col("rank") == 1, "primary").otherwise("duplicate_annotation"))


def record_status(raw: Column) -> Column:
    """The schema of a training record by its keys: openai, sharegpt, or why it is neither."""
    messages, turns = _kind(raw, "$.messages"), _kind(raw, "$.conversations")
    return (
        F.when(~is_object(raw), "invalid_json")
        .when(messages.startswith("ARRAY"), "openai")
        .when(turns.startswith("ARRAY"), "sharegpt")
        .when(messages.isNotNull(), "messages_no_list")
        .when(turns.isNotNull(), "conversations_no_list")
        .otherwise("unknown_schema")
    )


def record_error(raw: Column) -> Column:
    """The first fault of a training record's JSON text, or null. Chat turns (``conversations``) are looked at before ``messages``.

    not_json, unknown_schema; of turns: no_turns, first_not_human, second_not_gpt (of two), no_id, no_image; of messages:
    no_images, no_messages, first_not_user, second_not_assistant. A record without an answer is fine.
    """

    def judged(v: Column) -> Column:
        kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
        said = lambda path: F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))
        size = lambda path: F.coalesce(F.size(F.try_variant_get(v, path, "array<variant>")), F.lit(-1))
        turns = (
            F.when(size("$.conversations") < 1, "no_turns")
            .when(said("$.conversations[0].from") != "human", "first_not_human")
            .when((size("$.conversations") == 2) & (said("$.conversations[1].from") != "gpt"), "second_not_gpt")
            .when(kind("$.id").isNull(), "no_id")
            .when(kind("$.image").isNull(), "no_image")
        )
        messages = (
            F.when(kind("$.images").isNull(), "no_images")
            .when(size("$.messages") < 1, "no_messages")
            .when(said("$.messages[0].role") != "user", "first_not_user")
            .when((size("$.messages") > 1) & (said("$.messages[1].role") != "assistant"), "second_not_assistant")
        )
        return (
            F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), "not_json")
            .when(kind("$.conversations").isNotNull(), turns)
            .when(kind("$.messages").isNotNull(), messages)
            .otherwise("unknown_schema")
        )

    return g.let(F.try_parse_json(raw), judged)


def verify_records(lines: DataFrame, n: int, shown: int = 3) -> DataFrame:
    """One row on the records (index, value) whose index is below ``n``: checked, valid, passed, and the first ``shown`` errors."""
    rows = lines.filter(F.col("index") < n).select("index", record_error(F.col("value")).alias("error"))
    first = F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("index", "error"))))  # of n lines at most
    found = rows.agg(F.count("*").alias("checked"), F.count_if(F.col("error").isNull()).alias("valid"), F.slice(first, 1, shown).alias("e"))
    errors = F.array_join(F.transform("e", lambda e: F.concat(e["index"].cast("string"), F.lit(":"), e["error"])), "; ")
    return found.select("checked", "valid", (F.col("checked") == F.col("valid")).alias("passed"), errors.alias("errors"))


def complete_result(raw: Column, fields: tuple[str, ...] = ("train_runtime_sec", "train_loss", "samples_per_second", "steps_per_second", "peak_vram_gb")) -> Column:
    """Whether a training result has a number in every required field."""
    v = F.try_parse_json(raw)
    return F.forall(F.array(*[F.try_variant_get(v, f"$.{f}", "double") for f in fields]), lambda x: x.isNotNull())


def ratio(a: Column, b: Column) -> Column:
    """A percentage; null where the denominator is 0."""
    return F.try_divide(a, b) * 100
