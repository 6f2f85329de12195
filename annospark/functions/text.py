"""Prompts, response texts, and the way back from model text to boxes, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions import geometry as g

DETECTIONS = "array<struct<bbox:array<int>,label:string,confidence:double>>"
#: Own wording; a caller's templates come first. Keys: language, style, strategy.
PROMPTS = {
    ("en", "simple", "all_in_one"): "Find every object of these classes in the image: {class_list}. Answer with a JSON list.",
    ("en", "simple", "per_class"): "Find every {class_list} in the image. Answer with a JSON list.",
    ("en", "descriptive", "all_in_one"): "The image may show objects of these classes: {class_list}. Name the class and the bounding box of each one you see, as a JSON list.",
    ("en", "descriptive", "per_class"): "The image may show one {class_list} or several. Give the bounding box of each one you see, as a JSON list.",
    ("en", "cot", "all_in_one"): "First describe to yourself what the image shows, part by part. Then answer with a JSON list of every object of these classes: {class_list}.",
    ("en", "cot", "per_class"): "First describe to yourself what the image shows, part by part. Then answer with a JSON list of every {class_list}.",
    ("zh", "simple", "all_in_one"): "请找出图像中属于以下类别的所有目标：{class_list}。请用 JSON 列表回答。",
    ("zh", "simple", "per_class"): "请找出图像中所有的{class_list}。请用 JSON 列表回答。",
    ("zh", "descriptive", "all_in_one"): "图像中可能有以下类别的目标：{class_list}。请用 JSON 列表给出每个目标的类别和边框。",
    ("zh", "descriptive", "per_class"): "图像中可能有一个或多个{class_list}。请用 JSON 列表给出每一个的边框。",
    ("zh", "cot", "all_in_one"): "请先逐部分观察图像，再用 JSON 列表给出以下类别的所有目标：{class_list}。",
    ("zh", "cot", "per_class"): "请先逐部分观察图像，再用 JSON 列表给出所有的{class_list}。",
}
#: Own wording of list answers. Keys: language, strategy.
RESPONSES = {
    ("en", "all_in_one"): "Detected {count} objects:\n{items}",
    ("en", "per_class"): "{count} of class {class_list}:\n{items}",
    ("zh", "all_in_one"): "共有{count}个目标：\n{items}",
    ("zh", "per_class"): "{class_list}共{count}个：\n{items}",
}
STYLES = ("simple", "descriptive", "cot")


def detection_prompt(labels: Column, strategy: str = "all_in_one", lang: str = "en", custom: dict[str, str] | None = None, style: str = "simple") -> Column:
    """The prompt of a strategy, language and style for an array of labels (sorted, distinct). Custom templates, by keys like
    ``all_in_one_en``, come first; an unknown style or language gives a plain one."""
    template = (custom or {}).get(f"{strategy}_{lang}") or PROMPTS.get((lang, style, strategy)) or "Detect: {class_list}"
    names = F.array_join(F.array_sort(F.array_distinct(labels)), "、" if lang == "zh" else ", ")
    return F.replace(F.lit(template), F.lit("{class_list}"), names)


def query_prompt(query: Column, lang: str = "en") -> Column:
    a, b = ("Find in the image: ", ". Answer with a JSON list.") if lang == "en" else ("请在图像中找出：", "。请用 JSON 列表回答。")
    return F.concat(F.lit(a), F.trim(query), F.lit(b))


def list_response(boxes: Column, strategy: str = "all_in_one", norm: str = "norm_1000", lang: str = "en", category: Column | None = None) -> Column:
    """``- label: [a, b, c, d]`` lines (``- [a, b, c, d]`` per class) under a count; boxes: array<struct<coords, label>>.
    ``category`` names the class of a per-class answer, else the boxes' labels do."""
    line = lambda b: F.concat(F.lit("- "), F.lit("") if strategy == "per_class" else F.concat(b["label"], F.lit(": ")), g.coords_text(b["coords"], norm))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform(boxes, lambda b: b["label"]))), "、" if lang == "zh" else ", ") if category is None else category
    text = F.lit(RESPONSES.get((lang, strategy), "Objects:\n{items}"))
    for key, value in (("{count}", F.size(boxes).cast("string")), ("{class_list}", names), ("{items}", F.array_join(F.transform(boxes, line), "\n"))):
        text = F.replace(text, F.lit(key), value)
    return F.when(F.size(boxes) == 0, "No objects detected.").otherwise(text)


def _quoted(label: Column) -> Column:
    """A label as a JSON string."""
    return g.let(F.to_json(F.struct(label.alias("x"))), lambda j: j.substr(F.lit(6), F.length(j) - 6))


def _number(v: Column, norm: str) -> Column:
    return F.round(v, 4).cast("string") if norm == "norm_1" else v.cast("long").cast("string")


def json_response(boxes: Column, norm: str = "norm_1000", layout: str = "xyxy") -> Column:
    """``[{"box_2d": [..], "label": ".."}]`` with blanks after commas and colons; the first item also names norm and layout."""
    return joined_items(F.transform(boxes, lambda b: json_item(b["coords"], b["label"], norm)), norm, layout)


def json_item(coords: Column, label: Column, norm: str = "norm_1000") -> Column:
    """A box as ``json_response`` has it, up to its closing brace; null without coordinates."""
    numbers = F.array_join(F.transform(coords, lambda v: _number(v, norm)), ", ")
    return F.concat(F.lit('{"box_2d": ['), numbers, F.lit('], "label": '), _quoted(label))


def joined_items(items: Column, norm: str = "norm_1000", layout: str = "xyxy") -> Column:
    """The response that items of ``json_item`` make."""
    head = f', "coord_format": "{layout}", "coord_norm": "{norm}"'
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda s, i: F.concat(s, F.when(i == 0, head + "}").otherwise("}"))), ", "), F.lit("]"))


def legacy_response(boxes: Column) -> Column:
    """The older form: four places and confidence 1.0."""
    item = lambda b: F.concat(F.lit('{"bbox": ['), F.array_join(F.transform(b["coords"], lambda v: F.round(v, 4).cast("string")), ", "), F.lit('], "label": '), _quoted(b["label"]), F.lit(', "confidence": 1.0}'))
    return F.concat(F.lit("["), F.array_join(F.transform(boxes, item), ", "), F.lit("]"))


def extract_json_array(text: Column) -> Column:
    """The first JSON array of a text: inside a fenced block, else the first run of balanced brackets; null without one.

    Brackets inside strings are part of the strings. The scan keeps depth, length and end in one pass over strings, brackets
    and the runs between them.
    """
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\[.*?\])\s*```", 1)
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(-1).alias("end"))

    def step(s: Column, m: Column) -> Column:
        depth = s["depth"] + F.when(m == "[", 1).when(m == "]", -1).otherwise(0)
        n = s["n"] + F.length(m)
        return F.when(s["end"] >= 0, s).otherwise(F.struct(depth.alias("depth"), n.alias("n"), F.when(depth == 0, n).otherwise(-1).alias("end")))

    def balanced(rest: Column) -> Column:
        marks = F.regexp_extract_all(rest, F.lit(r'(?s)("(?:[^"\\]|\\.)*"|\[|\]|[^"\[\]]+|")'), 1)
        return g.let(F.aggregate(marks, zero, step, lambda s: s["end"]), lambda end: F.when(end > 0, F.substr(rest, F.lit(1), end)))

    found = F.when(F.locate("[", text) > 0, g.let(F.substr(text, F.locate("[", text)), balanced))
    return F.coalesce(F.nullif(fenced, F.lit("")), found)


def _pixels(c: Column, width: Column, height: Column, norm: str, auto_tiers: bool) -> Column:
    """Layout-free scaling of x, y, x, y numbers to pixels."""
    thousand = F.forall(c, lambda v: (v >= 0) & (v <= 1000))
    times = {"norm_1": F.lit(1.0), "norm_100": F.lit(100.0), "norm_1000": F.lit(1000.0)}
    scaled = lambda unit: F.array(*[F.get(c, i) / unit * (width if i % 2 == 0 else height) for i in range(4)])
    if norm in times:
        return scaled(times[norm])
    if norm == "raw":
        return c
    auto = F.when(g.all_unit(c), scaled(times["norm_1"]))
    return (auto.when(thousand, scaled(times["norm_1000"])) if auto_tiers else auto).otherwise(c)


def parse_detections(text: Column, width: Column, height: Column, norm: str = "auto", layout: str = "xyxy", default_confidence: float = 1.0, auto_tiers: bool = False, clamp: bool = False, out_layout: str = "xyxy") -> Column:
    """Boxes of a model's or a record's text: array of (bbox int pixels, label, confidence).

    Items need ``box_2d`` (or ``bbox``) of four numbers; others are left out. Confidence is clamped to 0-1 and missing or no
    number gives the default; a missing label gives ``object``. ``auto`` takes 0-1 numbers as shares and, with ``auto_tiers``, other
    numbers up to 1000 as thousandths. With ``clamp``, boxes are cut to the image and empty ones go; ``out_layout`` is the
    layout of the boxes given back. Text without an array is searched for loose objects.
    """
    size = lambda i: (width if i % 2 == 0 else height).cast("double")
    loose = F.concat(F.lit("["), F.array_join(F.regexp_extract_all(text, F.lit(r'(\{[^{}]*"(?:box_2d|bbox)"[^{}]*\})'), 1), ","), F.lit("]"))
    objects = lambda v: F.when(F.schema_of_variant(v).rlike(r"^ARRAY<(OBJECT|VARIANT)"), F.try_variant_get(v, "$", "array<variant>"))
    items = F.coalesce(g.let(F.try_parse_json(extract_json_array(text)), objects), g.let(F.try_parse_json(loose), objects), F.array().cast("array<variant>"))
    has_number = lambda v: ~F.schema_of_variant(v).rlike("STRING|VARIANT|OBJECT|BOOLEAN|VOID")

    def made(v: Column) -> Callable[[Column], Column]:
        conf = g.let(F.try_variant_get(v, "$.confidence", "variant"), lambda c: F.when(has_number(c), F.try_variant_get(c, "$", "double")))
        return lambda px: F.struct(
            F.transform(px if out_layout == "xyxy" else g.layout(g.from_layout(px), out_layout), lambda x: x.cast("int")).alias("bbox"),
            F.coalesce(F.nullif(F.try_variant_get(v, "$.label", "string"), F.lit("")), F.lit("object")).alias("label"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(conf, F.lit(default_confidence)))).alias("confidence"),
        )

    def scaled(v: Column) -> Callable[[Column], Column]:
        def body(c: Column) -> Column:
            px = g.let(g.layout(g.from_layout(c, layout)), lambda x: _pixels(x, width, height, norm, auto_tiers))
            if not clamp:
                return g.let(px, made(v))
            cut = g.let(px, lambda x: F.array(*[F.greatest(F.lit(0.0), F.least(F.get(x, i), size(i))) for i in range(4)]))
            return g.let(cut, lambda x: F.when((F.get(x, 2) > F.get(x, 0)) & (F.get(x, 3) > F.get(x, 1)), made(v)(x)))

        return body

    def one(v: Column) -> Column:
        numbers = lambda b: F.when(has_number(b), F.try_variant_get(b, "$", "array<double>"))
        box = g.let(F.coalesce(F.try_variant_get(v, "$.box_2d", "variant"), F.try_variant_get(v, "$.bbox", "variant")), numbers)
        return g.let(box, lambda c: F.when(F.size(c) == 4, scaled(v)(c)))

    return F.array_compact(F.transform(items, one))


def parse_list_text(text: Column, width: Column, height: Column) -> Column:
    """Boxes of ``- label: [a, b, c, d]`` lines; numbers that are all in 0-1 are shares, others pixels."""
    lines = F.regexp_extract_all(text, F.lit(r"(?m)^- ?([^:\n]+: ?\[[-\d., ]+\])"), 1)

    def one(line: Column) -> Column:
        c = F.split(F.regexp_extract(line, r"\[([^\]]*)\]", 1), r",\s*")
        name = F.trim(F.regexp_extract(line, r"^([^:]+):", 1))
        made = lambda c: F.struct(F.transform(_pixels(c, width, height, "auto", False), lambda x: x.cast("int")).alias("bbox"), name.alias("label"), F.lit(1.0).alias("confidence"))
        return g.let(F.transform(c, lambda v: v.try_cast("double")), lambda c: F.when((F.size(c) == 4) & F.forall(c, lambda v: v.isNotNull()), made(c)))

    return F.array_compact(F.transform(lines, one))


def role_text(messages: Column, role: str) -> Column:
    """All text items of a role's messages, joined by line ends."""
    own = F.filter(messages, lambda m: m["role"] == role)
    return F.array_join(F.flatten(F.transform(own, lambda m: F.transform(F.filter(m["content"], lambda c: c["type"] == "text"), lambda c: c["text"]))), "\n")


def first_query(messages: Column) -> Column:
    """The first text item of the first user message."""
    own = F.filter(messages, lambda m: m["role"] == "user")
    return F.get(F.transform(F.filter(F.get(own, 0)["content"], lambda c: c["type"] == "text"), lambda c: c["text"]), 0)


def record_image(images: Column, json_path: Column) -> Column:
    """Where a record's image is: the first of its images, else its annotation's path."""
    return F.coalesce(F.nullif(F.get(images, 0), F.lit("")), json_path)


def ground_truth(messages: Column, width: Column, height: Column, norm: str = "auto", layout: str = "xyxy") -> Column:
    """Boxes of a record's assistant texts: JSON first, else list lines."""
    def read(text: Column) -> Column:
        found = parse_detections(text, width, height, norm, layout)
        return g.let(found, lambda d: F.when(F.size(d) > 0, d).otherwise(parse_list_text(text, width, height)))

    return g.let(role_text(messages, "assistant"), read)


def chat_text(messages: Column, template: str = "<{role}>{text}</{role}>\n") -> Column:
    """Messages as one text by a template with {role} and {text}."""
    one = lambda m: F.replace(F.replace(F.lit(template), F.lit("{role}"), m["role"]), F.lit("{text}"), F.array_join(F.transform(m["content"], lambda c: F.coalesce(c["text"], F.lit(""))), ""))
    return F.array_join(F.transform(messages, one), "")


def user_only(messages: Column) -> Column:
    return F.filter(messages, lambda m: m["role"] == "user")


def with_images(messages: Column, images: Column) -> Column:
    """Image items at the front of the first user message; image items it had go. Images stay references."""
    first = F.array_position(F.transform(messages, lambda m: m["role"]), F.lit("user")) - 1
    items = F.transform(images, lambda p: F.struct(F.lit("image").alias("type"), p.alias("text")))
    return F.transform(messages, lambda m, i: F.when(i == first, m.withField("content", F.concat(items, F.filter(m["content"], lambda c: c["type"] != "image")))).otherwise(m))


def sharegpt(record_id: Column, image: Column, messages: Column) -> Column:
    """(id, image, conversations): human and gpt turns, the first human turn with an image mark before it."""
    who = lambda m: F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"])
    text = lambda m: F.array_join(F.transform(F.filter(m["content"], lambda c: c["type"] == "text"), lambda c: c["text"]), "\n")
    first = F.array_position(F.transform(messages, lambda m: m["role"]), F.lit("user")) - 1
    turns = F.transform(messages, lambda m, i: F.struct(who(m).alias("from"), F.concat(F.when(i == first, F.lit("<image>\n")).otherwise(""), text(m)).alias("value")))
    return F.struct(record_id.alias("id"), image.alias("image"), turns.alias("conversations"))


def training_message(query: Column, answer: Column, image: Column) -> Column:
    """One record: a user message with an image and the query, and the assistant's answer."""
    item = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    user = F.struct(F.lit("user").alias("role"), F.array(item("image", image), item("text", query)).alias("content"))
    return F.array(user, F.struct(F.lit("assistant").alias("role"), F.array(item("text", answer)).alias("content")))


def first_text(df: DataFrame, names: tuple[str, ...] = ("text", "content", "input")) -> Column:
    """The first of these columns that ``df`` has and that is not null."""
    return F.coalesce(*[F.col(c).cast("string") for c in names if c in df.columns], F.lit(None).cast("string"))


def image_reference(path: Column, base: str, mode: str = "relative", content: Column | None = None) -> Column:
    """How a record names its image: relative, absolute, copy (below images/), or its content in base64."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    if mode == "relative":
        folder = base.rstrip("/") + "/"
        return F.when(path.startswith(folder), F.substr(path, F.lit(len(folder) + 1))).otherwise(name)
    if mode == "absolute":
        return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))
    if mode == "copy":
        return F.concat(F.lit("images/"), name)
    if mode == "base64" and content is not None:
        return F.translate(F.base64(content), "\r\n", "")  # Spark breaks the lines
    raise ValueError(f"unknown image mode: {mode}")
