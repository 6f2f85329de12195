"""Queries on training records and text, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark import fixtures as fx
from annospark.functions import text as t
from annospark.operators import records as r
from annospark.queries.geometry import VALID_SQL
from annospark.sources import files


def record_prompts(spark, sf):
    rows = r.convert(fx.annotations(spark, sf))
    return rows.select("record_id", "num_objects", F.array_join("labels", "|").alias("labels"), t.first_query(F.col("messages")).alias("prompt"), F.length(t.role_text(F.col("messages"), "assistant")).alias("response_length"))


def per_class_records(spark, sf):
    rows = r.convert(fx.annotations(spark, sf), "per_class")
    return rows.select("record_id", "num_objects", t.first_query(F.col("messages")).alias("prompt"))


def response_json(spark, sf):
    """The response text of every image with usable boxes."""
    rows = r.convert(fx.annotations(spark, sf))
    return rows.select("record_id", t.role_text(F.col("messages"), "assistant").alias("response"))


def conversion_counters(spark, sf):
    return r.conversion_counters(fx.annotations(spark, sf))


def filtered_records(spark, sf):
    """Labels are mapped before the lists of allowed and denied ones apply."""
    rows = r.convert(fx.annotations(spark, sf), remap={"SMALL": "TINY", "LARGE": "BIG"}, allow=["TINY", "BIG", "PROMO"], deny=["PROMO"], min_size=20)
    return rows.select("record_id", "num_objects", F.array_join("labels", "|").alias("labels"))


def both_strategies(spark, sf):
    rows = r.both_strategies(fx.annotations(spark, sf))
    return rows.groupBy("strategy").agg(F.count("*").alias("records"), F.sum("num_objects").alias("objects"))


def round_trip(spark, sf):
    """Boxes that are read back from their own response text."""
    rows = r.convert(fx.annotations(spark, sf))
    back = t.ground_truth(F.col("messages"), F.col("width"), F.col("height"), "norm_1000")
    rows = rows.select("record_id", F.explode(back).alias("d"))
    return rows.select("record_id", F.col("d.label").alias("label"), *[F.get("d.bbox", i).alias(f"p{i}") for i in range(4)], F.col("d.confidence").alias("confidence"))


def list_round_trip(spark, sf):
    """Pixel boxes through list lines and back, in single-box images."""
    a = fx.annotations(spark, sf).withColumn("b", F.filter(r.usable_boxes(F.col("shapes"), F.col("width"), F.col("height"), norm="raw"), lambda b: b["reason"].isNull())).filter(F.size("b") == 1)
    text = t.list_response(F.col("b"), norm="raw")
    d = F.get(t.parse_list_text(text, F.col("width"), F.col("height")), 0)
    return a.select("image_id", text.alias("text"), d["label"].alias("label"), F.array_join(d["bbox"].cast("array<string>"), ",").alias("bbox"))


def parse_model_text(spark, sf):
    """Damaged and wrapped answers made from events."""
    e = fx.table(spark, sf, "events").withColumn("n", F.floor(F.col("value")).cast("long"))
    k = F.col("event_id") % 8
    item = F.concat(F.lit('{"box_2d": [10, 20, '), (F.col("n") % 500 + 20).cast("string"), F.lit(', 400], "label": "a[b]", "confidence": '), (F.col("n") % 4).cast("string"), F.lit("}"))
    text = (
        F.when(k == 0, F.concat(F.lit("Here:\n```json\n["), item, F.lit("]\n```\nDone.")))
        .when(k == 1, F.concat(F.lit("I see ["), item, F.lit(', {"box_2d": [1, 2, 3]}, {"label": "x"}] there [1]')))
        .when(k == 2, F.lit("nothing here"))
        .when(k == 3, F.concat(F.lit("loose "), item, F.lit(" and "), item))
        .when(k == 4, F.lit('[{"box_2d": ["1", "2", "3", "4"], "label": "s"}]'))
        .when(k == 5, F.lit('[{"box_2d": [0.1, 0.2, 0.5, 0.8]}]'))
        .when(k == 6, F.concat(F.lit('[{"box_2d": [30, 40, 30, 60], "label": "flat"}, '), item, F.lit("]")))
        .otherwise(F.lit('[{"box_2d": [1, 2'))
    )
    found = t.parse_detections(text, F.lit(640), F.lit(480), norm="auto", clamp=True, default_confidence=0.85)
    rows = e.select("event_id", F.size(found).alias("n"), F.get(found, 0).alias("d"))
    return rows.select("event_id", "n", F.col("d.label").alias("label"), F.array_join(F.col("d.bbox").cast("array<string>"), ",").alias("bbox"), F.col("d.confidence").alias("confidence"))


def prompt_styles(spark, sf):
    """Every question of every style and language about each image's labels, and one by a caller's builder."""
    rows = r.convert(fx.annotations(spark, sf))
    asked = [(style, lang, strategy, t.detection_prompt(F.col("labels"), strategy, lang, style=style)) for style in (*t.STYLES, "other") for lang in ("en", "zh") for strategy in ("all_in_one", "per_class")]
    asked += [("custom", "en", "all_in_one", t.detection_prompt(F.col("labels"), custom=files.load_templates('{"all_in_one_en": "Any {class_list}?"}')))]
    one = F.explode(F.array(*[F.struct(F.lit(a).alias("style"), F.lit(b).alias("lang"), F.lit(c).alias("strategy"), d.alias("prompt")) for a, b, c, d in asked]))
    return rows.select("record_id", one.alias("x")).select("record_id", "x.*")


def built_prompts(spark, sf):
    """Records whose question a caller's function makes and whose answer is a list."""
    rows = r.convert(fx.annotations(spark, sf), "per_class", prompt=lambda labels: F.concat(F.lit("Where is "), F.get(labels, 0), F.lit("?")), output="list", norm="raw", lang="zh")
    text = t.role_text(F.col("messages"), "assistant")
    return rows.select("record_id", t.first_query(F.col("messages")).alias("prompt"), text.alias("answer"))


def list_responses(spark, sf):
    """List answers of each language and strategy to each image."""
    a = fx.annotations(spark, sf).withColumn("b", F.filter(r.usable_boxes(F.col("shapes"), F.col("width"), F.col("height"), norm="raw"), lambda b: b["reason"].isNull()))
    made = [(lang, strategy, t.list_response(F.col("b"), strategy, "raw", lang)) for lang in ("en", "zh") for strategy in ("all_in_one", "per_class")]
    one = F.explode(F.array(*[F.struct(F.lit(x).alias("lang"), F.lit(y).alias("strategy"), z.alias("text")) for x, y, z in made]))
    return a.select("image_id", one.alias("x")).select("image_id", "x.*")


def legacy_responses(spark, sf):
    """Every box that the older answer for each image holds; labels have quotes to be escaped."""
    shapes = F.transform("shapes", lambda s: s.withField("label", F.concat(F.lit('"'), s["label"], F.lit('"\\'))))
    a = fx.annotations(spark, sf).withColumn("b", F.filter(r.usable_boxes(shapes, F.col("width"), F.col("height")), lambda b: b["reason"].isNull())).filter(F.size("b") > 0)
    text = t.legacy_response(F.array_sort("b"))
    back = F.from_json(text, "array<struct<label:string,bbox:array<double>,confidence:double>>")
    rows = a.select("image_id", F.posexplode(back).alias("pos", "d"))
    return rows.select("image_id", "pos", "d.label", *[F.get("d.bbox", i).alias(f"p{i}") for i in range(4)], "d.confidence")


def parsed_layouts(spark, sf):
    """Answers in each layout, read and given back in another one."""
    e = fx.table(spark, sf, "events").withColumn("n", (F.floor("value") % 300).cast("int"))
    n = F.col("n")
    rows = []
    for given, wanted, numbers in (("xyxy", "cxcywh", (n, n + 10, n + 40, n + 70)), ("yxyx", "xywh", (n + 10, n, n + 70, n + 40)), ("xywh", "yxyx", (n, n + 10, F.lit(40), F.lit(60))), ("cxcywh", "xyxy", (n + 20, n + 40, F.lit(40), F.lit(60)))):
        text = F.concat(F.lit('[{"box_2d": ['), F.concat_ws(", ", *[x.cast("string") for x in numbers]), F.lit("]}]"))
        found = F.get(t.parse_detections(text, F.lit(640), F.lit(480), "raw", given, out_layout=wanted), 0)["bbox"]
        rows.append(F.struct(F.lit(given).alias("layout"), F.array_join(found.cast("array<string>"), ",").alias("bbox")))
    return e.select("event_id", F.explode(F.array(*rows)).alias("x")).select("event_id", "x.*")


def image_references(spark, sf):
    """How records name their images in each mode, and where a record without images has its own."""
    d = fx.table(spark, sf, "pages").select("page_id", F.concat(F.lit("/data/"), F.col("page_id").cast("string"), F.lit(".png")).alias("path"), "html")
    modes = [t.image_reference(F.col("path"), "/data", m, F.encode("html", "UTF-8")).alias(m) for m in ("relative", "absolute", "copy", "base64")]
    own = t.record_image(F.when(F.col("page_id") % 2 == 0, F.array("path")).otherwise(F.array().cast("array<string>")), F.concat("path", F.lit(".json")))
    found = d.select("page_id", *modes, t.image_reference(F.concat(F.lit("x"), "path"), "/data").alias("outside"), own.alias("own"))
    return found.withColumn("base64", F.md5("base64"))


def text_columns(spark, sf):
    """The text of rows that have it in one of several columns."""
    e = fx.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("content"), "props", F.floor("value").alias("input"))
    return e.select("event_id", t.first_text(e).alias("text"), t.first_text(e, ("text", "props")).alias("props"), t.first_text(e, ("text",)).alias("none"))


def stripped_splits(spark, sf):
    """Turns left in the records of each split, for messages and for chat turns."""
    split = F.element_at(F.array(*[F.lit(s) for s in ("train", "val", "test")]), (F.col("conv_id") % 3 + 1).cast("int"))
    c = fx.records(spark, sf).withColumn("split", split)
    rows = None
    for schema in ("openai", "sharegpt"):
        one = r.strip_answers(c, schema).select(F.lit(schema).alias("schema"), "split", F.explode("messages.role").alias("role")).groupBy("schema", "split", "role").agg(F.count("*").alias("turns"))
        rows = one if rows is None else rows.unionAll(one)
    return rows


def chat_records(spark, sf):
    c = fx.records(spark, sf)
    return c.select("conv_id", F.size("messages").alias("turns"), t.first_query(F.col("messages")).alias("query"), F.md5(t.chat_text(F.col("messages"))).alias("chat_md5"), F.size(t.user_only(F.col("messages"))).alias("user_turns"))


def sharegpt_records(spark, sf):
    c = fx.records(spark, sf)
    s = t.sharegpt(F.col("conv_id").cast("string"), F.lit("i.jpg"), F.col("messages"))
    rows = c.select(s.alias("s")).select("s.id", F.posexplode("s.conversations").alias("pos", "turn"))
    return rows.select("id", "pos", F.col("turn.from").alias("speaker"), F.md5("turn.value").alias("value_md5"))


def message_images(spark, sf):
    c = fx.records(spark, sf)
    m = t.with_images(F.col("messages"), F.array(F.concat(F.lit("img"), F.col("conv_id").cast("string"))))
    rows = c.select("conv_id", F.posexplode(m).alias("pos", "m"))
    return rows.select("conv_id", "pos", F.col("m.role").alias("role"), F.size("m.content").alias("items"), F.get("m.content", 0)["type"].alias("first_type"))


QUERIES = {f.__name__: f for f in (record_prompts, per_class_records, response_json, conversion_counters, filtered_records, both_strategies, round_trip, list_round_trip, parse_model_text, prompt_styles, built_prompts, list_responses, legacy_responses, parsed_layouts, image_references, text_columns, stripped_splits, chat_records, sharegpt_records, message_images)}

_USABLE = VALID_SQL + """, u AS (SELECT image_id, width, height, label, x_min, y_min, x_max, y_max,
   round_even(x_min / width * 1000, 0)::BIGINT AS a, round_even(y_min / height * 1000, 0)::BIGINT AS b, round_even(x_max / width * 1000, 0)::BIGINT AS c, round_even(y_max / height * 1000, 0)::BIGINT AS d
   FROM valid WHERE shape_type IN ('rectangle', 'polygon'))"""
_ITEM = """'{"box_2d": [' || concat_ws(', ', a, b, c, d) || '], "label": "' || label || '"' """
_HEAD = """', "coord_format": "xyxy", "coord_norm": "norm_1000"' """
_LINE = "'- [' || concat_ws(', ', x_min::BIGINT, y_min::BIGINT, x_max::BIGINT, y_max::BIGINT) || ']'"
_TURNS = "t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS pos, coalesce(text, '') AS x FROM conversations)"
ORACLE_SQL = {
    "record_prompts": f"""WITH {_USABLE} SELECT 'img_' || image_id AS record_id, count(*)::INT AS num_objects, string_agg(DISTINCT label, '|' ORDER BY label) AS labels,
      'Find every object of these classes in the image: ' || string_agg(DISTINCT label, ', ' ORDER BY label) || '. Answer with a JSON list.' AS prompt,
      (sum(length({_ITEM}) + 1) + 2 * count(*) + length({_HEAD}))::INT AS response_length FROM u GROUP BY image_id""",
    "per_class_records": f"WITH {_USABLE} SELECT 'img_' || image_id || '_' || label AS record_id, count(*)::INT AS num_objects, 'Find every ' || label || ' in the image. Answer with a JSON list.' AS prompt FROM u GROUP BY image_id, label",
    "response_json": f"""WITH {_USABLE}, w AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY x_min, y_min, x_max, y_max, label) AS k FROM u)
      SELECT 'img_' || image_id AS record_id, '[' || string_agg({_ITEM} || CASE WHEN k = 1 THEN {_HEAD} ELSE '' END || '}}', ', ' ORDER BY k) || ']' AS response FROM w GROUP BY image_id""",
    "prompt_styles": f"""WITH {_USABLE}, n AS (SELECT image_id, string_agg(DISTINCT label, ', ' ORDER BY label) AS en, string_agg(DISTINCT label, '、' ORDER BY label) AS zh FROM u GROUP BY 1),
      t(style, lang, strategy, text) AS (VALUES {", ".join(f"('{a}', '{b}', '{c}', '{x}')" for (b, a, c), x in t.PROMPTS.items())}, {", ".join(f"('other', '{b}', '{c}', 'Detect: {{class_list}}')" for b in ("en", "zh") for c in ("all_in_one", "per_class"))}, ('custom', 'en', 'all_in_one', 'Any {{class_list}}?'))
      SELECT 'img_' || image_id AS record_id, style, lang, strategy, replace(text, '{{class_list}}', CASE WHEN lang = 'zh' THEN zh ELSE en END) AS prompt FROM n, t""",
    "built_prompts": f"WITH {_USABLE} SELECT 'img_' || image_id || '_' || label AS record_id, 'Where is ' || label || '?' AS prompt, label || '共' || count(*) || '个：' || string_agg(chr(10) || {_LINE}, '' ORDER BY x_min, y_min, x_max, y_max) AS answer FROM u GROUP BY image_id, label",
    "list_responses": f"""WITH {_USABLE}, c AS (SELECT image_id, count(*) AS n, string_agg(DISTINCT label, ', ' ORDER BY label) AS en, string_agg(DISTINCT label, '、' ORDER BY label) AS zh,
        string_agg(chr(10) || {_LINE}, '' ORDER BY x_min, y_min, x_max, y_max, label) AS plain, string_agg(chr(10) || replace({_LINE}, '- ', '- ' || label || ': '), '' ORDER BY x_min, y_min, x_max, y_max, label) AS named FROM u GROUP BY 1),
      h AS (SELECT image_id, lang, strategy, CASE WHEN lang = 'en' THEN CASE WHEN strategy = 'all_in_one' THEN 'Detected ' || n || ' objects:' ELSE n || ' of class ' || en || ':' END ELSE CASE WHEN strategy = 'all_in_one' THEN '共有' || n || '个目标：' ELSE zh || '共' || n || '个：' END END
          || CASE WHEN strategy = 'all_in_one' THEN named ELSE plain END AS text
        FROM c, (VALUES ('en'), ('zh')) a(lang), (VALUES ('all_in_one'), ('per_class')) b(strategy))
      SELECT i.image_id, a.lang, b.strategy, coalesce(text, 'No objects detected.') AS text FROM images i CROSS JOIN (VALUES ('en'), ('zh')) a(lang) CROSS JOIN (VALUES ('all_in_one'), ('per_class')) b(strategy) LEFT JOIN h ON h.image_id = i.image_id AND h.lang = a.lang AND h.strategy = b.strategy""",
    "legacy_responses": f"""WITH {_USABLE} SELECT image_id, (row_number() OVER (PARTITION BY image_id ORDER BY a, b, c, d, label) - 1)::INT AS pos, '"' || label || '"\\' AS label,
      a::DOUBLE AS p0, b::DOUBLE AS p1, c::DOUBLE AS p2, d::DOUBLE AS p3, 1.0::DOUBLE AS confidence FROM u""",
    "parsed_layouts": """WITH n AS (SELECT event_id, (floor(value)::BIGINT % 300)::INT AS n FROM events)
      SELECT event_id, 'xyxy' AS layout, concat_ws(',', n + 20, n + 40, 40, 60) AS bbox FROM n UNION ALL SELECT event_id, 'yxyx', concat_ws(',', n, n + 10, 40, 60) FROM n
      UNION ALL SELECT event_id, 'xywh', concat_ws(',', n + 10, n, n + 70, n + 40) FROM n UNION ALL SELECT event_id, 'cxcywh', concat_ws(',', n, n + 10, n + 40, n + 70) FROM n""",
    "image_references": """SELECT page_id, page_id || '.png' AS relative, '/data/' || page_id || '.png' AS absolute, 'images/' || page_id || '.png' AS copy, md5(base64(encode(html))) AS base64, page_id || '.png' AS outside,
      '/data/' || page_id || CASE WHEN page_id % 2 = 0 THEN '.png' ELSE '.png.json' END AS own FROM pages""",
    "text_columns": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE floor(value)::BIGINT::VARCHAR END AS text, props, NULL::VARCHAR AS none FROM events",
    "stripped_splits": """WITH c AS (SELECT ['train', 'val', 'test'][conv_id % 3 + 1] AS split, role FROM conversations) SELECT schema, split, role, count(*) AS turns FROM c, (VALUES ('openai'), ('sharegpt')) s(schema)
      WHERE role = 'user' OR split = 'train' OR (schema = 'openai' AND split = 'val') GROUP BY ALL""",
    "conversion_counters": f"""WITH {_USABLE}, n AS (SELECT image_id, count(*) AS k FROM u GROUP BY 1)
      SELECT (SELECT count(*) FROM n) AS converted, (SELECT count(*) FROM images) - (SELECT count(*) FROM n) AS empty,
             (SELECT count(*) FROM shapes WHERE shape_type IN ('rectangle', 'polygon')) - (SELECT sum(k)::BIGINT FROM n) AS invalid_boxes, (SELECT sum(k)::BIGINT FROM n) AS objects""",
    "filtered_records": f"""WITH {_USABLE}, f AS (SELECT image_id, CASE label WHEN 'SMALL' THEN 'TINY' WHEN 'LARGE' THEN 'BIG' END AS label FROM u WHERE label IN ('SMALL', 'LARGE') AND x_max - x_min >= 20 AND y_max - y_min >= 20)
      SELECT 'img_' || image_id AS record_id, count(*)::INT AS num_objects, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM f GROUP BY image_id""",
    "both_strategies": f"""WITH {_USABLE} SELECT 'all_in_one' AS strategy, count(DISTINCT image_id) AS records, count(*) AS objects FROM u
      UNION ALL SELECT 'per_class', (SELECT count(*) FROM (SELECT DISTINCT image_id, label FROM u)), count(*) FROM u""",
    "round_trip": f"WITH {_USABLE} SELECT 'img_' || image_id AS record_id, label, trunc(a / 1000 * width)::INT AS p0, trunc(b / 1000 * height)::INT AS p1, trunc(c / 1000 * width)::INT AS p2, trunc(d / 1000 * height)::INT AS p3, 1.0::DOUBLE AS confidence FROM u",
    "list_round_trip": f"""WITH {_USABLE}, o AS (SELECT image_id FROM u GROUP BY 1 HAVING count(*) = 1) SELECT image_id, 'Detected 1 objects:' || chr(10) || '- ' || label || ': [' || concat_ws(', ', x_min::BIGINT, y_min::BIGINT, x_max::BIGINT, y_max::BIGINT) || ']' AS text,
      label, concat_ws(',', x_min::BIGINT, y_min::BIGINT, x_max::BIGINT, y_max::BIGINT) AS bbox FROM u JOIN o USING (image_id)""",
    "parse_model_text": """SELECT event_id, CASE WHEN k IN (0, 1, 6) THEN 1 WHEN k = 3 THEN 2 WHEN k = 5 THEN 1 ELSE 0 END::INT AS n,
      CASE WHEN k IN (0, 1, 3, 6) THEN 'a[b]' WHEN k = 5 THEN 'object' END AS label, CASE WHEN k IN (0, 1, 3, 6) THEN '10,20,' || (floor(value)::BIGINT % 500 + 20) || ',400' WHEN k = 5 THEN '64,96,320,384' END AS bbox,
      CASE WHEN k IN (0, 1, 3, 6) THEN least(1.0, floor(value)::BIGINT % 4)::DOUBLE WHEN k = 5 THEN 0.85::DOUBLE END AS confidence FROM (SELECT *, event_id % 8 AS k FROM events)""",
    "chat_records": f"""WITH {_TURNS} SELECT conv_id, count(*)::INT AS turns, arg_min(x, pos) FILTER (role = 'user') AS query, md5(string_agg('<' || role || '>' || x || '</' || role || '>' || chr(10), '' ORDER BY pos)) AS chat_md5,
      count(*) FILTER (role = 'user')::INT AS user_turns FROM t GROUP BY conv_id""",
    "sharegpt_records": f"""WITH {_TURNS}, f AS (SELECT *, min(pos) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS first FROM t)
      SELECT conv_id::VARCHAR AS id, pos::INT AS pos, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS speaker, md5(CASE WHEN pos = first THEN '<image>' || chr(10) ELSE '' END || x) AS value_md5 FROM f""",
    "message_images": f"""WITH {_TURNS}, f AS (SELECT *, min(pos) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS first FROM t)
      SELECT conv_id, pos::INT AS pos, role, CASE WHEN pos = first THEN 2 ELSE 1 END::INT AS items, CASE WHEN pos = first THEN 'image' ELSE 'text' END AS first_type FROM f""",
}
