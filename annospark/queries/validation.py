"""Queries on structural checks, image lookup and de-duplication, with their SQL.

Annotation JSON is written from the annotation view; the image number decides which file is damaged, and how.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from annospark import fixtures as fx
from annospark.operators import records, stats
from annospark.operators import validate as v
from annospark.operators.spread import once, spread_for_join


def _raw(spark, sf):
    a = fx.annotations(spark, sf)
    i = F.col("image_id")
    path = F.concat(F.lit("/data/set"), (i % 5).cast("string"), F.lit("/"), F.col("stem"), F.lit(".json"))
    name = F.concat(F.when(i % 6 == 0, F.concat(F.lit("other_"), i.cast("string"))).otherwise(F.col("stem")), F.when(i % 4 == 0, ".png").otherwise(".jpg"))
    base = {"version": F.lit("5"), "imageWidth": F.col("width"), "imageHeight": F.col("height")}
    made = lambda **more: F.to_json(F.struct(*[c.alias(k) for k, c in (base | more).items()]))
    url = F.when(i % 9 == 0, F.concat(F.lit("http://host/"), F.col("stem")))
    raw = (
        F.when(i % 20 == 1, "{bad json")
        .when(i % 20 == 2, made(imagePath=name))
        .when(i % 20 == 3, made(imagePath=name, shapes=F.lit("none")))
        .when(i % 20 == 4, made(shapes=F.col("shapes")))
        .otherwise(made(imagePath=name, imageUrl=url, shapes=F.col("shapes")))
    )
    return once(a.select("image_id", "image_key", "stem", "width", "height", path.alias("path"), raw.alias("_raw")), raw=F.col("_raw")).drop("_raw")


_HAS = "(SELECT image_id, count(*) AS n FROM shapes GROUP BY 1)"
RAW_SQL = fx.SHAPES_SQL + f""", raw AS (
  SELECT i.*, coalesce(n, 0) AS n, '/data/set' || i.image_id % 5 || '/' || stem || '.json' AS path,
    CASE WHEN i.image_id % 6 = 0 THEN 'other_' || i.image_id ELSE stem END || CASE WHEN i.image_id % 4 = 0 THEN '.png' ELSE '.jpg' END AS name,
    CASE WHEN i.image_id % 20 = 1 THEN 'invalid_json' WHEN i.image_id % 20 IN (2, 3) THEN 'missing_shapes' WHEN coalesce(n, 0) = 0 THEN 'empty_shapes'
         WHEN i.image_id % 20 = 4 THEN 'invalid_image_path' ELSE 'valid' END AS status
  FROM images i LEFT JOIN {_HAS} USING (image_id))"""
STATUSES = ("valid", "invalid_json", "missing_shapes", "empty_shapes", "invalid_image_path")


def structure_status(spark, sf):
    return _raw(spark, sf).select("image_id", v.structure(F.col("raw")).alias("s")).select("image_id", "s.status", "s.shapes_count")


def cleaning_summary(spark, sf):
    return stats.status_summary(structure_status(spark, sf), STATUSES)


def _parsed(spark, sf):
    return once(_raw(spark, sf), a=v.parse(F.col("raw")), ok=v.is_object(F.col("raw")))


def image_source(spark, sf):
    s = v.image_source(F.col("a"))
    return _parsed(spark, sf).filter("ok").select("image_id", s["kind"].alias("kind"), s["value"].alias("value"))


def prescan(spark, sf):
    return stats.prescan(_parsed(spark, sf))


def prescan_labels(spark, sf):
    return stats.prescan_labels(_parsed(spark, sf))


def mapped_labels(spark, sf):
    rows = _parsed(spark, sf).filter("ok").select("image_id", F.explode(v.map_labels(F.col("a.shapes"), {"PROMO": "promo-item", "SMALL": "compact", "LARGE": "compact"})).alias("s"))
    return rows.groupBy("s.label", "s.original_label").agg(F.count("*").alias("n"), F.count_if("s.label_mapped").alias("mapped"))


def standardized(spark, sf):
    rows = v.standardize(_parsed(spark, sf).filter("ok")).select("cleaning_status", F.explode("standard_shapes").alias("s"))
    return rows.groupBy("cleaning_status", "s.label_normalized", "s.shape_type").agg(F.count("*").alias("n"))


def relative_paths(spark, sf):
    return _raw(spark, sf).select("image_id", v.relative_path(F.col("path"), "/data/set1").alias("relative"), v.stem(F.col("path")).alias("file_stem"))


def _manifest(spark, sf):
    """Images on disk: most under their own stem, some missing, some as png beside jpg."""
    i = F.col("image_id")
    m = fx.images(spark, sf).filter(i % 7 != 0).withColumn("ext", F.explode(F.when(i % 10 == 0, F.array(F.lit(".png"), F.lit(".jpg"))).when(i % 4 == 0, F.array(F.lit(".png"))).otherwise(F.array(F.lit(".jpg")))))
    m = m.withColumn("dir", F.concat(F.lit("/data/set"), (i % 5).cast("string"))).withColumn("name", F.concat("stem", "ext"))
    return m.select(F.concat("dir", F.lit("/"), "name").alias("path"), "dir", "name", "stem", "ext", (i % 11 * 30).alias("length"))


def _located(spark, sf, strict=True):
    rows = _parsed(spark, sf).filter("ok").filter(F.col("a.imagePath").isNotNull())
    rows = rows.withColumns({"dir": F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "image_path": F.col("a.imagePath"), "found": v.annotation_issues(F.col("a"))})
    return v.find_images(rows.select("image_id", "path", "dir", "stem", "image_path", "found"), _manifest(spark, sf), strict)


def image_lookup(spark, sf):
    return _located(spark, sf).select("image_id", "image")


def integrity(spark, sf):
    m = _manifest(spark, sf).select(F.col("path").alias("image"), "length")
    rows = _located(spark, sf)
    rows = spread_for_join(rows, m, "image").join(m, "image", "left")
    found = v.with_image_issues(F.col("found"), F.col("length"))
    return rows.select("image_id", found["status"].alias("status"), F.array_join(found["issues"], ";").alias("issues"))


def primary_annotation(spark, sf):
    """Annotations that share an image key compete for its image."""
    rows = once(_raw(spark, sf), s=v.structure(F.col("raw"))).filter("s.status = 'valid'").withColumn("shapes_count", F.col("s.shapes_count"))
    rows = rows.withColumn("image", F.concat(F.lit("/data/img_"), F.col("image_key").cast("string"), F.lit(".jpg")))
    return v.primary_annotation(rows.select("image_id", "path", "stem", "image", "shapes_count")).select("image_id", "image", "rank", "status")


def duplicates_per_image(spark, sf):
    rows = primary_annotation(spark, sf).withColumn("path", F.col("image_id").cast("string"))
    return stats.duplicates_per_image(rows).select("image", "primary", F.array_join("duplicates", ",").alias("duplicates"))


def detection_errors(spark, sf):
    """Damaged detection lists made from events."""
    e = fx.table(spark, sf, "events")
    k = F.col("event_id") % 7
    n = F.floor(F.col("value")).cast("string")
    ok = F.concat(F.lit('[{"box_2d":[1,2,3,'), n, F.lit('],"label":"a"}]'))
    raw = F.when(k == 0, F.lit('{"a":1}')).when(k == 1, F.lit('[{"label":"x"}]')).when(k == 2, F.lit('[{"box_2d":[1,2,3],"label":"x"}]')).when(k == 3, F.lit('[{"box_2d":[1,2,3,"z"],"label":""}]')).when(k == 4, F.lit("[]")).otherwise(ok)
    errors = v.detection_errors(raw)
    return e.select("event_id", F.array_join(errors, ";").alias("errors"), (F.size(errors) == 0).alias("ok"))


def record_status(spark, sf):
    e = fx.table(spark, sf, "events")
    k = F.col("event_id") % 6
    raw = F.when(k == 0, F.lit('{"messages":[]}')).when(k == 1, F.lit('{"conversations":[{"from":"human"}]}')).when(k == 2, F.lit('{"messages":3}')).when(k == 3, F.col("props")).when(k == 4, F.lit("oops{")).otherwise(F.lit('{"conversations":"x"}'))
    return e.select(v.record_status(raw).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def complete_results(spark, sf):
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey") % 3
    price = F.col("o_totalprice").cast("string")
    raw = F.concat(F.lit('{"train_runtime_sec":'), price, F.lit(',"train_loss":1,"samples_per_second":2,"steps_per_second":'), F.when(k == 0, '"n/a"').otherwise("3"), F.when(k == 1, F.lit("}")).otherwise(F.lit(',"peak_vram_gb":4}')))
    return o.select("o_orderkey", v.complete_result(raw).alias("complete"))


def record_errors(spark, sf):
    """Faults of chat and message records made from conversations."""
    c = fx.records(spark, sf)
    k = F.col("conv_id") % 12
    text = lambda m: F.get(m["content"], 0)["text"]
    turns = F.transform("messages", lambda m: F.struct(F.when(m["role"] == "user", "human").when(m["role"] == "assistant", "gpt").otherwise(m["role"]).alias("from"), text(m).alias("value")))
    made = lambda **columns: F.to_json(F.struct(*[x.alias(n) for n, x in columns.items()]))
    none, image = F.array().cast("array<string>"), F.lit("i.png")
    raw = (
        F.when(k == 0, "oops{").when(k == 1, made(text=image)).when(k == 2, made(conversations=none, id=image, image=image))
        .when(k == 3, made(conversations=turns, image=image)).when(k == 4, made(conversations=turns, id=image)).when(k == 5, made(conversations=turns, id=image, image=image))
        .when(k == 6, made(messages=F.col("messages"))).when(k == 7, made(messages=none, images=none)).when(k == 8, made(messages=F.slice("messages", 2, 9), images=none))
        .when(k == 9, made(messages=F.concat(F.slice("messages", 1, 1), F.slice("messages", 1, 1)), images=none)).when(k == 10, made(messages=F.slice("messages", 1, 1), images=none)).otherwise(made(messages=F.col("messages"), images=none))
    )
    return c.select("conv_id", v.record_error(raw).alias("error"), F.col("messages.role").alias("r")).withColumn("roles", F.array_join("r", ",")).drop("r")


def verified_records(spark, sf):
    """What a check of the first fifty records of event properties says."""
    e = fx.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.lit('{"messages":[{"role":"user"}],"images":[]}')).otherwise(F.lit('{"messages":[{"role":"user"},{"role":"user"}],"images":[]}'))
    return v.verify_records(e.select(F.col("event_id").alias("index"), raw.alias("value")), 50)


def normalized_labels(spark, sf):
    p = fx.table(spark, sf, "part")
    label = F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))
    return p.select("p_partkey", v.normalized_label(label).alias("label"))


def _files(spark, sf):
    """Every annotation file with its parsed form and, where there is one, its image."""
    rows = _parsed(spark, sf)
    found = _located(spark, sf, strict=False).select("image_id", "image")
    return rows.join(found, "image_id", "left")


def conversion_report(spark, sf):
    return records.conversion_report(records.conversion_outcomes(_files(spark, sf), "both", keep_empty=True))


def conversion_outcomes(spark, sf):
    found = records.conversion_outcomes(_files(spark, sf), "per_class")
    return found.select("image_id", "outcome", "n_records", "n_invalid")


def statistics_totals(spark, sf):
    return stats.statistics_totals(_parsed(spark, sf))


def clean_set(spark, sf):
    found = stats.clean_set(_parsed(spark, sf).withColumn("length", F.col("image_id") % 1000 + 100))
    return found.withColumn("label_list", F.array_join("label_list", ","))


def integrity_counters(spark, sf):
    return stats.integrity_counters(integrity(spark, sf))


def format_counters(spark, sf):
    return stats.format_counters(_files(spark, sf), {"PROMO": "promo-item", "SMALL": "compact"})


def directory_conversion(spark, sf):
    """Box lists of annotation files, of which a table of sizes knows some."""
    rows = _parsed(spark, sf).withColumn("name", F.concat("stem", F.lit(".json")))
    sizes = fx.images(spark, sf).filter("image_id % 2 = 0").select(F.concat("stem", F.lit(".json")).alias("name"), F.lit(2000).alias("width"), F.lit(1000).alias("height"))
    found = records.convert_directory(rows.withColumn("a", F.when(F.col("ok"), F.col("a"))), sizes)
    item = F.from_json("boxes", "array<struct<box_2d:array<int>,label:string>>")
    return found.select("file", F.size(item).alias("n"), F.array_max(F.transform(item, lambda b: F.get(b["box_2d"], 3))).alias("right_edge"))


def directory_counts(spark, sf):
    rows = _parsed(spark, sf).withColumns({"name": F.concat("stem", F.lit(".json")), "a": F.when(F.col("ok"), F.col("a"))})
    return records.directory_counts(records.convert_directory(rows))


QUERIES = {f.__name__: f for f in (structure_status, cleaning_summary, image_source, prescan, prescan_labels, mapped_labels, standardized, relative_paths, image_lookup, integrity, primary_annotation, duplicates_per_image, detection_errors, record_status, complete_results, record_errors, verified_records, normalized_labels, conversion_report, conversion_outcomes, statistics_totals, clean_set, integrity_counters, format_counters, directory_conversion, directory_counts)}

_KEPT = "image_id % 20 NOT IN (1, 2, 3)"
_JSON = RAW_SQL + f", js AS (SELECT s.*, s.image_id AS id FROM shapes s WHERE {_KEPT.replace('image_id', 's.image_id')})"
_IMAGE = """CASE WHEN image_id % 7 = 0 THEN NULL
   WHEN image_id % 6 <> 0 AND (CASE WHEN image_id % 4 = 0 THEN image_id % 10 = 0 OR image_id % 4 = 0 ELSE true END) THEN '/data/set' || image_id % 5 || '/' || name
   ELSE '/data/set' || image_id % 5 || '/' || stem || CASE WHEN image_id % 10 = 0 THEN '.jpg' WHEN image_id % 4 = 0 THEN '.png' ELSE '.jpg' END END"""
_LOOK = RAW_SQL + f", look AS (SELECT image_id, n, {_IMAGE} AS image FROM raw WHERE image_id % 20 NOT IN (1, 4))"
_PRIM = RAW_SQL + """, prim AS (SELECT image_id, '/data/img_' || image_key || '.jpg' AS image,
  row_number() OVER (PARTITION BY image_key ORDER BY image_id = image_key DESC, CASE WHEN image_id <> image_key THEN -n END, length(stem), stem)::INT AS rank FROM raw WHERE status = 'valid')"""
_OUT = RAW_SQL + """, w AS (SELECT image_id, count(*) FILTER (ok) AS usable, count(DISTINCT label) FILTER (ok) AS classes, count(*) FILTER (NOT ok) AS bad FROM (
    SELECT image_id, label, x1 >= 0 AND y1 >= 0 AND x2 <= width AND y2 <= height AND x2 > x1 AND y2 > y1 AS ok FROM shapes WHERE shape_type IN ('rectangle', 'polygon')) GROUP BY 1),
  q AS (SELECT image_id, CASE WHEN r = 2 THEN 0 ELSE coalesce(bad, 0) END AS bad, coalesce(classes, 0) AS classes, CASE WHEN r IN (1, 3) THEN 'failed' WHEN r = 4 THEN 'no_image_path' WHEN image_id % 7 = 0 THEN 'missing_image' WHEN r = 2 OR coalesce(usable, 0) = 0 THEN 'empty' ELSE 'converted' END AS outcome
    FROM (SELECT *, image_id % 20 AS r FROM raw) LEFT JOIN w USING (image_id))"""
ORACLE_SQL = {
    "structure_status": f"WITH {RAW_SQL} SELECT image_id, status, CASE WHEN status = 'valid' THEN n END::INT AS shapes_count FROM raw",
    "cleaning_summary": f"WITH {RAW_SQL} SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in STATUSES) + ", round(count(*) FILTER (status = 'valid') * 100.0 / count(*), 4) AS valid_pct FROM raw",
    "image_source": f"""WITH {RAW_SQL} SELECT image_id, CASE WHEN r > 4 OR r = 0 THEN CASE WHEN image_id % 9 = 0 THEN 'remote' ELSE 'local' END WHEN r = 4 THEN 'none' ELSE 'local' END AS kind,
      CASE WHEN (r > 4 OR r = 0) AND image_id % 9 = 0 THEN 'http://host/' || stem WHEN r <> 4 THEN name END AS value FROM (SELECT *, image_id % 20 AS r FROM raw) WHERE r <> 1""",
    "prescan": f"WITH {RAW_SQL}, q AS (SELECT image_id % 20 AS r, image_id % 9 = 0 AS u FROM raw) SELECT count(*) FILTER (r <> 1) AS scanned, count(*) FILTER (r = 1) AS skipped, count(*) FILTER (u AND (r > 4 OR r = 0)) AS url, count(*) FILTER (r IN (2, 3) OR (NOT u AND (r > 4 OR r = 0))) AS local FROM q",
    "prescan_labels": f"WITH {_JSON} SELECT label, count(*) AS n FROM js GROUP BY label",
    "mapped_labels": f"WITH {_JSON} SELECT CASE label WHEN 'PROMO' THEN 'promo-item' WHEN 'SMALL' THEN 'compact' WHEN 'LARGE' THEN 'compact' ELSE label END AS label, label AS original_label, count(*) AS n, count(*) FILTER (label IN ('PROMO', 'SMALL', 'LARGE')) AS mapped FROM js GROUP BY label",
    "standardized": f"WITH {_JSON} SELECT 'cleaned' AS cleaning_status, lower(label) AS label_normalized, shape_type, count(*) AS n FROM js GROUP BY ALL",
    "relative_paths": f"WITH {RAW_SQL} SELECT image_id, stem || '.json' AS relative, stem AS file_stem FROM raw",
    "image_lookup": f"WITH {_LOOK} SELECT image_id, image FROM look",
    "integrity": f"""WITH {_LOOK}, q AS (SELECT *, image_id % 20 IN (2, 3) AS none, image IS NULL AS lost, image_id % 11 * 30 < 100 AS small FROM look)
      SELECT image_id, CASE WHEN none THEN 'fail' WHEN n = 0 OR lost OR small THEN 'warning' ELSE 'pass' END AS status,
        concat_ws(';', CASE WHEN none THEN 'missing_field:shapes' END, CASE WHEN NOT none AND n = 0 THEN 'empty_shapes' END, CASE WHEN lost THEN 'missing_image' WHEN small THEN 'small_image' END) AS issues FROM q""",
    "primary_annotation": f"WITH {_PRIM} SELECT image_id, image, rank, CASE WHEN rank = 1 THEN 'primary' ELSE 'duplicate_annotation' END AS status FROM prim",
    "duplicates_per_image": f"WITH {_PRIM} SELECT image, min(image_id::VARCHAR) FILTER (rank = 1) AS primary, string_agg(image_id::VARCHAR, ',' ORDER BY rank) FILTER (rank > 1) AS duplicates FROM prim GROUP BY image HAVING count(*) > 1",
    "detection_errors": """SELECT event_id, e AS errors, e = '' AS ok FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'not_list' WHEN 1 THEN 'no_box:0' WHEN 2 THEN 'box_arity:0' WHEN 3 THEN 'box_number:0;no_label:0' WHEN 4 THEN ''
      ELSE CASE WHEN floor(value) > 1000 THEN 'box_range:0' ELSE '' END END AS e FROM events)""",
    "record_status": "SELECT CASE event_id % 6 WHEN 0 THEN 'openai' WHEN 1 THEN 'sharegpt' WHEN 2 THEN 'messages_no_list' WHEN 3 THEN 'unknown_schema' WHEN 4 THEN 'invalid_json' ELSE 'conversations_no_list' END AS status, count(*) AS n FROM events GROUP BY 1",
    "complete_results": "SELECT o_orderkey, o_orderkey % 3 = 2 AS complete FROM orders",
    "record_errors": """WITH t AS (SELECT conv_id, string_agg(role, ',' ORDER BY turn, role) AS roles, list(role ORDER BY turn, role) AS r FROM conversations GROUP BY 1), k AS (SELECT *, conv_id % 12 AS k, len(r) AS n FROM t),
      f AS (SELECT *, CASE WHEN r[1] <> 'user' THEN 'first_not_human' WHEN n = 2 AND r[2] <> 'assistant' THEN 'second_not_gpt' END AS chat, CASE WHEN r[1] <> 'user' THEN 'first_not_user' WHEN n > 1 AND r[2] <> 'assistant' THEN 'second_not_assistant' END AS own FROM k)
      SELECT conv_id, roles, CASE k WHEN 0 THEN 'not_json' WHEN 1 THEN 'unknown_schema' WHEN 2 THEN 'no_turns' WHEN 3 THEN coalesce(chat, 'no_id') WHEN 4 THEN coalesce(chat, 'no_image') WHEN 5 THEN chat WHEN 6 THEN 'no_images' WHEN 7 THEN 'no_messages'
        WHEN 8 THEN CASE WHEN n < 2 THEN 'no_messages' WHEN r[2] <> 'user' THEN 'first_not_user' WHEN n > 2 AND r[3] <> 'assistant' THEN 'second_not_assistant' END
        WHEN 9 THEN CASE WHEN r[1] <> 'user' THEN 'first_not_user' ELSE 'second_not_assistant' END WHEN 10 THEN CASE WHEN r[1] <> 'user' THEN 'first_not_user' END ELSE own END AS error FROM f""",
    "verified_records": """WITH e AS (SELECT event_id AS i, CASE event_id % 3 WHEN 0 THEN 'unknown_schema' WHEN 2 THEN 'second_not_assistant' END AS e FROM events WHERE event_id < 50)
      SELECT count(*) AS checked, count(*) FILTER (e IS NULL) AS valid, count(*) = count(*) FILTER (e IS NULL) AS passed, (SELECT string_agg(i || ':' || e, '; ' ORDER BY i) FROM (SELECT * FROM e WHERE e IS NOT NULL ORDER BY i LIMIT 3)) AS errors FROM e""",
    "normalized_labels": "SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN lower(trim(p_type)) ELSE '' END AS label FROM part",
    "conversion_outcomes": f"WITH {_OUT} SELECT image_id, outcome, CASE WHEN outcome = 'converted' THEN classes ELSE 0 END::INT AS n_records, CASE WHEN outcome IN ('empty', 'converted') THEN bad ELSE 0 END::INT AS n_invalid FROM q",
    "conversion_report": f"""WITH {_OUT}, c AS (SELECT *, CASE WHEN outcome = 'converted' THEN classes + 1 WHEN outcome = 'empty' THEN 1 ELSE 0 END AS n FROM q)
      SELECT count(*) AS files, sum(n)::BIGINT AS converted, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome IN ('no_image_path', 'missing_image')) AS skipped, count(*) FILTER (outcome = 'missing_image') AS missing_images,
        count(*) FILTER (outcome = 'empty') AS empty, sum(CASE WHEN outcome IN ('empty', 'converted') THEN bad ELSE 0 END)::BIGINT AS invalid_boxes, round(sum(n) * 100.0 / count(*), 4)::DOUBLE AS rate_pct FROM c""",
    "statistics_totals": f"""WITH {RAW_SQL}, r AS (SELECT image_id, n, CASE WHEN image_id % 20 = 1 THEN 'parse_error' WHEN image_id % 20 = 4 THEN 'no_image_ref' WHEN image_id % 20 IN (2, 3) OR n = 0 THEN 'no_shapes' ELSE 'processed' END AS reason FROM raw)
      SELECT count(*) FILTER (reason = 'processed') AS processed, count(*) FILTER (reason = 'parse_error') AS skipped_parse_error, count(*) FILTER (reason = 'no_image_ref') AS skipped_no_image_ref, count(*) FILTER (reason = 'no_shapes') AS skipped_no_shapes,
        coalesce(sum(n) FILTER (reason = 'processed'), 0)::BIGINT AS instances, (SELECT count(DISTINCT label) FROM shapes JOIN r USING (image_id) WHERE reason = 'processed') AS labels FROM r""",
    "clean_set": f"""WITH {_JSON}, f AS (SELECT image_id % 20 <> 1 AS ok, CASE WHEN {_KEPT} THEN n ELSE 0 END AS n, image_id % 1000 + 100 AS length FROM raw)
      SELECT count(*) AS files, count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS failed, sum(n)::BIGINT AS annotations, round(avg(n), 6) AS mean, max(n)::INT AS most, min(n)::INT AS least, sum(length)::BIGINT AS bytes, round(avg(length), 6) AS mean_bytes,
        (SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM js) AS label_list, (SELECT count(DISTINCT label) FROM js)::INT AS labels FROM f""",
    "format_counters": f"""WITH {_JSON}, f AS (SELECT *, image_id % 20 AS r FROM raw)
      SELECT count(*) AS files, count(*) FILTER (r <> 1) AS converted, count(*) FILTER (r = 1) AS failed, (SELECT count(*) FROM js WHERE label IN ('PROMO', 'SMALL')) AS labels_mapped, count(*) FILTER (image_id % 9 = 0 AND (r > 4 OR r = 0)) AS urls,
        count(*) FILTER (r NOT IN (1, 4) AND image_id % 7 <> 0) AS links, count(*) FILTER (r <> 1 AND (r = 4 OR image_id % 7 = 0)) AS links_failed, round(count(*) FILTER (r <> 1) * 100.0 / count(*), 4)::DOUBLE AS success_pct FROM f""",
    "directory_conversion": f"""WITH {_JSON}, b AS (SELECT image_id, count(*) AS n, max(least(1000, round_even(greatest(x1, x2) / (CASE WHEN image_id % 2 = 0 THEN 2000 ELSE width END)::DOUBLE * 1000, 0))) AS e FROM js WHERE shape_type = 'rectangle' GROUP BY 1)
      SELECT stem || '_boxes.json' AS file, CASE WHEN image_id % 20 = 1 THEN NULL ELSE coalesce(b.n, 0) END::INT AS n, e::INT AS right_edge FROM raw LEFT JOIN b USING (image_id)""",
    "directory_counts": f"WITH {RAW_SQL} SELECT count(*) AS total_files, count(*) FILTER (image_id % 20 <> 1) AS converted, count(*) FILTER (image_id % 20 = 1) AS failed FROM raw",
}
ORACLE_SQL["integrity_counters"] = f"""WITH i AS ({ORACLE_SQL["integrity"]}) SELECT count(*) AS files, count(*) FILTER (status <> 'fail') AS passed, count(*) FILTER (status = 'fail') AS failed, count(*) FILTER (status = 'warning') AS warnings,
  round(count(*) FILTER (status <> 'fail') * 100.0 / count(*), 4)::DOUBLE AS pass_pct FROM i"""
