"""Queries through sources and sinks: data that Spark derives from the tables is written to the shared folder and read back."""

from __future__ import annotations

import io
import tarfile
import warnings
import zipfile

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from annospark import fixtures as fx
from annospark.functions import geometry as g
from annospark.functions import text as t
from annospark.operators import evaluate, infer, records, runs, stats, validate, work
from annospark.operators.split import class_matrix
from annospark.plans import pipelines
from annospark.queries import validation as val
from annospark.queries.evaluation import _arrays
from annospark.queries.records import _HEAD, _ITEM, _USABLE
from annospark.queries.work import _GPU
from annospark.sources import archives, files, snapshots
from annospark.sources.shared import shared_folder, written


def jsonl_records(spark, sf):
    """Event lines with blank and broken ones between them, read back with their place."""
    path = shared_folder(spark, "jsonl")
    e = fx.table(spark, sf, "events").select("event_id", "event_type", "value").repartitionByRange(8, "event_id").sortWithinPartitions("event_id")
    line = F.when(F.col("event_id") % 5 == 0, F.lit("{oops")).when(F.col("event_id") % 7 == 0, F.lit("  ")).otherwise(F.to_json(F.struct("event_id", "event_type", "value")))
    e.select(line.alias("value")).write.text(path)
    rows = files.with_index(files.read_jsonl(spark, path, "struct<event_id:bigint,event_type:string,value:double>"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"), F.countDistinct("index").alias("places"))


def statistics_file(spark, sf):
    """A label statistics file of all images, read back; files that the manifest lacks are missing."""
    path = shared_folder(spark, "statistics")
    stats.statistics_json(stats.label_counts(fx.shapes(spark, sf)), "/data").repartition(8, "value").write.option("maxRecordsPerFile", 1).text(path)
    listed = files.read_statistics(spark, path)
    manifest = fx.images(spark, sf).filter("image_id % 6 <> 0").select(F.col("image_id").cast("string").alias("path"))
    plan = files.filter_copy_plan(listed, manifest)
    return plan.groupBy("status").agg(F.count("*").alias("files"))


def _listed(spark, sf):
    """Files of a statistics table, under two folders, of which a manifest has most."""
    name = lambda i: F.concat(F.lit("/set"), (i % 2).cast("string"), F.lit("/"), F.floor(i / 2).cast("string"), F.lit(".json"))
    listed = fx.shapes(spark, sf).select(name(F.col("image_id")).alias("file"))
    return files.filter_copy_plan(listed, fx.images(spark, sf).filter("image_id % 6 <> 0").select(name(F.col("image_id")).alias("path")))


def filter_copies(spark, sf):
    """Copies of listed files of three folders and their images under flat names; names of the third look like numbered ones."""
    i = F.col("image_id")
    name = F.concat(F.lit("/set"), (i % 3).cast("string"), F.lit("/"), F.floor(i / 3).cast("string"), F.when(i % 3 == 2, "_1").otherwise(""), F.lit(".json"))
    listed = fx.shapes(spark, sf).select(name.alias("file"))
    plan = files.filter_copy_plan(listed, fx.images(spark, sf).filter("image_id % 7 <> 0").select(name.alias("path")))
    return files.filter_copies(plan, "/out", plan.select("file", F.when(F.length("file") % 2 == 0, F.regexp_replace("file", "json$", "jpg")).alias("image")))


def keyed_exports(spark, sf):
    """Payloads of both models' detections, written as a file each and read back; rows without an image path fail."""
    d = _arrays(fx.detections(spark, sf), "image_id", "model").join(fx.images(spark, sf), "image_id")
    i = F.col("image_id")
    rows = d.select(
        i.alias("index"), F.when(i % 9 != 0, F.concat(F.lit("/data/"), "stem", F.lit(".png"))).alias("image_path"), "width", "height", F.col("boxes").alias("detections"), F.col("model").alias("model_type"),
    )
    out = [records.export_payload(rows.filter(F.col("model_type") == m)).select(F.concat(F.lit(f"{m}/"), "file").alias("file"), "payload") for m in "AB"]
    path, names = shared_folder(spark, "exports"), shared_folder(spark, "names")
    counts = files.write_keyed(out[0].unionAll(out[1]), path, names).first()
    back = files.read_keyed(spark, path, names).withColumn("a", validate.parse(F.col("payload")))
    corner = lambda k, c: F.aggregate("a.shapes", F.lit(0.0), lambda s, x: s + F.get(F.get(x["points"], k), c))
    return back.select(
        "file", F.col("a.imagePath").alias("image"), F.col("a.imageWidth").cast("int").alias("width"), F.size("a.shapes").alias("shapes"), F.array_join(F.array_sort("a.shapes.label"), "|").alias("labels"),
        corner(0, 0).alias("x1"), corner(0, 1).alias("y1"), corner(1, 0).alias("x2"), corner(1, 1).alias("y2"), F.lit(counts["written"]).alias("written"), F.lit(counts["failed"]).alias("failed"),
    )


def _archive(key, rows: pd.DataFrame) -> pd.DataFrame:
    """A block of pages as one archive: zip, tar or compressed tar in turn."""
    block, body = int(key[0]), io.BytesIO()
    rows = rows.sort_values("page_id")
    if block % 3 == 0:
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z, warnings.catch_warnings():
            warnings.simplefilter("ignore")  # names repeat on purpose
            for name, html in zip(rows["name"], rows["html"]):
                z.writestr(zipfile.ZipInfo(name), (html or "").encode(), zipfile.ZIP_DEFLATED)
    else:
        with tarfile.open(fileobj=body, mode="w:" if block % 3 == 1 else "w:gz") as t:
            for name, html in zip(rows["name"], rows["html"]):
                info, raw = tarfile.TarInfo(name), (html or "").encode()
                info.size = len(raw)
                t.addfile(info, io.BytesIO(raw))
    return pd.DataFrame({"file": [f"arch_{block:08d}." + ("zip", "tar", "tar.gz")[block % 3]], "payload": [body.getvalue()]})


def archive_members(spark, sf):
    """Pages in archives of 64, read back member by member under free names: pages of all archives share names, some of which look like
    numbered ones."""
    path = shared_folder(spark, "archives")
    name = F.concat(F.lit("p"), (F.col("page_id") % 16).cast("string"), F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("_"), (F.col("page_id") % 7).cast("string"))).otherwise(""), F.lit(".html"))
    pages = fx.table(spark, sf, "pages").select("page_id", "html", name.alias("name"), F.floor(F.col("page_id") / 64).alias("block"))
    files.write_keyed(pages.groupBy("block").applyInPandas(_archive, "file string, payload binary"), path)
    found = archives.read_members(archives.members(spark, path, nested=False))
    block = F.regexp_extract("archive", r"arch_([0-9]+)", 1).cast("long")
    return found.select(block.alias("block"), "no", "target", "piece", F.md5("content").alias("content_md5"), F.length("content").alias("bytes"), "error")


def missing_files(spark, sf):
    """The first ten listed files that are missing."""
    return stats.first_rows(_listed(spark, sf).filter("status = 'missing'"), 10, "file")


def gpu_log_csv(spark, sf):
    path = shared_folder(spark, "gpu")
    fx.gpu_log(spark, sf).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).write.option("header", True).csv(path)
    return runs.gpu_summary(files.read_gpu_log(spark, path))


def result_store(spark, sf):
    """Detections stored by model and split; one split is written again and replaces its rows only."""
    path = shared_folder(spark, "store")
    d = fx.detections(spark, sf).withColumn("split", F.when(F.col("image_id") % 10 < 6, "train").otherwise("test"))
    files.write_results(d, path)
    files.write_results(d.filter("model = 'A' and split = 'test' and image_id % 2 = 0"), path)
    return files.read_results(spark, path).groupBy("model", "split").agg(F.count("*").alias("n"), F.countDistinct("image_id").alias("images"))


def result_snapshots(spark, sf):
    """Two snapshots of a store side by side: one split is written again and one is cleared after the first, which still reads as it was."""
    path = shared_folder(spark, "store")
    d = fx.detections(spark, sf).withColumn("split", F.when(F.col("image_id") % 10 < 6, "train").otherwise("test"))
    files.write_results(d, path)
    first = snapshots.read(spark, path)
    files.write_results(d.filter("model = 'A' and split = 'test' and image_id % 2 = 0"), path)
    snapshots.remove(spark, path, lambda values: values == {"model": "B", "split": "train"})
    counts = [rows.groupBy("model", "split").agg(F.count("*").alias(name)) for name, rows in (("before", first), ("after", snapshots.read(spark, path)))]
    return counts[0].join(counts[1], ["model", "split"], "full").na.fill(0)


def partial_results(spark, sf):
    """Results of eight workers, merged: a worker has one file ({"results": [...]}) for each stretch of 65,536 images."""
    path = shared_folder(spark, "partial")
    d = _arrays(fx.detections(spark, sf).filter("model = 'A'"), "image_id")
    dets = F.transform("boxes", lambda b: F.struct(b["bbox"].alias("bbox"), b["label"].alias("label"), b["confidence"].cast("double").alias("confidence")))
    i = F.col("image_id")
    result = F.struct(i.alias("index"), F.lit("A").alias("model_type"), F.concat(F.lit("/i/"), i.cast("string")).alias("image_path"), dets.alias("detections"))
    rows = d.select((i % 8).cast("int").alias("gpu_id"), F.floor(i / 65536).alias("stretch"), i.alias("index"), F.to_json(result).alias("value"))
    file = Window.partitionBy("gpu_id", "stretch").orderBy("index")
    head = F.when(F.lag("index").over(file).isNull(), '{"results": [').otherwise("")
    tail = F.when(F.lead("index").over(file).isNull(), "]}").otherwise(",")
    lines = rows.withColumn("value", F.concat(head, "value", tail)).sortWithinPartitions("gpu_id", "stretch", "index").drop("index")
    lines.write.partitionBy("gpu_id", "stretch").text(path)
    found = files.read_partial_results(spark, path)
    return found.select("index", "image_path", F.size("detections").alias("n"), F.get("detections", 0)["label"].alias("label"))


def export_files(spark, sf):
    """Annotation payloads of detections; rows without image path fail and are counted."""
    d = _arrays(fx.detections(spark, sf).filter("model = 'B'"), "image_id").join(fx.images(spark, sf), "image_id")
    path = F.when(F.col("image_id") % 9 != 0, F.concat(F.lit("/data/"), "stem", F.lit(".png")))
    rows = d.select(F.col("image_id").alias("index"), path.alias("image_path"), F.when(F.col("image_id") % 4 != 0, F.col("width")).alias("width"), "height", F.col("boxes").alias("detections"))
    out = records.export_payload(rows)
    back = validate.parse(F.col("payload"))
    return out.select("index", "file", F.col("payload").isNotNull().alias("written"), F.size(back["shapes"]).alias("shapes"), back["imageWidth"].alias("width"))


def _exported(spark, sf):
    d = _arrays(fx.detections(spark, sf).filter("model = 'B'"), "image_id").join(fx.images(spark, sf), "image_id")
    i = F.col("image_id")
    return records.export_payload(
        d.select(
            F.when(i % 8 != 0, i).alias("index"), F.when(i % 9 != 0, F.concat(F.lit("/data/"), "stem", F.lit(".png"))).alias("image_path"),
            F.when(i % 4 != 0, F.col("width")).alias("width"), "height", F.when(i % 3 == 0, F.col("width") + 1).alias("loaded_width"), (F.col("height") + 1).alias("loaded_height"),
            F.when(i % 5 == 0, 77).alias("meta_width"), F.lit(88).alias("meta_height"), F.col("boxes").alias("detections"), (i % 4).cast("int").alias("gpu_id"), F.lit("B").alias("model_type"),
            F.struct(F.lit(0.5).alias("precision"), F.lit(0.25).alias("recall"), F.lit(0.75).alias("f1")).alias("metrics"), F.lit("all?").alias("query"), F.concat(F.lit("r"), i.cast("string")).alias("raw_response"),
        )
    )


def export_payloads(spark, sf):
    """What the payloads of detections say of sizes, metadata, the raw answer and the first box."""
    p = F.try_parse_json("payload")
    at = lambda path, kind: F.try_variant_get(p, path, kind)
    return _exported(spark, sf).filter("payload is not null").select(
        "file", at("$.imagePath", "string").alias("image"), at("$.imageWidth", "int").alias("width"), at("$.imageHeight", "int").alias("height"), at("$.metadata.gpu_id", "int").alias("gpu"),
        at("$.metadata.f1", "double").alias("f1"), at("$.metadata.num_detections", "int").alias("n"), at("$.raw_inference_data.raw_response", "string").alias("response"), at("$.raw_inference_data.parse_success", "boolean").alias("parsed"),
        at("$.shapes[0].description", "string").alias("description"), at("$.shapes[0].points[1][0]", "double").alias("x2"), at("$.shapes[0].shape_type", "string").alias("kind"),
    )


def export_counts(spark, sf):
    return records.export_counts(_exported(spark, sf))


def message_export(spark, sf):
    """Messages of chat records, written without anything else and read back."""
    path = shared_folder(spark, "messages")
    files.export_messages(fx.records(spark, sf), path)
    back = spark.read.parquet(path)
    return back.select(F.explode("messages").alias("m")).groupBy("m.role").agg(F.count("*").alias("turns"), F.sum(F.length(F.get("m.content", 0)["text"])).alias("characters"))


def copy_plan(spark, sf):
    rows = val._located(spark, sf)
    return files.copy_plan(rows.select("path", "image"), "/data", "/out")


def fetch_plan(spark, sf):
    p = fx.table(spark, sf, "pages").select("url")
    return files.fetch_plan(p)


def preferred_split(spark, sf):
    """The evaluation file of each customer's folder, which has a file per order."""
    o = fx.table(spark, sf, "orders")
    stem = F.element_at(F.array(*[F.lit(s) for s in ("test", "valid", "val", "train", "extra")]), (F.floor(F.col("o_orderkey") / 3) % 5 + 1).cast("int"))
    folder = F.concat(F.lit("/d/"), F.col("o_custkey").cast("string"))
    found = o.select(folder.alias("dir"), F.concat(folder, F.lit("/"), F.col("o_orderkey").cast("string"), F.lit("/"), stem, F.lit(".jsonl")).alias("path"), stem.alias("stem"))
    return files.prefer_split(found, by="dir")


def annotation_files(spark, sf):
    """Annotation texts through JSON lines, then checked."""
    path = shared_folder(spark, "annotations")
    raw = val._raw(spark, sf)
    files.write_json(raw.select("image_id", "raw"), path)
    back = files.read_jsonl(spark, path, "struct<image_id:bigint,raw:string>")
    return back.select(validate.structure_status(F.col("raw")).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def split_files(spark, sf):
    """Records written by split and read back from each split's folder."""
    from annospark.operators.split import stratified_split

    path = shared_folder(spark, "splits")
    rows = written(records.convert(fx.annotations(spark, sf)).select("image_key", "record_id", "num_objects", "labels"), "records")
    parts = stratified_split(rows.select("image_key", F.explode("labels").alias("label")), "8:1:1", (F.col("image_key") * 7919) % 10007)
    files.write_splits(rows.join(parts.select("image_key", "split"), "image_key").select("split", "record_id", "num_objects"), path)
    back = spark.read.text(path).select("split", F.from_json("value", "struct<record_id:string,num_objects:int>").alias("r"))
    return back.groupBy("split").agg(F.count("*").alias("records"), F.sum("r.num_objects").alias("objects"))


def dataset_job(spark, sf):
    """The whole conversion with both strategies: every record as the files of its split have it; test records keep no answer."""
    path = shared_folder(spark, "dataset")
    pipelines.convert(fx.annotations(spark, sf), path, order=(F.col("image_key") * 7919) % 10007, strategy="both")
    rows = None
    for name in ("all_in_one", "per_class"):
        body = F.from_json("value", "struct<record_id:string,labels:array<string>,messages:array<struct<role:string,content:array<struct<type:string,text:string>>>>>")
        one = spark.read.text(f"{path}/{name}/data").select(F.lit(name).alias("strategy"), "split", body.alias("r")).select("strategy", "split", "r.*")
        rows = one if rows is None else rows.unionAll(one)
    turns = F.filter("messages", lambda m: m["role"] == "assistant")
    return rows.select(
        "strategy", "split", "record_id", F.array_join("labels", "|").alias("labels"), F.size("messages").alias("turns"), t.first_query(F.col("messages")).alias("prompt"),
        F.when(F.size(turns) > 0, t.role_text(F.col("messages"), "assistant")).alias("answer"),
    )


def _answered(spark, sf):
    """Answers of a predictor that gives its query back; images that end in 7 fail, alone or with their batch."""
    gt = _arrays(fx.shapes(spark, sf).filter("x2 > x1 and y2 > y1"), "image_id", confidence=False)
    text = F.concat(F.lit("["), F.array_join(F.transform("boxes", lambda b: F.concat(F.lit('{"bbox": ['), F.array_join(b["bbox"].cast("array<string>"), ", "), F.lit('], "label": "'), b["label"], F.lit('"}'))), ", "), F.lit("]"))
    rows = gt.select(F.col("image_id").alias("index"), F.lit("all").alias("split"), F.concat(F.lit("i"), F.col("image_id").cast("string")).alias("image_path"), text.alias("query"), F.col("boxes").alias("gts"))

    def make():
        def model(pairs):
            if any(p is not None and p.endswith("7") for p, _ in pairs):
                raise RuntimeError("no image")
            return [q for _, q in pairs]

        return model

    return rows, make


def predicted(spark, sf):
    """A predictor that answers from the query; some batches and rows fail, and failed rows are scored as empty."""
    found = infer.predict(*_answered(spark, sf))
    dets = t.parse_detections(F.col("raw_response"), F.lit(100000), F.lit(100000), "raw")
    found = found.withColumn("dets", F.when(F.col("success"), dets).otherwise(F.array().cast(t.DETECTIONS)))
    m = evaluate.sample_metrics(found.select("index", "success", "dets", "gts"))
    return m.select("index", "success", "num_det", "num_match", F.round("f1", 6).alias("f1"))


def inference_round(spark, sf):
    """A round over eight workers, in which every eleventh record has no image and every thirteenth no query: counts per worker."""
    rows, make = _answered(spark, sf)
    odd = rows.withColumns({"image_path": F.when(F.col("index") % 11 != 0, F.col("image_path")), "query": F.when(F.col("index") % 13 != 0, F.col("query"))})
    found = infer.predict(odd, make, partitions=8).withColumn("worker", work.round_robin(F.col("index"), 8))
    return infer.shard_stats(found).select("worker", "samples", "unprepared", "failed", "processed")


def size_lookup(spark, sf):
    """Sizes of a manifest override those of the annotation; 1024 where neither has one."""
    i = fx.images(spark, sf).select("image_id", F.when(F.col("image_id") % 3 == 0, F.col("width")).alias("stated"))
    sizes = fx.images(spark, sf).filter("image_id % 2 = 0").select("image_id", (F.col("width") + 1).alias("real"))
    return i.join(sizes, "image_id", "left").select("image_id", g.image_size(F.col("real"), F.col("stated")).alias("width"))


def training_messages(spark, sf):
    """Records with an image reference, a query prompt and an answer, as chat text."""
    d = fx.table(spark, sf, "pages")
    ref = t.image_reference(F.concat(F.lit("/data/"), F.col("page_id").cast("string"), F.lit(".png")), "/data")
    m = t.training_message(t.query_prompt(F.concat(F.lit("  "), F.col("url"))), F.lit("[]"), ref)
    return d.select("page_id", F.md5(t.chat_text(m)).alias("chat_md5"), t.first_query(m).alias("query"))


def record_stats(spark, sf):
    c = fx.records(spark, sf)
    images = F.transform(F.filter("messages", lambda m: m["role"] == "assistant"), lambda m: F.concat(F.lit("i"), F.length(m["content"][0]["text"]).cast("string")))
    return stats.dataset_stats(c.withColumn("images", images))


def selected_files(spark, sf):
    """Shapes of a chosen subset of images, by class."""
    chosen = fx.images(spark, sf).filter("width = 640").select("image_id")
    rows = records.selected_files(fx.shapes(spark, sf), chosen, "image_id").withColumn("split", F.when(F.col("image_key") % 2 == 0, "train").otherwise("val"))
    return class_matrix(rows)


QUERIES = {f.__name__: f for f in (jsonl_records, statistics_file, filter_copies, keyed_exports, archive_members, missing_files, gpu_log_csv, result_store, result_snapshots, partial_results, export_files, export_payloads, export_counts, message_export, copy_plan, fetch_plan, preferred_split, annotation_files, split_files, dataset_job, predicted, inference_round, size_lookup, training_messages, record_stats, selected_files)}

_KEYS = _USABLE + """, uk AS (SELECT u.image_id, u.label, i.image_key FROM u JOIN images i USING (image_id)), recs AS (SELECT image_id, image_key, count(*) AS k FROM uk GROUP BY ALL),
  lab AS (SELECT DISTINCT image_id, image_key, label FROM uk), tot AS (SELECT label, count(*) AS total FROM lab GROUP BY 1),
  strata AS (SELECT image_key, arg_min(label, total * 1000 + ascii(label)) AS stratum FROM (SELECT DISTINCT image_key, label FROM lab) JOIN tot USING (label) GROUP BY 1),
  pos AS (SELECT image_key, stratum, count(*) OVER (PARTITION BY stratum) AS n, row_number() OVER (PARTITION BY stratum ORDER BY (image_key * 7919) % 10007, image_key) - 1 AS r FROM strata),
  cut AS (SELECT *, greatest(3, floor(n * 0.8)) AS a, greatest(1, floor(n * 0.1)) AS v FROM pos),
  st AS (SELECT image_key, CASE WHEN n < 9 OR r < a THEN 'train' WHEN r < a + v THEN 'valid' WHEN r < a + v + v THEN 'test' ELSE 'train' END AS split FROM cut)"""


def _free(order: str) -> str:
    """Tables from m (name, stem, ext): the first row of a name keeps it, and others get the numbers that no row's name has."""
    return f"""j AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY {order}) - 1 AS j FROM m),
      k AS (SELECT root, k, row_number() OVER (PARTITION BY root ORDER BY k) AS i FROM (SELECT DISTINCT regexp_replace(stem, '_[1-9][0-9]*$', '') || ext AS root, regexp_extract(stem, '_([1-9][0-9]*)$', 1)::BIGINT AS k FROM m WHERE regexp_matches(stem, '_[1-9][0-9]*$'))),
      ahead AS (SELECT name, j, count(*) AS a FROM (SELECT DISTINCT name, j FROM j WHERE j > 0) JOIN k ON name = root AND k - i < j GROUP BY ALL),
      free AS (SELECT j.*, CASE WHEN j = 0 THEN name ELSE stem || '_' || (j + coalesce(a, 0)) || ext END AS target FROM j LEFT JOIN ahead USING (name, j))"""


ORACLE_SQL = {
    "jsonl_records": "SELECT event_type, count(*) AS n, round(sum(value), 2) AS value, count(*) AS places FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 GROUP BY 1",
    "statistics_file": f"WITH {fx.SHAPES_SQL} SELECT CASE WHEN image_id % 6 <> 0 THEN 'copied' ELSE 'missing' END AS status, count(DISTINCT image_id) AS files FROM shapes GROUP BY 1",
    "filter_copies": f"""WITH {fx.SHAPES_SQL}, l AS (SELECT DISTINCT '/set' || image_id % 3 || '/' || image_id // 3 || CASE WHEN image_id % 3 = 2 THEN '_1' ELSE '' END || '.json' AS file FROM shapes WHERE image_id % 7 <> 0),
      c AS (SELECT file AS src, 'annotation' AS kind FROM l UNION ALL SELECT regexp_replace(file, 'json$', 'jpg'), 'image' FROM l WHERE length(file) % 2 = 0),
      m AS (SELECT *, regexp_extract(src, '[^/]*$') AS name, split_part(regexp_extract(src, '[^/]*$'), '.', 1) AS stem, regexp_extract(src, '\\.[^.]*$') AS ext FROM c), {_free('src, kind')}
      SELECT src, '/out/' || target AS dst, kind FROM free""",
    "keyed_exports": f"""WITH {fx.DETECTIONS_SQL}, d AS (SELECT image_id, model, count(*)::INT AS shapes, string_agg(label, '|' ORDER BY label) AS labels, sum(x1)::DOUBLE AS x1, sum(y1)::DOUBLE AS y1, sum(x2)::DOUBLE AS x2, sum(y2)::DOUBLE AS y2 FROM detections GROUP BY ALL)
      SELECT model || '/' || lpad(image_id::VARCHAR, greatest(6, length(image_id::VARCHAR))::INT, '0') || '_' || stem || '.json' AS file, stem || '.png' AS image, width, shapes, labels, x1, y1, x2, y2,
        (SELECT count(*) FROM d WHERE image_id % 9 <> 0)::INT AS written, (SELECT count(*) FROM d WHERE image_id % 9 = 0)::INT AS failed FROM d JOIN images USING (image_id) WHERE image_id % 9 <> 0""",
    "archive_members": f"""WITH m AS (SELECT page_id, coalesce(html, '') AS html, page_id // 64 AS block, 'p' || page_id % 16 || CASE WHEN page_id % 5 = 0 THEN '_' || page_id % 7 ELSE '' END AS stem, '.html' AS ext, stem || ext AS name FROM pages), {_free('block, page_id')}
      SELECT block, row_number() OVER (PARTITION BY block ORDER BY page_id) - 1 AS no, target, 0 AS piece, md5(html) AS content_md5, strlen(html)::INT AS bytes, NULL::VARCHAR AS error FROM free""",
    "missing_files": f"WITH {fx.SHAPES_SQL} SELECT DISTINCT '/set' || image_id % 2 || '/' || image_id // 2 || '.json' AS file, 'missing' AS status FROM shapes WHERE image_id % 6 = 0 ORDER BY file LIMIT 10",
    "export_payloads": f"""WITH {fx.DETECTIONS_SQL}, d AS (SELECT image_id, count(*) AS n, arg_min(struct_pack(x2 := x2, c := confidence), (x1, y1, x2, y2, label, confidence)) AS f FROM detections WHERE model = 'B' GROUP BY 1),
      s AS (SELECT *, image_id % 4 <> 0 AS own, image_id % 3 = 0 AS loaded FROM d JOIN images USING (image_id) WHERE image_id % 9 <> 0)
      SELECT CASE WHEN image_id % 8 <> 0 THEN lpad(image_id::VARCHAR, greatest(6, length(image_id::VARCHAR))::INT, '0') || '_' ELSE '' END || stem || '.json' AS file, stem || '.png' AS image,
        CASE WHEN own THEN width WHEN loaded THEN width + 1 WHEN image_id % 5 = 0 THEN 77 ELSE 1000 END::INT AS width, CASE WHEN own THEN height WHEN loaded THEN height + 1 ELSE 88 END::INT AS height, (image_id % 4)::INT AS gpu, 0.75::DOUBLE AS f1, n::INT AS n,
        'r' || image_id AS response, true AS parsed, 'confidence=' || printf('%.4f', f.c) || ',gpu=' || image_id % 4 || ',model=B' AS description, f.x2::DOUBLE AS x2, 'rectangle' AS kind FROM s""",
    "export_counts": f"WITH {fx.DETECTIONS_SQL}, d AS (SELECT DISTINCT image_id FROM detections WHERE model = 'B') SELECT count(*) FILTER (image_id % 9 <> 0) AS written, count(*) FILTER (image_id % 9 = 0) AS failed FROM d",
    "message_export": "SELECT role, count(*) AS turns, sum(length(coalesce(text, '')))::BIGINT AS characters FROM conversations GROUP BY role",
    "gpu_log_csv": f"{_GPU} SELECT * FROM s",
    "result_store": f"WITH {fx.DETECTIONS_SQL}, d AS (SELECT *, CASE WHEN image_id % 10 < 6 THEN 'train' ELSE 'test' END AS split FROM detections) SELECT model, split, count(*) AS n, count(DISTINCT image_id) AS images FROM d WHERE NOT (model = 'A' AND split = 'test' AND image_id % 2 <> 0) GROUP BY ALL",
    "result_snapshots": f"""WITH {fx.DETECTIONS_SQL}, d AS (SELECT *, CASE WHEN image_id % 10 < 6 THEN 'train' ELSE 'test' END AS split FROM detections)
      SELECT model, split, count(*) AS before, count(*) FILTER (NOT (model = 'A' AND split = 'test' AND image_id % 2 <> 0) AND NOT (model = 'B' AND split = 'train')) AS after FROM d GROUP BY ALL""",
    "inference_round": f"""WITH {fx.SHAPES_SQL}, g AS (SELECT DISTINCT image_id FROM shapes WHERE x2 > x1 AND y2 > y1), p AS (SELECT image_id % 8 AS worker, image_id % 11 = 0 OR image_id % 13 = 0 AS odd, image_id % 10 = 7 AND image_id % 11 <> 0 AS bad FROM g)
      SELECT worker::INT AS worker, count(*) AS samples, count(*) FILTER (odd) AS unprepared, count(*) FILTER (bad AND NOT odd) AS failed, count(*) FILTER (NOT bad AND NOT odd) AS processed FROM p GROUP BY 1""",
    "partial_results": f"WITH {fx.DETECTIONS_SQL} SELECT image_id AS index, '/i/' || image_id AS image_path, count(*)::INT AS n, arg_min(label, (x1, y1, x2, y2, label)) AS label FROM detections WHERE model = 'A' GROUP BY image_id",
    "export_files": f"""WITH {fx.DETECTIONS_SQL}, d AS (SELECT image_id, count(*) AS n FROM detections WHERE model = 'B' GROUP BY 1)
      SELECT image_id AS index, CASE WHEN image_id % 9 <> 0 THEN lpad(image_id::VARCHAR, greatest(6, length(image_id::VARCHAR))::INT, '0') || '_' || stem || '.json' END AS file, image_id % 9 <> 0 AS written,
        CASE WHEN image_id % 9 <> 0 THEN n END::INT AS shapes, CASE WHEN image_id % 9 <> 0 THEN CASE WHEN image_id % 4 <> 0 THEN width ELSE 1000 END END::DOUBLE AS width FROM d JOIN images USING (image_id)""",
    "copy_plan": f"""WITH {val._LOOK}, r AS (SELECT look.image, raw.path, 'set' || image_id % 5 AS sub, stem FROM look JOIN raw USING (image_id))
      SELECT path AS src, '/out/' || sub || '/' || stem || '.json' AS dst, 'annotation' AS kind FROM r UNION ALL SELECT image, '/out/' || sub || '/' || regexp_extract(image, '[^/]*$'), 'image' FROM r WHERE image IS NOT NULL""",
    "fetch_plan": """WITH c AS (SELECT url, regexp_extract(regexp_extract(url, '^[^?#]*'), '[^/]*$') AS n FROM pages), e AS (SELECT *, regexp_extract(n, '\\.[A-Za-z0-9]{1,4}$') AS x FROM c)
      SELECT url, left(n, length(n) - length(x)) || '_' || left(md5(url), 8) || CASE WHEN x = '' THEN '.jpg' ELSE x END AS local_name FROM e""",
    "preferred_split": """WITH f AS (SELECT '/d/' || o_custkey AS dir, o_orderkey, (['test', 'valid', 'val', 'train', 'extra'])[o_orderkey // 3 % 5 + 1] AS stem FROM orders), g AS (SELECT dir, dir || '/' || o_orderkey || '/' || stem || '.jsonl' AS path, stem FROM f)
      SELECT dir, path, stem FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY CASE stem WHEN 'test' THEN 1 WHEN 'valid' THEN 2 WHEN 'val' THEN 3 ELSE 4 END, path) AS r FROM g) WHERE r = 1""",
    "annotation_files": f"WITH {val.RAW_SQL} SELECT status, count(*) AS n FROM raw GROUP BY status",
    "split_files": f"WITH {_KEYS} SELECT split, count(*) AS records, sum(k)::BIGINT AS objects FROM recs JOIN st USING (image_key) GROUP BY split",
    "dataset_job": f"""WITH {_KEYS}, w AS (SELECT u.*, image_key, unnest(['all_in_one', 'per_class']) AS strategy FROM u JOIN images i USING (image_id)),
      r AS (SELECT *, 'img_' || image_id || CASE WHEN strategy = 'per_class' THEN '_' || label ELSE '' END AS record_id FROM w),
      k AS (SELECT *, row_number() OVER (PARTITION BY strategy, record_id ORDER BY x_min, y_min, x_max, y_max, label) AS k FROM r)
      SELECT strategy, split, record_id, string_agg(DISTINCT label, '|' ORDER BY label) AS labels, CASE WHEN split = 'test' THEN 1 ELSE 2 END::INT AS turns,
        CASE strategy WHEN 'per_class' THEN 'Find every ' || any_value(label) || ' in the image.' ELSE 'Find every object of these classes in the image: ' || string_agg(DISTINCT label, ', ' ORDER BY label) || '.' END || ' Answer with a JSON list.' AS prompt,
        CASE WHEN split <> 'test' THEN '[' || string_agg({_ITEM} || CASE WHEN k = 1 THEN {_HEAD} ELSE '' END || '}}', ', ' ORDER BY k) || ']' END AS answer
      FROM k JOIN st USING (image_key) GROUP BY strategy, split, record_id""",
    "predicted": f"WITH {fx.SHAPES_SQL}, g AS (SELECT image_id, count(*) AS n FROM shapes WHERE x2 > x1 AND y2 > y1 GROUP BY 1), p AS (SELECT *, image_id % 10 <> 7 AS ok FROM g) SELECT image_id AS index, ok AS success, CASE WHEN ok THEN n ELSE 0 END::INT AS num_det, CASE WHEN ok THEN n ELSE 0 END::INT AS num_match, CASE WHEN ok THEN 1.0 ELSE 0.0 END::DOUBLE AS f1 FROM p",
    "size_lookup": f"WITH {fx.IMAGES_SQL} SELECT image_id, CASE WHEN image_id % 2 = 0 THEN width + 1 WHEN image_id % 3 = 0 THEN width ELSE 1024 END::INT AS width FROM images",
    "training_messages": "WITH q AS (SELECT page_id, 'Find in the image: ' || url || '. Answer with a JSON list.' AS query FROM pages) SELECT page_id, md5('<user>' || page_id || '.png' || query || '</user>' || chr(10) || '<assistant>[]</assistant>' || chr(10)) AS chat_md5, query FROM q",
    "record_stats": """WITH i AS (SELECT conv_id, CASE WHEN role = 'assistant' THEN 'i' || length(coalesce(text, '')) END AS i FROM conversations), c AS (SELECT conv_id, count(i) AS n FROM i GROUP BY 1)
      SELECT count(*) AS samples, count(*) FILTER (n > 0) AS with_images, count(*) FILTER (n = 0) AS without_images, sum(n)::BIGINT AS image_refs, (SELECT count(DISTINCT i) FROM i) AS distinct_images FROM c""",
    "selected_files": f"WITH {fx.SHAPES_SQL} SELECT label, count(*) FILTER (image_key % 2 = 0) AS train, count(*) FILTER (image_key % 2 <> 0) AS val, 0::BIGINT AS test, count(*) AS total FROM shapes WHERE width = 640 GROUP BY label",
}
